"""JSON feeds: an envelope holds a message and a list of row objects with open key sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callops import schema
from callops.functions import text
from callops.functions.numbers import normalise_duration

ENVELOPE = "message string, data array<string>"


def read_envelopes(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Envelope files under ``path``; a ``date=…`` folder becomes the load date.

    A pretty-printed envelope is read by one task, so throughput comes from many files (for large ones
    see :func:`callops.sources.large.read_large`); feeds that write one envelope per line are split within
    files too.
    """
    reader = spark.read.schema(ENVELOPE).option("basePath", path)
    envelopes = reader.option("multiLine", not one_per_line).json(path)
    if "date" in envelopes.columns:
        envelopes = envelopes.withColumn("date", F.col("date").cast("date"))
    return envelopes


def parse_envelopes(df: DataFrame, body: str = "body") -> DataFrame:
    """The same from a text column."""
    return df.withColumn("_e", F.from_json(body, ENVELOPE)).select(
        *[F.col(c) for c in df.columns if c != body], "_e.message", "_e.data")


def declared_rows(envelopes: DataFrame) -> DataFrame:
    """Rows the senders declare per date."""
    return envelopes.groupBy("date").agg(F.sum(text.expected_rows(F.col("message"))).alias("json_rows"))


def raw_rows(envelopes: DataFrame) -> DataFrame:
    """One row per object, still JSON text (``raw``); rows that are cut already are taken as they are."""
    if "raw" in envelopes.columns:
        return envelopes
    carried = [c for c in envelopes.columns if c not in ("message", "data", "raw")]
    # the outer form keeps the optimizer from parsing the list again just to test that it is not empty
    return envelopes.select(*carried, F.explode_outer("data").alias("raw")).where("raw is not null")


def _with_keys(df: DataFrame, json: Column, keys: str, values: str) -> DataFrame:
    """Add the lower-case keys and the values of a JSON object as two arrays, last entry first."""
    parsed = df.withColumn("_object", F.from_json(json, "map<string,string>"))
    return parsed.withColumns({
        keys: F.reverse(F.transform(F.map_keys("_object"), F.lower)),
        values: F.reverse(F.map_values("_object")),
    }).drop("_object")


def _value(keys: str, values: str, key: str) -> Column:
    """The value of a key; of equal keys the last one counts, an absent key is NULL."""
    return F.get(F.col(values), F.array_position(keys, F.lit(key)).cast("int") - 1)


def frozen(envelopes: DataFrame, columns: list[str]) -> DataFrame:
    """Project row objects to the frozen column list, keys in any case.

    Unknown keys drop out, absent ones are NULL.
    """
    rows = _with_keys(raw_rows(envelopes), F.col("raw"), "_k", "_v")
    carried = [c for c in envelopes.columns if c not in ("message", "data", "raw")]
    return rows.select(*carried, *[_value("_k", "_v", c).alias(c) for c in columns])


def agent_feed(envelopes: DataFrame) -> DataFrame:
    """Agent objects: keys must match exactly, but the keys of a filled ``breaks`` object are
    lowered and take precedence over the agent's own.

    Without breaks the agent's own row is kept and ``breaks`` is NULL. Durations that overflow are
    brought to ``HH:MM:SS``.
    """
    columns = schema.AGENT_LANDING
    own = ", ".join(f"{c} string" for c in columns)
    rows = raw_rows(envelopes).withColumn("_own", F.from_json("raw", own))
    rows = _with_keys(rows, F.col("_own.breaks"), "_k", "_v")

    def value(c: str) -> Column:
        mine = F.when(F.size("_k") > 0, F.lit("0")) if c == "breaks" else F.col(f"_own.{c}")
        return F.when(F.array_contains("_k", F.lit(c)), _value("_k", "_v", c)).otherwise(mine).alias(c)

    carried = [c for c in envelopes.columns if c not in ("message", "data", "raw")]
    merged = rows.select(*carried, *[value(c) for c in columns])
    return merged.withColumns({c: normalise_duration(F.col(c)) for c in schema.AGENT_LANDING_DURATIONS})


def call_feed(envelopes: DataFrame) -> DataFrame:
    rows = frozen(envelopes, schema.EXPORT_CALL_LANDING)
    return text.sanitise_rows(rows, text.quotes_to_backtick, schema.EXPORT_CALL_LANDING)


def survey_feed(envelopes: DataFrame) -> DataFrame:
    rows = frozen(envelopes, schema.SURVEY_LANDING)
    return text.sanitise_rows(rows, text.quotes_dropped, schema.SURVEY_LANDING)


def received_keys(envelopes: DataFrame) -> DataFrame:
    """One row per received key, lower-case."""
    return _with_keys(raw_rows(envelopes), F.col("raw"), "_k", "_v").select(F.explode_outer("_k").alias("key")).where(
        "key is not null")
