"""Time that spans of several kinds cover, alone and together, by a sweep over each key's days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def by_day(spans: DataFrame, until: Column | None = None) -> DataFrame:
    """Spans (``start``, ``end``) cut at midnight: ``day``, ``_from`` and ``_to`` in seconds, other columns kept.

    Open spans (no end) last up to ``until``, or count for nothing without it, as do spans without a
    start and those that end before a second is over.
    """
    end = F.col("end") if until is None else F.coalesce("end", until)

    def seconds(day: Column) -> Column:
        return F.unix_timestamp(day.cast("timestamp"))

    first, last = F.unix_timestamp("start"), F.unix_timestamp(end)
    timed = spans.withColumns({"_from": first, "_to": last}).where(F.col("_to") > F.col("_from")).drop("start", "end")
    days = F.sequence(F.to_date(F.timestamp_seconds("_from")), F.to_date(F.timestamp_seconds(F.col("_to") - 1)), F.expr("interval 1 day"))
    return timed.withColumn("day", F.explode(days)).withColumns({
        "_from": F.greatest("_from", seconds(F.col("day"))), "_to": F.least("_to", seconds(F.date_add("day", 1)))})


def covered_seconds(spans: DataFrame, key: str, measures: dict[str, Column], kinds: list[str], until: Column | None = None) -> DataFrame:
    """Per key and day: the seconds in which each measure holds.

    ``spans`` has ``key``, ``kind`` (one of ``kinds``), ``start`` and ``end``. A measure is a condition over one boolean
    per kind, true while any span of it runs, so spans of a kind that overlap count once. Starts and
    ends are counted per second before the shuffle: a key's day has 86,401 rows (25 hours: 90,001) at most
    in its window, however many spans it has. No span is joined with another.
    """
    cut = by_day(spans.where(F.col(key).isNotNull()), until)
    ends = cut.select(key, "day", "kind", F.inline(F.array(
        F.struct(F.col("_from").alias("_at"), F.lit(1).alias("_step")), F.struct(F.col("_to").alias("_at"), F.lit(-1).alias("_step")))))
    steps = ends.groupBy(key, "day", "_at").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("_step")).otherwise(0)).alias(f"_{k}") for k in kinds])
    in_order = Window.partitionBy(key, "day").orderBy("_at")
    running = in_order.rowsBetween(Window.unboundedPreceding, 0)
    swept = steps.select(key, "day", (F.lead("_at").over(in_order) - F.col("_at")).alias("_seconds"),
                         *[(F.sum(f"_{k}").over(running) > 0).alias(k) for k in kinds])
    return swept.groupBy(key, "day").agg(
        *[F.coalesce(F.sum(F.when(holds, F.col("_seconds"))), F.lit(0)).alias(name) for name, holds in measures.items()])


def all_spans(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Tables of spans as one, each under the name of its kind."""
    named = [df.select(key, F.lit(kind).alias("kind"), F.col("start").cast("timestamp").alias("start"),
                       F.col("end").cast("timestamp").alias("end")) for kind, df in parts.items()]
    return reduce(DataFrame.unionByName, named)
