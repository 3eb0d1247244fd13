"""Data-quality outputs: quarantine, schema drift, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from callops.schema import STATUS


def _holds(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``broken_rules``: the names of all rules a row breaks (a rule is a condition that must hold)."""
    broken = [F.when(~_holds(rule), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("broken_rules", F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their reasons. Together they are exactly the input.

    Reasons are put together for rejected rows only, and rules on plain columns reach the scan as its filters.
    """
    good = reduce(lambda a, b: a & b, [_holds(rule) for rule in rules.values()], F.lit(True))
    return df.where(good), with_reasons(df.where(~good), rules)


def key_drift(keys: DataFrame, allowed: list[str]) -> DataFrame:
    """Per key: in how many rows it came, and whether it is kept, dropped or missing.

    ``keys`` has one row per received key (``key``).
    """
    spark = keys.sparkSession
    seen = keys.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    expected = spark.range(1).select(F.explode(F.array(*[F.lit(a) for a in allowed])).alias("key"))
    status = (F.when(F.col("_allowed").isNull(), "dropped").when(F.col("rows").isNull(), "missing")
              .otherwise("kept"))
    return (
        expected.withColumn("_allowed", F.lit(True)).join(seen, "key", "full")
        .select("key", F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"))
    )


def audit_rows(stored: DataFrame, declared: DataFrame, table: str, database: str, at) -> DataFrame:
    """Audit records of one table: declared (``date``, ``json_rows``) against stored rows per date."""
    counts = stored.groupBy("date").agg(F.count(F.lit(1)).alias("inserted_rows"))
    return declared.join(counts, "date", "left").select(
        F.lit(table).alias("table_name"),
        "json_rows",
        F.coalesce("inserted_rows", F.lit(0)).alias("inserted_rows"),
        F.lit(database).alias("db_name"),
        (at if isinstance(at, Column) else F.lit(str(at)).cast("timestamp")).alias("timestamp"),
        "date",
    ).select(*STATUS, "date")


def reconciliation(status: DataFrame, tables: dict[str, str], day=None) -> DataFrame:
    """One row per day (of the audit time): declared and stored rows of each table's last audit.

    ``tables`` maps a table name to the prefix of its two output columns.
    """
    audits = status.where(F.col("table_name").isin(*tables)).withColumn("day", F.to_date("timestamp"))
    if day is not None:
        audits = audits.where(F.col("day") == F.lit(str(day)).cast("date"))
    latest = audits.groupBy("day", "table_name").agg(
        F.max(F.struct("timestamp", "json_rows", "inserted_rows")).alias("last"))

    def of(table: str, field: str) -> Column:
        return F.max(F.when(F.col("table_name") == table, F.col(f"last.{field}")))

    return latest.groupBy("day").agg(*[
        column for table, prefix in tables.items() for column in (
            of(table, "json_rows").alias(f"{prefix}_json_rows_count"),
            of(table, "inserted_rows").alias(f"{prefix}_insert_rows_count"),
        )
    ])
