"""Change detection: which dates or rows of a source have to go to a target.

Every gate is one set-based query over both tables and returns one row per date (or month) with
the counts it was decided on and an action:

``skip``    nothing to do
``reload``  replace the date in the target by the source's rows
``purge``   the source no longer has the date, remove it from the target
``insert``  the target has no such date yet, append it
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callops.functions import dates as dt


def date_counts(source: DataFrame, target: DataFrame, key: Column | None = None,
                date: str = "date") -> DataFrame:
    """Rows per date on both sides, from one grouped pass over their union.

    Only the date column is read, counts are combined before the shuffle, and NULL dates are out.
    """
    key = F.col(date) if key is None else key

    def side(df: DataFrame, s: int, t: int) -> DataFrame:
        return (df.select(key.alias("date")).where("date is not null")
                .select("date", F.lit(s).alias("_s"), F.lit(t).alias("_t")))

    return (
        side(source, 1, 0).unionByName(side(target, 0, 1))
        .groupBy("date")
        .agg(F.sum("_s").alias("source_rows"), F.sum("_t").alias("target_rows"))
    )


def _differs() -> Column:
    return F.col("source_rows") != F.col("target_rows")


def count_parity(source: DataFrame, target: DataFrame, date: str = "date") -> DataFrame:
    """Per date: empty source or equal counts → skip, else reload."""
    action = F.when((F.col("source_rows") > 0) & _differs(), "reload").otherwise("skip")
    return date_counts(source, target, date=date).withColumn("action", action)


def count_diff_list(source: DataFrame, target: DataFrame, date: str = "date") -> DataFrame:
    """Dates with different counts: reload where the source has rows, purge where it has none."""
    action = F.when(F.col("source_rows") > 0, "reload").otherwise("purge")
    return date_counts(source, target, date=date).where(_differs()).withColumn("action", action)


def count_diff_range(source: DataFrame, target: DataFrame, date: str = "date") -> DataFrame:
    """Every day from the first to the last source date whose count differs.

    Days without source rows inside the range are purged, as are target-only dates outside of it.
    """
    counts = date_counts(source, target, date=date)
    span = (
        counts.where(_differs() & (F.col("source_rows") > 0))
        .agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
        .where("lo is not null")
        .select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
        .withColumn("_in_range", F.lit(True))
    )
    listed = F.col("_in_range") | (F.col("source_rows") == 0)
    action = F.when(F.col("source_rows") > 0, "reload").otherwise("purge")
    return (
        span.join(counts, "date", "full")
        .withColumn("source_rows", F.coalesce("source_rows", F.lit(0)))
        .withColumn("target_rows", F.coalesce("target_rows", F.lit(0)))
        .where(listed)
        .select("date", "source_rows", "target_rows", action.alias("action"))
    )


def symmetric_diff(source: DataFrame, target: DataFrame, date: str = "date") -> DataFrame:
    """Dates found on one side only; counts do not matter."""
    one_sided = (F.col("source_rows") == 0) | (F.col("target_rows") == 0)
    action = F.when(F.col("target_rows") == 0, "reload").otherwise("purge")
    return date_counts(source, target, date=date).where(one_sided).withColumn("action", action)


def insert_if_absent(source: DataFrame, target: DataFrame, date: str = "date") -> DataFrame:
    """Source dates the target has no row of."""
    absent = (F.col("source_rows") > 0) & (F.col("target_rows") == 0)
    return date_counts(source, target, date=date).where(absent).withColumn("action", F.lit("insert"))


def month_parity(source: DataFrame, target: DataFrame, date: str = "date") -> DataFrame:
    """Count parity per calendar month of one year; the date is the first of the month."""
    counts = date_counts(source, target, dt.month_start(F.col(date)))
    action = (F.when(~_differs(), "skip").when(F.col("source_rows") > 0, "reload")
              .otherwise("purge"))
    return counts.withColumn("action", action)


def date_series(spark: SparkSession, start, end) -> DataFrame:
    """All days from start to end, both included."""
    days = F.sequence(dt.as_date(start), dt.as_date(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date"))


def always(source: DataFrame, target: DataFrame, start, end, date: str = "date") -> DataFrame:
    """Reload every day of a range, whatever the counts."""
    days = date_series(source.sparkSession, start, end)
    counts = date_counts(source, target, date=date)
    return days.join(counts, "date", "left").select(
        "date",
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
        F.lit("reload").alias("action"),
    )


def on_month_start(df: DataFrame, as_of) -> DataFrame:
    """The rows on the first day of a month, none on any other day."""
    return df.where(dt.is_month_start(dt.as_date(as_of)))


def same_dates_and_counts(source: DataFrame, target: DataFrame, date: str = "date") -> DataFrame:
    """One row: do both sides hold the same (date, count) set?"""
    return date_counts(source, target, date=date).agg(
        (F.count_if(_differs()) == 0).alias("equal"),
        F.count_if(_differs()).alias("different_dates"),
    )


def _changed_dates(source: DataFrame, target: DataFrame, date: str) -> DataFrame:
    """Dates on which the two tables differ as multisets, told by counts and two sums of row hashes.

    The sums are of independent 64-bit and 32-bit hashes; a date whose rows changed is overlooked
    with a chance of about 1 in 2^90.
    """
    def signed(df: DataFrame, sign: int) -> DataFrame:
        columns = [F.col(f"`{c}`") for c in source.columns]
        return df.select(F.col(date).alias("_date"), F.lit(sign).alias("_n"), *[
            (h.cast("decimal(20,0)") * sign).alias(name) for name, h in (("_x", F.xxhash64(*columns)), ("_y", F.hash(*columns)))])

    sums = signed(source, 1).unionByName(signed(target, -1)).groupBy("_date").agg(*[F.sum(c).alias(c) for c in ("_n", "_x", "_y")])
    return sums.where("_n <> 0 or _x <> 0 or _y <> 0").select("_date")


def new_rows(source: DataFrame, target: DataFrame, rows_per_task: int = 100_000, date: str | None = None) -> DataFrame:
    """Multiset difference source − target: a row n times in source and m in target comes n−m times.

    With ``date`` only dates that differ at all are compared row by row; the others cost one row each.

    This replaces appending from a row offset, which is only right when row order never changes.
    Equal rows are counted, not gathered; a row that is missing very often is written out by many
    tasks, each for at most ``rows_per_task`` copies.
    """
    columns = [F.col(f"`{c}`") for c in source.columns]
    step = F.lit(rows_per_task)
    if date is not None:
        changed = _changed_dates(source, target, date)
        source, target = (df.join(changed, F.col(date).eqNullSafe(F.col("_date")), "left_semi") for df in (source, target))
    missing = (
        source.select(*columns, F.lit(1).alias("_n"))
        .unionByName(target.select(*columns, F.lit(-1).alias("_n")))
        .groupBy(*columns)
        .agg(F.sum("_n").alias("_n"))
        .where("_n > 0")
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / step))))
    )
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = F.least(step.cast("bigint"), F.col("_n") - F.col("_block") * step)
    return (
        missing.withColumn("_copies", copies)
        # a fixed number: adaptive execution would merge these partitions, which are small only
        # before their rows are repeated
        .repartition(parts, *columns, "_block")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
        .select(*columns)
    )
