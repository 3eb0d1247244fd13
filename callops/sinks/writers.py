"""Idempotent writes to Parquet folders partitioned by date.

Spark stages the files of a write and moves them in place when the whole job has succeeded, so a
date shows its old rows or its new rows. Writing again gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callops.session import AS_DEALT, RELEASING, settings, work_dir

#: Rows of one date that one task writes, where the number of rows is known beforehand.
ROWS_PER_FILE = 1_000_000
#: Rows that one task sorts and writes, about, where their number is known beforehand.
ROWS_PER_TASK = 250_000


@dataclass(frozen=True)
class Lookup:
    """Columns that rows get when they lie where they are written, by date and ``key``.

    ``table`` has at most one row per date and key; its column ``rows`` tells how many rows that is for.
    """

    table: DataFrame
    key: str
    rows: str


def _by_date(df: DataFrame, partition: str, counts: DataFrame | None = None, lookup: Lookup | None = None) -> DataFrame:
    """Rows of a date in few files, a big date in several tasks.

    Without ``counts`` adaptive execution splits a date that is too big for one task, and puts small dates
    together, all of them in one task if need be. ``counts`` (``date``, ``source_rows``; one row per date)
    tells the size of dates, so that many small ones are written by many tasks. ``lookup`` needs ``counts``.
    """
    if partition not in df.columns:
        return df
    if counts is None:
        return df.hint("rebalance", F.col(partition))
    parts = F.broadcast(counts.select(F.col("date").alias(partition), F.ceil(F.col("source_rows") / ROWS_PER_FILE).alias("_parts")))
    # a fixed number of partitions, as adaptive execution would merge small ones; it grows with the rows
    loaded = counts.where("action in ('reload', 'insert')") if "action" in counts.columns else counts
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                -(-loaded.agg(F.coalesce(F.sum("source_rows"), F.lit(0)).cast("long")).first()[0] // ROWS_PER_TASK))

    def dealt(rows: DataFrame, part: Column) -> DataFrame:
        return rows.withColumn("_part", part).drop("_parts").repartition(tasks, partition, "_part")

    several = F.greatest(F.col("_parts"), F.lit(1))
    anywhere = F.pmod(F.monotonically_increasing_id(), several)
    if lookup is None:
        return dealt(df.join(parts, partition, "left"), anywhere).select(*df.columns)
    return _looked_up(df, lookup, partition, parts, several, anywhere, dealt)


def _looked_up(df: DataFrame, lookup: Lookup, partition: str, parts: DataFrame, several: Column, anywhere: Column,
               dealt: Callable[[DataFrame, Column], DataFrame]) -> DataFrame:
    """Left join of rows and lookup, both dealt by date and part, so that no row is shuffled again to be written.

    A big date's rows go to a part by their key, and with them the key's lookup row. Rows without a key go
    anywhere, as do those of a key that alone has enough for a file on that date; its lookup row goes to all parts.
    Such keys are fewer than files, and sent to all tasks.
    """
    often = lookup.table.where(F.col(lookup.rows) > ROWS_PER_FILE).select(partition, lookup.key, F.lit(True).alias("_often"))
    by_key = F.pmod(F.xxhash64(lookup.key), several)
    rows = df.join(parts, partition, "left").join(F.broadcast(often), [partition, lookup.key], "left")
    rows = dealt(rows, F.when(F.col("_often") | F.col(lookup.key).isNull(), anywhere).otherwise(by_key)).drop("_often")
    kept = F.when(F.col(lookup.rows) > ROWS_PER_FILE, F.sequence(F.lit(0).cast("long"), several - 1)).otherwise(F.array(by_key))
    known = lookup.table.join(parts, partition, "left").withColumn("_kept", F.explode(kept))
    known = dealt(known, F.col("_kept")).drop("_kept", lookup.rows)
    # a merge join leaves the rows sorted by date, as the write needs them
    return rows.join(known.hint("merge"), [partition, "_part", lookup.key], "left").drop("_part")


def replace_dates(df: DataFrame, path: str, partition: str = "date", cover: DataFrame | None = None,
                  counts: DataFrame | None = None, finish: Callable[[DataFrame], DataFrame] | None = None,
                  lookup: Lookup | None = None) -> None:
    """Replace exactly the dates ``df`` holds; all other dates stay untouched.

    ``cover`` (one row per date, ``date``) names the dates the write speaks for: those without a row
    in ``df`` lose their old rows too. They go first, so a crash in between never shows a date twice;
    running again finishes the work. ``counts``: see ``_by_date``. ``lookup`` adds columns to the rows after
    they are shuffled, and ``finish`` makes the columns of the table from narrower rows, row by row, after
    these are shuffled and sorted.
    """
    if cover is not None:
        held = df.select(F.col(partition).alias("date")).distinct()
        purge_dates(df.sparkSession, path, cover.select("date").join(held, "date", "left_anti"), partition)
    placed = _by_date(df, partition, counts, lookup)
    if finish is not None:
        placed = finish(placed.sortWithinPartitions(partition))
    with settings(df.sparkSession, RELEASING if lookup is None else RELEASING | AS_DEALT):
        (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition).parquet(path))


def purge_dates(spark: SparkSession, path: str, dates: DataFrame, partition: str = "date") -> None:
    """Remove whole dates. Only folder names are touched, one per date of the calendar."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for row in dates.select(F.col("date").cast("string")).distinct().toLocalIterator():
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{partition}={row[0]}"), True)


def apply_decisions(rows: DataFrame, decisions: DataFrame, path: str, clean=None,
                    partition: str = "date", cover: bool = False) -> None:
    """Carry out a gate's decisions: replace ``reload``/``insert`` dates, remove ``purge`` dates.

    With ``cover`` a date to reload may turn out to have no row left; it is cleared.

    ``decisions`` must be stored (see :func:`store_decisions`): a lazy gate would be asked again
    after the target has changed. Vanished dates go first, so a crash in between leaves only dates
    that the next run still sees as different.
    """
    spark = rows.sparkSession
    purge_dates(spark, path, decisions.where("action = 'purge'"), partition)
    load = decisions.where("action in ('reload', 'insert')").select(F.col("date").alias(partition))
    chosen = rows.join(load, partition, "left_semi")
    if cover:
        held = decisions.where("action = 'reload' and target_rows > 0").select("date")
        if not held.isEmpty():
            empty = held.join(chosen.select(F.col(partition).alias("date")).distinct(), "date", "left_anti")
            purge_dates(spark, path, empty, partition)
    replace_dates(clean(chosen) if clean else chosen, path, partition, counts=decisions)


def store_decisions(decisions: DataFrame, path: str) -> DataFrame:
    """Write a gate's result (one row per date) and read it back."""
    decisions.write.mode("overwrite").parquet(path)
    return decisions.sparkSession.read.schema(decisions.schema).parquet(path)


def replace_months(df: DataFrame, path: str, date: str = "date") -> None:
    """Replace the calendar months ``df`` holds (partition ``month`` = first of the month)."""
    replace_dates(df.withColumn("month", F.trunc(date, "MM")), path, "month")


def write_snapshot(df: DataFrame, path: str, as_of) -> None:
    """Full reload of a dimension as a new snapshot; readers switch when it is complete."""
    replace_dates(df.withColumn("snapshot", F.lit(str(as_of)).cast("date")), path, "snapshot")


def append_rows(df: DataFrame, path: str, partition: str | None = "date") -> None:
    writer = (_by_date(df, partition) if partition else df).write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def insert_once(rows: DataFrame, decisions: DataFrame, path: str) -> None:
    """Write the ``insert`` dates. They replace nothing unless an earlier run wrote them half."""
    apply_decisions(rows, decisions.where("action = 'insert'"), path)


def dual_write(df: DataFrame, decisions: DataFrame, history: str, last_batch: str,
               partition: str = "date") -> None:
    """Replace the dates in the history, and keep the newest reloaded date as the last batch.

    The last batch is copied from the written history, so ``df`` is computed once.
    """
    replace_dates(df, history, partition, counts=decisions)
    newest = decisions.where("action = 'reload'").agg(F.max("date").alias(partition))
    written = df.sparkSession.read.parquet(history).join(newest, partition, "left_semi")
    replace_dates(written.withColumn("batch", F.lit("last")), last_batch, "batch")


def quarantine(bad: DataFrame, path: str, run: str) -> None:
    """Keep rejected rows with their reasons, one folder per run."""
    replace_dates(bad.withColumn("run", F.lit(run)), path, "run")


#: The folder column of rows set aside: their date as text.
ASIDE = "aside_date"


def set_aside(bad: DataFrame, path: str, known: DataFrame) -> None:
    """Keep rejected rows by date; of the dates in ``known`` (``ASIDE``) nothing else stays.

    Where there are such dates, rejected rows are picked out once, into the work folder, as their dates are
    needed before they are written.
    """
    if known.isEmpty():
        return replace_dates(bad, path, ASIDE)
    folder = work_dir(bad.sparkSession, "aside")
    bad.write.parquet(folder)
    picked = bad.sparkSession.read.schema(bad.schema).parquet(folder)
    replace_dates(picked, path, ASIDE, cover=known.select(F.col(ASIDE).alias("date")))


def append_audit(audit: DataFrame, path: str) -> None:
    audit.write.mode("append").parquet(path)
