"""Append what a table lacks without reading the table: invertible Bloom lookup tables.

Beside the table lies a sketch of it. Every distinct row with its number of copies is an entry, entries
are dealt over buckets by hash, and a bucket has ``CELLS`` cells; an entry is added to three of them.
A cell holds the number of its entries and the exclusive or of their fields, so the sketches of source
and table subtract cell by cell, and what both hold vanishes. From the cells that are left the entries
of the difference are peeled, bucket by bucket: their number, not that of the rows, bounds the work. Buckets
with too many differences to peel are compared exactly, the only case in which rows of the table are read.

The sketch remembers how many rows the table had. If that is not what the table's footers say, as after
a crash between the two writes, it is built anew from the table.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from callops.session import work_dir
from callops.sinks import writers
from callops.sources import tables

#: Cells of a bucket (a multiple of three), and the rows for which one is made at first.
CELLS, ROWS_PER_BUCKET = 96, 100_000
#: Copies of one row that a task writes.
COPIES_PER_TASK = 100_000

_FIELDS = ("entry", "r1", "r2", "n")
_SKETCH = "bucket long, cell int, held long, entry long, r1 long, r2 long, n long"


def entries(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per distinct row: its columns, ``n`` copies, a 128-bit hash, its bucket and the hash of it all."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    told = [F.col(f"_row.`{c}`") for c in rows.columns]
    # a hash skips what is null, so where that is belongs to it
    hashed = [*told, *(c.isNull() for c in told)]
    grouped = rows.groupBy(F.struct(*columns).alias("_row")).agg(F.count(F.lit(1)).alias("n"))
    return (grouped.withColumn("r1", F.xxhash64(F.lit(1), *hashed)).withColumn("r2", F.xxhash64(F.lit(2), *hashed))
            .withColumn("entry", F.xxhash64("r1", "r2", "n")).withColumn("bucket", F.pmod("r1", F.lit(buckets))))


def _cells(entry: Column, cells: int) -> list[Column]:
    third = cells // 3
    return [(F.pmod(F.shiftrightunsigned(entry, 21 * i).bitwiseAND(0x1FFFFF), F.lit(third)) + i * third).cast("int") for i in range(3)]


def sketch(found: DataFrame, cells: int = CELLS) -> DataFrame:
    """Cells of the buckets that hold entries."""
    placed = found.select("bucket", *_FIELDS, F.explode(F.array(*_cells(F.col("entry"), cells))).alias("cell"))
    return placed.groupBy("bucket", "cell").agg(F.count(F.lit(1)).alias("held"), *(F.bit_xor(c).alias(c) for c in _FIELDS))


def combined(*signed: tuple[DataFrame, int]) -> DataFrame:
    """Sum of sketches with signs; cells that come to nothing are left out."""
    union: DataFrame | None = None
    for cells, sign in signed:
        part = cells.select("bucket", "cell", (F.col("held") * sign).alias("held"), *_FIELDS)
        union = part if union is None else union.unionByName(part)
    summed = union.groupBy("bucket", "cell").agg(F.sum("held").alias("held"), *(F.bit_xor(c).alias(c) for c in _FIELDS))
    return summed.where(" or ".join(f"{c} <> 0" for c in ("held", *_FIELDS)))


def _entry_hash(r1: int, r2: int, n: int) -> int:
    """The same number as ``xxhash64(r1, r2, n)`` of columns."""
    import xxhash

    seed = 42
    for x in (r1, r2, n):
        seed = xxhash.xxh64_intdigest(x.to_bytes(8, "little", signed=True), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def _peeler(cells: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    third = cells // 3

    def peel(group: pd.DataFrame) -> pd.DataFrame:
        bucket, table, out = group["bucket"].iloc[0], {}, []
        for row in group.itertuples(index=False):
            table[row.cell] = [row.held, row.entry, row.r1, row.r2, row.n]
        ready = list(table)
        while ready:
            cell = table.get(ready.pop())
            if cell is None or abs(cell[0]) != 1 or _entry_hash(*map(int, cell[2:])) != cell[1]:
                continue
            side, *fields = map(int, cell)
            out.append((bucket, side, *fields[1:]))
            for i in range(3):
                at = ((fields[0] & (1 << 64) - 1) >> 21 * i & 0x1FFFFF) % third + i * third
                other = table.setdefault(at, [0, 0, 0, 0, 0])
                other[0] -= side
                other[1:] = [int(a) ^ b for a, b in zip(other[1:], fields)]
                if any(other):
                    ready.append(at)
                else:
                    del table[at]
        if table:  # more differences than the cells can tell apart
            out = [(bucket, 0, 0, 0, 0)]
        return pd.DataFrame(out, columns=["bucket", "side", "r1", "r2", "n"])

    return peel


def decoded(difference: DataFrame, cells: int = CELLS) -> DataFrame:
    """bucket, side (1 source, -1 table), r1, r2, n of each entry on one side; side 0: the bucket cannot be peeled."""
    return difference.groupBy("bucket").applyInPandas(_peeler(cells), "bucket long, side int, r1 long, r2 long, n long")


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    return writers.store_decisions(df, work_dir(df.sparkSession, purpose))


def _known(spark: SparkSession, path: str, beside: str, like: T.StructType, cells: int, at_first: int,
           rows_per_bucket: int) -> tuple[DataFrame, int, int]:
    """(sketch of the table, its buckets, its rows), stored or built from the table."""
    rows = tables.read_table(spark, path, like=like)
    n = rows.count()  # from the footers
    last = None
    if tables.exists(spark, f"{beside}/state"):
        last = spark.read.parquet(f"{beside}/state").orderBy(F.desc("version")).first()
    if last is not None and last["rows"] == n and last["cells"] == cells:
        return spark.read.schema(_SKETCH).parquet(f"{beside}/sketch/version={last['version']}"), last["buckets"], n
    buckets = max(1, -(-max(n, at_first) // rows_per_bucket))
    return _stored(sketch(entries(rows, buckets), cells), "sketch"), buckets, n


def append_missing(source: DataFrame, path: str, beside: str, cells: int = CELLS, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Append the multiset difference source - table to the table at ``path``; its sketch is kept below ``beside``.

    Returns what was done per bucket that differs: ``bucket``, ``exact`` (whether rows of the table were read
    for it) and ``appended`` rows.
    """
    spark = source.sparkSession
    old, buckets, n_rows = _known(spark, path, beside, source.schema, cells, source.count(), rows_per_bucket)
    given = _stored(entries(source, buckets), "entries")
    told = _stored(decoded(combined((sketch(given, cells), 1), (old, -1)), cells), "difference")

    # one number per ROWS_PER_BUCKET rows at most
    failed = [r[0] for r in told.where("side = 0").select("bucket").distinct().collect()]
    peeled = told.where("side <> 0").groupBy("bucket", "r1", "r2").agg(
        F.coalesce(F.max(F.when(F.col("side") == 1, F.col("n"))), F.lit(0)).alias("wanted"),
        F.coalesce(F.max(F.when(F.col("side") == -1, F.col("n"))), F.lit(0)).alias("present"))
    known = ["bucket", "r1", "r2", "wanted", "present"]
    changed = peeled.select(*known, F.lit(False).alias("exact"))
    if failed:
        of_failed = F.col("bucket").isin(failed)
        there = entries(tables.read_table(spark, path, like=source.schema), buckets).where(of_failed)
        both = given.where(of_failed).select("bucket", "r1", "r2", F.col("n").alias("wanted")).join(
            there.select("bucket", "r1", "r2", F.col("n").alias("present")), ["bucket", "r1", "r2"], "full")
        both = both.select("bucket", "r1", "r2", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("wanted", "present")))
        changed = changed.unionByName(both.where("wanted <> present").select(*known, F.lit(True).alias("exact")))
    changed = _stored(changed, "changed")
    more = changed.where("wanted > present")
    missing = given.join(more.select("r1", "r2", "present"), ["r1", "r2"])
    step = F.lit(COPIES_PER_TASK).cast("long")
    blocks = missing.select("_row", (F.col("n") - F.col("present")).alias("copies")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / step))))
    copies = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_row", "block").select(
        "_row", F.explode(F.array_repeat(F.lit(0), F.least(step, F.col("copies") - F.col("block") * step).cast("int"))).alias("copy"))
    writers.append_rows(copies.select("_row.*"), path, partition=None)

    # the table's entries of those rows change from (row, present) to (row, wanted)
    def as_entries(count: str) -> DataFrame:
        return more.where(f"{count} > 0").select("bucket", "r1", "r2", F.col(count).alias("n")).withColumn("entry", F.xxhash64("r1", "r2", "n"))

    new = combined((old, 1), (sketch(as_entries("present"), cells), -1), (sketch(as_entries("wanted"), cells), 1))
    added = more.agg(F.coalesce(F.sum(F.col("wanted") - F.col("present")), F.lit(0))).first()[0]
    version = 1
    if tables.exists(spark, f"{beside}/state"):
        version += spark.read.parquet(f"{beside}/state").agg(F.max("version")).first()[0]
    new.write.mode("overwrite").parquet(f"{beside}/sketch/version={version}")
    state = spark.createDataFrame([(version, buckets, cells, n_rows + added)], "version int, buckets long, cells int, rows long")
    state.write.mode("append").parquet(f"{beside}/state")
    return changed.groupBy("bucket", "exact").agg(F.sum(F.greatest(F.col("wanted") - F.col("present"), F.lit(0))).alias("appended"))
