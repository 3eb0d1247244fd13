"""Helpers shared by the operators: written intermediate tables and names that cannot clash."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callops.session import work_dir

#: The six ASCII white-space characters of the contracts, ``[\\x20\\x09-\\x0D]``.
WHITE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: later stages depend on files that every executor can read, so a lost executor
    costs a task and not a recomputation of everything before.
    """
    spark = df.sparkSession
    folder = work_dir(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_of(column: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def batches_of(sizes, limit: int):
    """Index ranges ``[start, end)`` over items so that a range's sizes sum to ``limit`` or it is one item."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it.

    On other machines the package comes as usual, installed or with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def free_memory() -> None:
    """Give memory that is not in use back to the system: a Python worker lives on after its task."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def freed(batches):
    """The batches, with the memory of one and its results given back before the next."""
    for batch in batches:
        yield batch
        del batch
        free_memory()


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with a function of this package."""
    importable(df.sparkSession)

    def lean(batches):
        yield from run(batches)
        free_memory()

    return df.mapInArrow(lean, schema)
