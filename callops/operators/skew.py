"""Lookup joins that stay balanced when one key, or a missing key, holds a large share of the rows.

The join is a plain equi-join whose facts side adaptive execution may split: a partition that one key
fills is read by as many tasks as its size in bytes asks for (``advisoryPartitionSizeInBytes``), each
with that key's lookup row. Part sizes are absolute, the number of parts has no limit, nothing is
counted, collected or broadcast, and no job runs while a query is built.

Rows with a missing key match nothing. A hash of the row stands for their key in the shuffle, so they
are dealt over all tasks and never meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """Left join to a lookup with at most one row per key; ``spread_by`` tells facts apart."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    # always null, but not for the optimizer: a constant would be taken out of the join's keys
    none = F.nullif(F.pmod(F.xxhash64(*keys), F.lit(1)), F.lit(0))
    facts = facts.withColumn("_alone", F.when(missing, F.xxhash64(*spread_by)))
    other = lookup.select("*", none.alias("_none")).withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    condition = F.col("_alone").eqNullSafe(F.col("_none"))
    for i, key in enumerate(keys):
        condition = condition & (F.col(key) == F.col(f"_k{i}"))
    return facts.join(other, condition, "left").drop("_alone", "_none", *[f"_k{i}" for i in range(len(keys))])
