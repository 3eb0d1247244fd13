"""Differing rows of two stored tables, found by a tree of sums of row hashes.

Rows go by a hash of their key into leaves, leaves into nodes. A table is written with a folder per node, and
beside it the tree: per leaf the number of rows and the sums of two hashes of whole rows. Two tables are
compared by nodes, then by the leaves of nodes that differ, and only then by rows, of those leaves alone. Equal
tables cost two reads of the trees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NODES, LEAVES = 64, 64
_SUMS = ["rows", "sum1", "sum2"]


def _rows_path(path: str) -> str:
    return f"{path}/rows"


def _tree_path(path: str) -> str:
    return f"{path}/tree"


def write_tree(rows: DataFrame, key: list[str], path: str, nodes: int = NODES, leaves: int = LEAVES) -> None:
    """Store a table by key ranges of hashes, and its tree. Both tables of a comparison need the same numbers.

    ``nodes`` folders, each with ``leaves`` leaves; rows of one key are in one leaf, which many tasks may write.
    """
    place = F.pmod(F.xxhash64(*key), F.lit(nodes * leaves))
    placed = rows.withColumns({"_node": F.floor(place / leaves).cast("int"), "_leaf": place.cast("int")})
    laid = placed.hint("rebalance", "_node").sortWithinPartitions("_node", "_leaf")
    laid.write.mode("overwrite").partitionBy("_node").parquet(_rows_path(path))
    spark = rows.sparkSession
    stored = spark.read.schema(placed.schema).parquet(_rows_path(path))

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in rows.columns]).cast("decimal(20,0)"))

    tree = stored.groupBy("_node", "_leaf").agg(
        F.count(F.lit(1)).alias("rows"), total(1).alias("sum1"), total(2).alias("sum2"))
    tree.coalesce(1).write.mode("overwrite").parquet(_tree_path(path))
    placed.limit(0).write.mode("overwrite").parquet(f"{path}/columns")  # an empty table has no other file


def _unequal(left: DataFrame, right: DataFrame, place: str) -> DataFrame:
    """Places whose sums are not the same on both sides, those that one side lacks included."""
    def sums(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(place).agg(F.struct(*[F.sum(c).alias(c) for c in _SUMS]).alias(side))

    return sums(left, "_l").join(sums(right, "_r"), place, "full").where(~F.col("_l").eqNullSafe(F.col("_r"))).select(place)


def unequal_leaves(spark: SparkSession, left: str, right: str) -> tuple[list[int], DataFrame]:
    """Nodes that differ (a bounded list: ``nodes`` at most), and the leaves in them that do."""
    trees = [spark.read.parquet(_tree_path(p)) for p in (left, right)]
    nodes = sorted(r[0] for r in _unequal(*trees, "_node").collect())
    return nodes, _unequal(*[t.where(F.col("_node").isin(nodes)) for t in trees], "_leaf")


def row_differences(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Rows that one table has more often than the other: the columns, ``side`` (left or right) and ``copies`` more.

    Folders of equal nodes are not read, rows of equal leaves are dropped before the shuffle. NULLs equal
    each other. Both tables have the same columns, of types that can be grouped.
    """
    nodes, leaves = unequal_leaves(spark, left, right)

    def opened(path: str, sign: int) -> DataFrame:
        columns = spark.read.parquet(f"{path}/columns").schema
        stored = spark.read.schema(columns).parquet(_rows_path(path)).where(F.col("_node").isin(nodes))
        return stored.join(leaves, "_leaf", "left_semi").drop("_node", "_leaf").withColumn("_sign", F.lit(sign))

    both = opened(left, 1).unionByName(opened(right, -1))
    columns = [f"`{c}`" for c in both.columns if c != "_sign"]
    counted = both.groupBy(*columns).agg(F.sum("_sign").alias("_more")).where("_more <> 0")
    return counted.select(*columns, F.when(F.col("_more") > 0, "left").otherwise("right").alias("side"), F.abs("_more").alias("copies"))
