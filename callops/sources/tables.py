"""Layer tables: Parquet folders partitioned by date."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               like: T.StructType | None = None) -> DataFrame:
    """A table; with the schema ``like`` it may also be empty or not written yet."""
    if like is None:
        table = spark.read.parquet(path)
    elif exists(spark, path):
        table = spark.read.schema(like).parquet(path)
    else:
        table = spark.createDataFrame([], like)
    return table.select(*[f"`{c}`" for c in columns]) if columns else table


def read_dates(spark: SparkSession, path: str, dates: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Only the partitions of the given dates (pruned when the query runs)."""
    return read_table(spark, path, columns).join(dates.select("date"), "date", "left_semi")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot of a dimension; other snapshot folders are not read."""
    table = spark.read.parquet(path)
    newest = table.agg(F.max("snapshot")).scalar()
    return table.where(F.col("snapshot") == newest).drop("snapshot")


def layer_path(root: str, layer: str, table: str) -> str:
    return os.path.join(root, layer, table)
