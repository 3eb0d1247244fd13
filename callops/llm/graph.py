"""Connected components by alternating star contractions, all in DataFrames."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from callops.llm.common import written


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the links a-b, without the least nodes themselves."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)  # hang the larger roots below the smaller ones
        np.minimum.at(new, label[y], least)
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def _hang(links: DataFrame, both_ways: bool) -> DataFrame:
    """Give the neighbours of each node to the least of them: the larger ones, or the smaller ones."""
    if both_ways:
        links = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    if both_ways:
        moved = (links.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")))
    else:
        moved = (links.join(least, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
    return moved.distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v): every linked node with the least node of its component, without the least nodes.

    ``links`` has two long columns. Each round is two aggregations and two joins over the links that
    are left, written to the shared folder; rounds grow with the logarithm of the longest path. Links
    of a node to itself count for nothing, repeated links once.
    """
    a, b = links.columns
    links = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col("u") != F.col("v")).distinct())
    links, before = written(links, "links"), None
    while True:
        after = links.agg(F.count("*"), F.sum(F.hash("u", "v")), F.sum(F.xxhash64("v", "u").bitwiseAND(0xFFFFFFFF))).first()
        if after == before or not after[0]:
            return links
        before = after
        links = written(_hang(_hang(links, True), False), "links")
