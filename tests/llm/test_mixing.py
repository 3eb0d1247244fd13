import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from callops.llm import mixing
from llm_samples import FOLDER, ODD, table  # noqa: F401


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def fill(sizes, weights, share, repeats):
    """Targets by resharing the excess until no target is above its source's limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        left = budget - sum(repeats * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * left / total > repeats * sizes[s]}
        if not over:
            return {s: repeats * sizes[s] if s in full else weight[s] * left / total for s in names}
        full |= over


def cases():
    rows = [(None, "a b", "s1", 0), (1, None, "s1", 0), (2, "", None, 0), (3, ODD, None, 0), (3, ODD, None, 0), (4, "x " * 20_000, "Z", 0)]
    return rows + [(10 + k, "w " * (k % 50 + 1), f"s{k % 7 if k % 3 else 0}", 0) for k in range(3000)]


@pytest.mark.parametrize("range_rows", [50, 100_000])
def test_targets_and_taken(table, range_rows):
    docs = table(cases(), "doc_id long, text string, source string, target int")
    rows = mixing.report(docs, (3, 1, 2), 1.5, 2, range_rows=range_rows).collect()
    assert len(rows) == len(cases())
    source = {(k, words(t)): s for k, t, s, _ in cases()}
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for k, t, s, _ in cases():
        sizes[s] += words(t)
        longest[s] = max(longest[s], words(t))
    goals = fill(sizes, (3, 1, 2), 1.5, 2)
    for r in rows:
        s = source[r.doc_id, r["size"]]
        assert r.source_size == sizes[s] and r.target == pytest.approx(goals[s])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - goals[s]) <= 2 * max(longest.values())
        assert s == "Z" or abs(taken[s] - goals[s]) <= 2 * longest[s]
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())


def test_same_again_and_any_range_width(table):
    docs = table(cases(), "doc_id long, text string, source string, target int")
    runs = [sorted(map(tuple, mixing.report(d, (3, 1, 2), 1.5, 2, range_rows=n).collect()), key=repr)
            for d, n in ((docs, 50), (docs.repartition(7), 50), (docs, 100_000))]
    assert runs[0] == runs[1] == runs[2]


def test_rows_of_the_mix(table):
    docs = table(cases(), "doc_id long, text string, source string, target int")
    mixed = mixing.mix(docs, (3, 1, 2), 1.5, 2)
    assert mixed.columns == docs.columns
    sent = sum(words(r.text) for r in mixed.collect())
    assert sent == sum(r.taken for r in mixing.report(docs, (3, 1, 2), 1.5, 2).collect())


def test_empty_tables(table):
    schema = "doc_id long, text string, source string, target int"
    assert mixing.report(table([], schema), (3, 1, 2), 1.5, 2).collect() == []
    silent = table([(1, None, "a", 0), (2, " ", None, 0)], schema)
    assert [(r["size"], r.target, r.taken) for r in mixing.report(silent, (3, 1, 2), 1.5, 2).collect()] == [(0, 0.0, 0)] * 2


def test_a_row_repeated_very_often(spark):
    """A third of all rows is one row: its source still comes within a document of its target."""
    rows = spark.range(9000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "a b c d e").otherwise("one two").alias("text"),
        F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "y").otherwise("z").alias("source"), F.col("id").alias("place"))
    found = mixing.report(rows, (3, 1, 2), 1.5, 2, range_rows=500)
    sums = found.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(found.collect()) == 9000
    assert {round(r["target"]) for r in sums} == {round(t) for t in fill({"x": 15000, "y": 6000, "z": 6000}, (3, 1, 2), 1.5, 2).values()}
    taken = {r["doc_id"]: r["taken"] for r in found.groupBy("doc_id").agg(F.sum("taken").alias("taken")).collect()}
    goals = fill({"x": 15000, "y": 6000, "z": 6000}, (3, 1, 2), 1.5, 2)
    assert abs(taken[0] - goals["x"]) <= 10
    for s, rest in (("y", 1), ("z", 2)):
        assert abs(sum(t for k, t in taken.items() if k and k % 3 == rest) - goals[s]) <= 4
    again = mixing.report(rows.repartition(3), (3, 1, 2), 1.5, 2, range_rows=500)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))
    mixed = mixing.mix(rows, (3, 1, 2), 1.5, 2)
    assert mixed.columns == rows.columns
    assert mixed.where("source = 'x'").count() * 5 == taken[0]
