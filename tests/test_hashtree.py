import random
from collections import Counter

from callops.operators import hashtree

SCHEMA = "k long, name string, value double, size int"


def stored(spark, tmp_path, name, rows):
    path = str(tmp_path / name)
    hashtree.write_tree(spark.createDataFrame(rows, SCHEMA), ["k"], path, nodes=8, leaves=16)
    return path


def differences(spark, left, right):
    return {(tuple(r)[:4], r.side): r.copies for r in hashtree.row_differences(spark, left, right).collect()}


def expected(left, right):
    more, less = Counter(left) - Counter(right), Counter(right) - Counter(left)
    return {(r, "left"): n for r, n in more.items()} | {(r, "right"): n for r, n in less.items()}


def test_against_multisets(spark, tmp_path):
    rng = random.Random(3)
    left = [(rng.randrange(200), rng.choice(["a", "b", None, ""]), rng.choice([0.5, None]), 1) for _ in range(500)]
    left += [(None, None, None, None)] * 3 + [(7, "hot", 1.0, 2)] * 1000
    right = left[40:] + [(5, "new", None, 9), (None, "", None, None)] + left[60:70] + [(7, "hot", 1.0, 2)]
    a, b = stored(spark, tmp_path, "a", left), stored(spark, tmp_path, "b", right)
    assert differences(spark, a, b) == expected(left, right)
    assert differences(spark, b, a) == expected(right, left)


def test_null_and_the_place_of_a_value_count(spark, tmp_path):
    """Hashes that pass over NULLs would not tell these apart."""
    left, right = [(1, "x", None, None), (2, None, None, 4)], [(1, None, None, None), (2, "x", None, 4)]
    a, b = stored(spark, tmp_path, "a", left), stored(spark, tmp_path, "b", right)
    assert differences(spark, a, b) == expected(left, right)


def test_equal_and_empty_tables(spark, tmp_path):
    rows = [(k, str(k), k / 2, k) for k in range(300)]
    a, b, none = (stored(spark, tmp_path, n, r) for n, r in (("a", rows), ("b", rows[::-1]), ("none", [])))
    assert hashtree.unequal_leaves(spark, a, b)[0] == [] and differences(spark, a, b) == {}
    assert differences(spark, none, none) == {}
    assert differences(spark, a, none) == expected(rows, [])


def test_only_folders_that_differ_are_read(spark, tmp_path):
    rows = [(k, str(k), k / 2, k) for k in range(2000)]
    changed = [(17, "other", 8.5, 17) if r[0] == 17 else r for r in rows]
    a, b = stored(spark, tmp_path, "a", rows), stored(spark, tmp_path, "b", changed)
    nodes, leaves = hashtree.unequal_leaves(spark, a, b)
    assert len(nodes) == 1 and leaves.count() == 1
    found = hashtree.row_differences(spark, a, b)
    assert {r.side: r.name for r in found.collect()} == {"left": "17", "right": "other"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "(_node#" in plan and f" = {nodes[0]})" in plan and "PartitionFilters: [" in plan
