"""Appends by sketches against multiset arithmetic."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from callops.operators import append

SCHEMA = "a string, b long, c string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(spark, path):
    return Counter(map(tuple, spark.read.schema(SCHEMA).parquet(path).collect()))


def sample(seed, n):
    rng = random.Random(seed)
    return [(rng.choice(["x", "y", None, ""]), rng.choice([None, 1, 2, k]), rng.choice(["x", None, f"{k % 50}"])) for k in range(n)]


def test_hash_is_that_of_columns(spark):
    rng = random.Random(1)
    given = [tuple(rng.randint(-2 ** 63, 2 ** 63 - 1) for _ in range(3)) for _ in range(200)] + [(0, -1, 5)]
    rows = spark.createDataFrame(given, "r1 long, r2 long, n long").withColumn("e", F.xxhash64("r1", "r2", "n")).collect()
    assert all(append._entry_hash(r.r1, r.r2, r.n) == r.e for r in rows)


def test_appends_of_changing_sources(spark, tmp_path):
    path, beside = str(tmp_path / "t"), str(tmp_path / "s")
    first = sample(1, 600)
    sources = [first, first, first + sample(2, 12), sample(3, 5) + first[:300], first + [("hot", 1, None)] * 300, first * 2]
    want = Counter()
    for number, rows in enumerate(sources):
        done = append.append_missing(table(spark, rows), path, beside, rows_per_bucket=100).collect()
        before, want = want, want | Counter(rows)
        assert held(spark, path) == want
        assert sum(r.appended for r in done) == sum(want.values()) - sum(before.values())
        if number == 1:
            assert done == []
        if number in (2, 4):  # few new rows: no row of the table is read
            assert done and not any(r.exact for r in done)


def test_a_table_that_changed_on_its_own_is_read_again(spark, tmp_path):
    path, beside = str(tmp_path / "t"), str(tmp_path / "s")
    rows = sample(5, 200)
    append.append_missing(table(spark, rows), path, beside)
    table(spark, [("by hand", 1, "x")]).write.mode("append").parquet(path)  # as if the sketch's write had been lost
    append.append_missing(table(spark, rows + [("by hand", 1, "x"), ("new", 2, None)]), path, beside)
    assert held(spark, path) == Counter(rows + [("by hand", 1, "x"), ("new", 2, None)])


def test_empty(spark, tmp_path):
    path, beside = str(tmp_path / "t"), str(tmp_path / "s")
    assert append.append_missing(table(spark, []), path, beside).collect() == []
    append.append_missing(table(spark, [(None, None, None)] * 3), path, beside)
    assert held(spark, path) == Counter({(None, None, None): 3})


@pytest.mark.parametrize("n", [1, 20, 40])
def test_a_bucket_tells_differences_apart(spark, n):
    """Forty differences in 96 cells are peeled; nothing is lost or made up."""
    found = append.entries(table(spark, [("k", k, None) for k in range(n)]), 1)
    told = append.decoded(append.combined((append.sketch(found), 1), (append.sketch(found.where("_row.b % 3 = 0")), -1))).collect()
    assert {(r.side, r.r1) for r in told} == {(1, r.r1) for r in found.where("_row.b % 3 <> 0").collect()}
