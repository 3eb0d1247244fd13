import datetime as d
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from callops.operators import gates
from callops.session import AS_DEALT, settings
from callops.sinks import writers
from callops.sources import tables


def day(n):
    return d.date(2023, 1, n)


def frame(spark, *pairs):
    return spark.createDataFrame([(day(n), v) for n, v in pairs], "date date, v string")


def stored(spark, path):
    return rows(tables.read_table(spark, path, ["date", "v"]))


def test_replace_dates_keeps_other_dates(spark, path):
    writers.replace_dates(frame(spark, (1, "a"), (2, "b"), (2, "c")), path)
    for _ in range(2):  # running again changes nothing
        writers.replace_dates(frame(spark, (2, "new")), path)
        assert stored(spark, path) == [(day(1), "a"), (day(2), "new")]
    assert dict(tables.read_table(spark, path).dtypes)["date"] == "date"


def test_apply_decisions(spark, path, tmp_path):
    writers.replace_dates(frame(spark, (1, "a"), (2, "old"), (9, "gone")), path)
    source = frame(spark, (1, "a"), (2, "x"), (2, "y"), (3, "z"))
    for run in range(2):
        decided = writers.store_decisions(
            gates.count_diff_list(source, tables.read_table(spark, path)), str(tmp_path / f"run{run}"))
        assert decided.count() == (3 if run == 0 else 0)
        writers.apply_decisions(source, decided, path, clean=lambda df: df.withColumn("v", F.upper("v")))
        assert stored(spark, path) == [(day(1), "a"), (day(2), "X"), (day(2), "Y"), (day(3), "Z")]


def test_stored_decisions_do_not_change_after_the_write(spark, path, tmp_path):
    writers.replace_dates(frame(spark, (1, "a")), path)
    source = frame(spark, (2, "b"))
    decided = writers.store_decisions(
        gates.symmetric_diff(source, tables.read_table(spark, path)), str(tmp_path / "decisions"))
    before = rows(decided)
    writers.apply_decisions(source, decided, path)
    assert rows(decided) == before and stored(spark, path) == [(day(2), "b")]


def test_failed_write_leaves_the_old_table(spark, path):
    writers.replace_dates(frame(spark, (1, "a"), (2, "b")), path)
    broken = frame(spark, (1, "new"), (2, "new")).withColumn(
        "v", F.when(F.col("date") == F.lit(day(2)), F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception):
        writers.replace_dates(broken, path)
    assert stored(spark, path) == [(day(1), "a"), (day(2), "b")]


def test_snapshots(spark, path):
    people = spark.createDataFrame([("1", "a"), ("2", "b")], "employeeid string, name string")
    writers.write_snapshot(people, path, "2023-01-01")
    writers.write_snapshot(people.where("employeeid = '2'"), path, "2023-01-02")
    writers.write_snapshot(people.where("employeeid = '2'"), path, "2023-01-02")
    assert rows(tables.read_snapshot(spark, path)) == [("2", "b")]


def test_dates_that_became_empty_are_cleared(spark, path):
    writers.replace_dates(frame(spark, (1, "a"), (2, "b"), (3, "c")), path)
    cover = frame(spark, (1, ""), (2, "")).select("date")
    writers.replace_dates(frame(spark, (1, "new")), path, cover=cover)
    assert stored(spark, path) == [(day(1), "new"), (day(3), "c")]
    writers.replace_dates(frame(spark).where("false"), path, cover=cover)
    assert stored(spark, path) == [(day(3), "c")]


def test_append_new_rows_twice(spark, path):
    writers.replace_dates(frame(spark, (1, "a"), (1, "a")), path)
    source = frame(spark, (1, "a"), (1, "a"), (1, "a"), (2, "b"))
    for _ in range(2):
        writers.append_rows(gates.new_rows(source, tables.read_table(spark, path, ["date", "v"])), path)
        assert stored(spark, path) == [(day(1), "a")] * 3 + [(day(2), "b")]


def test_insert_once(spark, path, tmp_path):
    writers.replace_dates(frame(spark, (1, "a")), path)
    source = frame(spark, (1, "other"), (2, "b"))
    decided = writers.store_decisions(
        gates.insert_if_absent(source, tables.read_table(spark, path)), str(tmp_path / "d"))
    writers.insert_once(source, decided, path)
    assert stored(spark, path) == [(day(1), "a"), (day(2), "b")]


def test_months(spark, path):
    may = spark.createDataFrame([(d.date(2023, 5, 1), "a"), (d.date(2023, 6, 1), "b")], "date date, v string")
    writers.replace_months(may, path)
    writers.replace_months(spark.createDataFrame([(d.date(2023, 6, 9), "c")], "date date, v string"), path)
    assert [r[1] for r in stored(spark, path)] == ["a", "c"]


def test_dual_write(spark, tmp_path):
    history, last = str(tmp_path / "h"), str(tmp_path / "l")
    writers.replace_dates(frame(spark, (1, "a"), (5, "e")), history)
    source = frame(spark, (1, "a"), (2, "b"), (3, "c"), (5, "e"))
    decided = writers.store_decisions(
        gates.count_diff_list(source, tables.read_table(spark, history)), str(tmp_path / "d"))
    reload = decided.where("action = 'reload'").select("date")
    writers.dual_write(source.join(reload, "date", "left_semi"), decided, history, last)
    assert len(stored(spark, history)) == 4
    assert stored(spark, last) == [(day(3), "c")]


def test_quarantine(spark, path):
    bad = frame(spark, (1, "a")).withColumn("broken_rules", F.array(F.lit("x")))
    writers.quarantine(bad, path, "r1")
    writers.quarantine(bad, path, "r1")
    writers.quarantine(bad, path, "r2")
    assert spark.read.parquet(path).count() == 2


def test_read_missing_table(spark, path):
    empty = tables.read_table(spark, path, like=frame(spark).schema)
    assert empty.count() == 0 and not tables.exists(spark, path)


def test_read_dates(spark, path):
    writers.replace_dates(frame(spark, (1, "a"), (2, "b")), path)
    assert rows(tables.read_dates(spark, path, frame(spark, (2, "")), ["date", "v"])) == [(day(2), "b")]


def looked_up(spark):
    """Rows of two dates, one of them big; a key has most of its rows, and some have none. NULL marks what no lookup row is for."""
    facts = [(day(1 + (k % 9 == 0)), "hot" if k % 3 else None if k % 7 == 0 else f"k{k % 50}", k) for k in range(900)] + [(None, "hot", -1)]
    df = spark.createDataFrame(facts, "date date, key string, id int").repartition(6)
    table = (df.dropna().groupBy("date", "key").agg(F.count(F.lit(1)).alias("n"), F.min("id").cast("string").alias("first"))
             .where("key <> 'k13'"))
    counts = df.groupBy("date").agg(F.count(F.lit(1)).alias("source_rows")).withColumn("action", F.lit("reload"))
    return df, table, counts


def test_lookup_of_a_write_equals_a_plain_join(spark, path, monkeypatch):
    monkeypatch.setattr(writers, "ROWS_PER_FILE", 100)
    monkeypatch.setattr(writers, "ROWS_PER_TASK", 60)
    df, table, counts = looked_up(spark)
    df = df.where("date is not null")
    writers.replace_dates(df, path, counts=counts, lookup=writers.Lookup(table, "key", "n"), finish=lambda rows: rows.select("date", "id", "key", "first"))
    want = df.join(table.drop("n"), ["date", "key"], "left").select("id", "key", "first", "date")
    assert rows(spark.read.parquet(path).select("id", "key", "first", "date")) == rows(want)
    # the big date has 800 rows, 533 of them of one key
    files = spark.read.parquet(path).where(F.col("date") == F.lit(day(1))).groupBy(F.input_file_name()).count().select("count").collect()
    assert max(r[0] for r in files) < 300 and len(files) > 3


def test_rows_with_a_lookup_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(writers, "ROWS_PER_TASK", 60)
    df, table, counts = looked_up(spark)
    with settings(spark, AS_DEALT):
        placed = writers._by_date(df.coalesce(1), "date", counts, writers.Lookup(table, "key", "n"))
        plan = placed.sortWithinPartitions("date")._jdf.queryExecution().executedPlan().toString()
    by_place = [x for x in plan.splitlines() if "REPARTITION_BY_NUM" in x and "_part" in x]
    assert len(by_place) == 2 and all(re.search(r"hashpartitioning\(date#\d+, _part#\d+L, 16\)", x) for x in by_place)
    assert rows(placed.select("id", "first")) == rows(df.join(table, ["date", "key"], "left").select("id", "first"))
