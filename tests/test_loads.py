"""Load queries on tables whose rows are built here."""

import datetime as d

import pyarrow as pa
import pytest
from conftest import FOLDER, rows

from callops.operators import checks
from callops.plans import calls, flows, quality
from callops.plans.cleaning import clean_surveys
from callops.plans.star import Star
from callops.queries import QUERIES
from callops.sinks import writers
from callops.sources import large

LINEITEM = "l_suppkey long, l_shipdate timestamp_ntz, l_returnflag string, l_linestatus string, l_quantity double, l_tax double"
SHIPPED = [d.datetime(1992, 1, 2), d.datetime(1994, 3, 31), d.datetime(1995, 12, 31), d.datetime(1995, 12, 31),
           d.datetime(1996, 1, 1), d.datetime(1998, 11, 30)]


@pytest.mark.parametrize("name, score", [("staged_training", "same_day_assessment_score"), ("staged_refresher", "assessment_scores")])
def test_all_months_are_staged(spark, tmp_path, name, score):
    table = spark.createDataFrame([(7, day, "R", "O", 5.0, 0.05) for day in SHIPPED], LINEITEM)
    table.write.parquet(str(tmp_path / "lineitem.parquet"))
    staged = QUERIES[name](spark, str(tmp_path))
    assert rows(staged.select("date", "emp_id", score)) == [(day.date(), "7", 5.0) for day in SHIPPED]


def test_a_run_over_all_months_purges_a_vanished_one(spark, tmp_path):
    star_rows = "date date, emp_id string, name string, same_day_assessment_score double"
    months = [d.date(1995, 1, 5), d.date(1996, 2, 6)]
    run = flows.Run(spark, str(tmp_path), "1996-02-28", "first")

    def land(days):
        landed = spark.createDataFrame([(day, "7", "n", 1.0) for day in days], star_rows)
        none = {c: flows.F.lit(None).cast("string") for c in flows.schema.TRAINING if c not in landed.columns}
        landed.withColumns(none).write.mode("overwrite").parquet(run.path("landing", "tni_efficacy"))

    for days in (months, months, months[1:]):
        land(days)
        flows.stage_training(run, all_months=True)
        assert rows(run.staging("tni_efficacy_sdb").select("date")) == [(day,) for day in days]


def test_marks_are_shuffled_as_bits(spark):
    marks = flows.schema.QUALITY_MARKS
    plain = {c: flows.F.lit("1") for c in flows.schema.QUALITY if c not in (*marks, "date", "agent_id")}
    texts = {m: flows.F.lit(["no", "NO", "0", "yes", None][i % 5]).cast("string") for i, m in enumerate(marks)}
    audits = spark.createDataFrame([(d.date(2024, 1, 5), "7"), (d.date(2024, 1, 5), None)], "date date, agent_id string").withColumns(plain | texts)
    days = "date date, {} string, {} double"
    knowledge, training = (spark.createDataFrame([(d.date(2024, 1, 4), "7", 3.0)], days.format(*c)) for c in (
        ("Emp_Code_", "Assessment_Scores"), ("emp_id", "same_day_assessment_score")))
    refresher = training.select(flows.F.col("date").alias("date_of_refresher"), "emp_id", flows.F.lit(4.0).alias("assessment_scores"))
    people = spark.createDataFrame([], ", ".join(f"{c} string" for c in (
        "employeeid", "role_fit", "manager", "sr__manager", "grid", "team_lead", "team_lead_name", "manager_name")))
    packed = quality.packed_report(audits, knowledge, training, refresher, people)
    assert not [c for c in packed.columns if c.endswith("_count")]
    report = quality.unpacked(packed)
    assert report.columns == flows.schema.QUALITY_REPORT
    assert {tuple(r) for r in report.select(*[f"{m}_count" for m in marks]).collect()} == {
        tuple(int(i % 5 < 3) for i in range(len(marks)))}
    assert rows(report.select("emp_id", "pkt_scores", "bq_scores")) == [("7", 3.0, 4.0), (None, None, None)]


def test_rejected_rows_are_found_by_the_scan(spark, path):
    spark.createDataFrame([(d.date(2024, 1, 5),), (None,)], "date date").write.parquet(path)
    landed = spark.read.parquet(path)
    good, bad = checks.split_valid(landed, flows._dated(landed))
    assert "IsNull(date)" in bad._jdf.queryExecution().executedPlan().toString()
    assert rows(good) == [(d.date(2024, 1, 5),)] and rows(bad) == [(None, ["date unreadable"])]


def test_tasks_of_a_write_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(writers, "ROWS_PER_TASK", 10)
    counts = spark.createDataFrame([(d.date(2024, 1, 1), 100, "reload"), (d.date(2024, 1, 2), 900, "skip")], "date date, source_rows long, action string")
    placed = writers._by_date(spark.createDataFrame([(d.date(2024, 1, 1),)], "date date"), "date", counts)
    assert "REPARTITION_BY_NUM" in (plan := placed._jdf.queryExecution().executedPlan().toString()) and ", 10), REPARTITION" in plan


def test_flags_of_calls_are_not_shuffled(spark):
    star = Star(spark, FOLDER)
    narrow = calls.narrow_report(star.calls(), clean_surveys(star.surveys_raw()), star.quality())
    assert not {"ans", "abandon", "outbound", "count", "tagging", "sl", "ht", "csat", "ftr"} & set(narrow.columns)
    assert calls.judged_report(narrow).columns == flows.schema.CALL_REPORT


def test_pieces_without_lists_are_scanned_together():
    batch = pa.RecordBatch.from_pydict({
        "value": ['{"data": [{"a": 1', ', {"a": 2', ', {"a": 3', "]", "x"], "file": ["f"] * 4 + ["g"], "start": [0, 0, 0, 9, 0], "size": [9] * 5})
    assert [(place, piece) for place, piece, _ in large._runs([batch])] == [
        (("f", 0), '{"data": [{"a": 1}'), (("f", 0), ', {"a": 2}, {"a": 3}'), (("f", 9), "]}"), (("g", 0), "x}")]
