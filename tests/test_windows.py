import datetime as d
import random

import pandas as pd
import pytest
from conftest import FOLDER, rows
from pyspark.sql import functions as F

from callops.operators import skew, windows
from callops.plans.star import Star
from callops.queries import QUERIES


def day(n):
    return d.date(2023, 1, 1) + d.timedelta(days=n)


def test_repeat_windows_by_hand(spark):
    calls = spark.createDataFrame([(i, "c", day(n)) for i, n in enumerate([1, 1, 3, 8, 15])],
                                  "id int, customer_number string, date date")
    out = [tuple(r)[3:] for r in windows.repeat_contacts(calls, ["id"]).orderBy("id").collect()]
    assert out == [(1, 1, 1), (1, 1, 1), (0, 2, 2), (0, 0, 1), (0, 0, 0)]


def skewed_calls(spark, n=3000, seed=1):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        who = "hot" if rng.random() < 0.34 else rng.choice([None, "", " "]) if rng.random() < 0.3 else f"c{rng.randrange(300)}"
        data.append((i, who, day(rng.randrange(20))))
    return data, spark.createDataFrame(data, "id int, customer_number string, date date")


def brute_repeats(data):
    out = []
    for i, who, date in data:
        known = who is not None and who.strip() != ""
        near = [sum(1 for _, w, x in data if w == who and 0 <= (date - x).days <= back) - 1 if known else 0
                for back in (0, 2, 6)]
        out.append((i, who, date, *near))
    return sorted(out, key=repr)


def test_repeat_contacts_against_brute_force(spark):
    data, calls = skewed_calls(spark)
    assert rows(windows.repeat_contacts(calls, ["id"])) == brute_repeats(data)


def test_lookup_join_equals_plain_join(spark):
    _, calls = skewed_calls(spark)
    lookup = calls.dropna().groupBy("customer_number").agg(F.max("date").alias("last")).where("customer_number <> 'c7'")
    joined = skew.lookup_join(calls, lookup, ["customer_number"], ["id"])
    assert rows(joined) == rows(calls.join(lookup, "customer_number", "left").select(joined.columns))


#: Adaptive execution's idea of a large partition, for tables of some thousand rows.
SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_key_is_read_by_many_tasks(spark, small_partitions):
    data = [(i, "hot" if i % 3 else f"c{i}") for i in range(20_000)]
    calls = spark.createDataFrame(data, "id int, customer_number string").repartition(16)
    lookup = calls.groupBy("customer_number").agg(F.max("id").alias("last"))
    joined = skew.lookup_join(calls, lookup, ["customer_number"], ["id"])
    sizes = joined.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    assert sum(sizes) == 20_000 and max(sizes) < 8_000  # the hot key has 13,333 rows


def test_rows_without_a_key_are_spread(spark, small_partitions):
    calls = spark.range(20_000).selectExpr("id", "CASE WHEN id % 4 = 0 THEN CAST(id AS STRING) END AS customer_number")
    lookup = calls.where("customer_number IS NOT NULL").groupBy("customer_number").agg(F.max("id").alias("last"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = skew.lookup_join(calls, lookup, ["customer_number"], ["id"]).rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and max(sizes) < 1.3 * 20_000 / len(sizes)


def test_a_query_runs_the_split_path(spark, small_partitions, monkeypatch):
    """A registered query whose joins adaptive execution splits.

    Two thirds of the events get one user and customer, and tables come from many map tasks, as big ones do.
    """
    folder, table = FOLDER.replace("0.001", "0.01"), Star.table

    def hot(self, name):
        df = table(self, name)
        if name == "events":
            often = F.col("event_id") % 3 > 0
            df = df.withColumns({"user_id": F.when(often, F.lit(7)).otherwise(F.col("user_id")),
                                 "props": F.when(often, F.lit('{"k": 7}')).otherwise(F.col("props"))})
        return df.repartition(16)

    monkeypatch.setattr(Star, "table", hot)
    report = QUERIES["call_insights"](spark, folder)
    report.write.format("noop").mode("overwrite").save()
    got = rows(report)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    for k in SMALL:
        spark.conf.unset(k)
    assert got == rows(QUERIES["call_insights"](spark, folder))


@pytest.mark.parametrize("name", ["call_insights", "product_csat", "quality_report", "work_adherence", "abcd_category"])
def test_building_a_query_runs_no_job_on_rows(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build {name}", name)
    QUERIES[name](spark, FOLDER)
    jobs = tracker.getJobIdsForGroup(f"build {name}")
    stages = [tracker.getStageInfo(s) for j in jobs for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading a Parquet schema is a job of one task
    assert all(s is None or s.numTasks == 1 for s in stages) and len(jobs) <= 16


def test_latest_scores_against_merge_asof(spark):
    rng = random.Random(5)
    facts = [(i, "hot" if rng.random() < 0.4 else f"p{rng.randrange(20)}", day(rng.randrange(60))) for i in range(900)]
    scores = [("hot" if rng.random() < 0.2 else f"p{rng.randrange(25)}", day(rng.randrange(60)), float(rng.randrange(100)))
              for _ in range(150)]
    other = scores[:40]
    out = windows.latest_scores(
        spark.createDataFrame(facts, "id int, who string, date date"),
        {"a": spark.createDataFrame(scores, "person string, date date, score double"),
         "b": spark.createDataFrame(other, "person string, date date, score double")},
        ["id"], "who", "date").toPandas().sort_values("id").reset_index(drop=True)

    left = pd.DataFrame(facts, columns=["id", "who", "date"])
    left["date"] = pd.to_datetime(left["date"])
    left = left.sort_values(["date", "id"])
    for name, table in (("a", scores), ("b", other)):
        right = pd.DataFrame(table, columns=["who", "date", name]).groupby(["who", "date"], as_index=False).max()
        right["date"] = pd.to_datetime(right["date"])
        left = pd.merge_asof(left, right.sort_values("date"), on="date", by="who")
    want = left.sort_values("id").reset_index(drop=True)
    for name in ("a", "b"):
        assert out[name].fillna(-1).tolist() == want[name].fillna(-1).tolist()


def test_quartile_category(spark):
    rng = random.Random(9)
    data = [(f"t{rng.randrange(3)}", i, rng.choice([None, 12.34, 12.341, 1e9 * rng.random() ** 9, float(rng.randrange(40)) / 4]))
            for i in range(500)] + [("flat", 500 + i, 7.0) for i in range(5)] + [("nan", 600, float("nan")), ("nan", 601, 1.0)]
    frame = spark.createDataFrame(data, "team string, id int, score double")
    got = {r["id"]: r["categorie"] for r in windows.quartile_category(frame, ["team"], "score").collect()}
    assert len(got) == len(data)
    for team, i, score in data:
        if score is None or score != score:
            assert got[i] is None
            continue
        team_scores = [s for t, _, s in data if t == team and s is not None and s == s]
        better = sum(1 for s in team_scores if s > score)
        assert got[i] == "ABCD"[better * 4 // len(team_scores)]
