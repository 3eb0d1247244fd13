import datetime
import random
from collections import Counter

from pyspark.sql import functions as F

from callops.operators import overlap
from callops.plans import shifts

ZERO = datetime.datetime(2024, 2, 27)


def at(minute):
    return ZERO + datetime.timedelta(minutes=minute)


def test_against_a_grid_of_minutes(spark):
    rng = random.Random(4)
    rows = []
    for n in range(300):
        start = rng.randrange(3 * 1440)
        rows.append((f"e{n % 4}", rng.choice("abc"), start, start + rng.choice([0, -5, 30, 400, 2000])))
    seen = {k: {(key, m) for key, kind, s, e in rows if kind == k for m in range(s, e)} for k in "abc"}
    want = Counter()
    for name, cells in {"both": seen["a"] & seen["b"], "rest": seen["a"] - seen["b"] - seen["c"]}.items():
        for key, m in cells:
            want[key, at(m).date(), name] += 60
    given = [(k, kind, at(s), at(e)) for k, kind, s, e in rows]
    given += [(None, "a", at(0), at(9)), ("e1", "a", None, at(9)), ("e1", "b", at(3), None), ("only", "c", at(5), at(6))]
    spans = spark.createDataFrame(given, "k string, kind string, start timestamp, end timestamp")
    found = overlap.covered_seconds(spans, "k", {"both": F.col("a") & F.col("b"), "rest": F.col("a") & ~F.col("b") & ~F.col("c")}, list("abc"))
    got = {(r.k, r.day, name): r[name] for r in found.collect() for name in ("both", "rest")}
    assert {k: v for k, v in got.items() if v} == dict(want)
    assert got["only", at(0).date(), "both"] == 0


def test_open_spans_last_until(spark):
    spans = spark.createDataFrame([("x", "a", at(1430), None)], "k string, kind string, start timestamp, end timestamp")
    found = overlap.covered_seconds(spans, "k", {"n": F.col("a")}, ["a"], F.lit(at(1440 + 1440 + 5))).orderBy("day").collect()
    assert [(r.day.day, r.n) for r in found] == [(27, 600), (28, 86_400), (29, 300)]
    assert overlap.covered_seconds(spans, "k", {"n": F.col("a")}, ["a"]).collect() == []


def test_a_night_shift(spark):
    planned = spark.createDataFrame([("7", ZERO.date(), 1320, 1800)], "employeeid string, date date, shift_start int, shift_end int")
    spans = "employeeid string, start timestamp, end timestamp"
    sessions = spark.createDataFrame([("7", at(1300), at(1500)), ("7", at(1400), at(1700))], spans)  # 21:40 to 04:20
    pauses = spark.createDataFrame([("7", at(1430), at(1450))], spans)
    found = {r.date.day: r for r in shifts.time_in_shift(planned, sessions, pauses).collect()}
    minutes = {d: [r[f"{c}_seconds"] // 60 for c in ("planned", "worked", "inside", "outside", "absent")] for d, r in found.items()}
    assert minutes == {27: [120, 130, 110, 20, 0], 28: [360, 250, 250, 0, 100]}
    assert found[28].inside_per == 69.44


def test_a_busy_day_stays_small(spark):
    """However many spans a day has, its window holds a row per second in which one starts or ends."""
    spans = spark.range(200_000).selectExpr(
        "'x' AS k", "'a' AS kind", "timestamp_seconds(1709000000 + id % 50) AS start", "timestamp_seconds(1709000060 + id % 70) AS end")
    assert [r.n for r in overlap.covered_seconds(spans, "k", {"n": F.col("a")}, ["a"]).collect()] == [129]
