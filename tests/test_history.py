import datetime
import random

from pyspark.sql import functions as F

from callops.operators import history
from callops.plans import people


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


def made(spark, seed=1):
    rng = random.Random(seed)
    days = sorted(rng.sample(range(60), 9))
    rows = [(day(d), f"e{k}", rng.choice(["a", "b", None]), rng.choice(["x", "y"])) for d in days for k in range(8) if rng.random() < 0.8]
    rows += rows[:5] + [(day(days[0]), None, "a", "x"), (None, "e1", "a", "x")]
    return days, rows, spark.createDataFrame(rows, "snapshot date, id string, lead string, role string")


def shown(rows, d, key):
    """What the newest snapshot up to the day says of a key."""
    taken = [r[0] for r in rows if r[0] and r[1] and r[0] <= d]
    found = [r[2:] for r in rows if taken and r[0] == max(taken) and r[1] == key]
    return min(found, key=lambda r: [(x is not None, x or "") for x in r]) if found else None


def test_every_day_by_brute_force(spark):
    _, rows, df = made(spark)
    past = history.periods(df, "id", ["lead", "role"])
    facts = [(n, f"e{k}", day(d)) for n, (k, d) in enumerate((k, d) for k in range(9) for d in range(-2, 63))]
    facts += [(9000, None, day(5)), (9001, "e1", None), (9002, "e1", day(30)), (9002, "e1", day(30))]
    given = spark.createDataFrame(facts, "n long, id string, date date")
    found = history.state_of_day(given, past, "id", "date", ["lead", "role", "valid_from"], ["n"]).collect()
    assert len(found) == len(facts)
    for r in found:
        state = shown(rows, r.date, r.id) if r.id and r.date else None
        assert (r.lead, r.role) == (state or (None, None)) and (r.valid_from is None) == (state is None)


def test_periods_are_maximal_and_apart(spark):
    days, rows, df = made(spark, 2)
    found = history.periods(df, "id", ["lead", "role"]).orderBy("id", "valid_from").collect()
    for a, b in zip(found, found[1:]):
        if a.id == b.id:
            assert a.valid_to <= b.valid_from
            assert a.valid_to < b.valid_from or (a.lead, a.role) != (b.lead, b.role)
    newest = {r[1] for r in rows if r[0] == day(days[-1]) and r[1]}
    assert {r.id for r in found if r.valid_to is None} == newest


def test_nothing(spark):
    empty = spark.createDataFrame([], "snapshot date, id string, lead string")
    past = history.periods(empty, "id", ["lead"])
    assert past.collect() == []
    facts = spark.createDataFrame([(1, "a", day(0))], "n long, id string, date date")
    assert [tuple(r) for r in history.state_of_day(facts, past, "id", "date", ["lead"], ["n"]).collect()] == [(1, "a", day(0), None)]


def test_a_past_day_shows_the_lead_of_that_day(spark):
    """The report of a day is made on the next one, with that day's snapshot."""
    columns = {"designation": "d", "role_fit": "r", "manager": "m", "sr__manager": "s", "grid": "g", "team_lead_name": "t", "manager_name": "n"}
    rows = [(day(10), "7", "old"), (day(20), "7", "new"), (day(30), "7", "new")]
    snapshots = spark.createDataFrame(rows, "snapshot date, employeeid string, team_lead string").withColumns(
        {c: F.lit(v) for c, v in columns.items()} | {"doj": F.lit(day(0))})
    report = spark.createDataFrame([(day(d), "7", d) for d in (8, 9, 18, 19, 29, 40)], "date date, emp_id string, n long")
    found = {r.n: (r.team_lead, r.sr_manager) for r in people.with_people_of_day(report, snapshots, "2024-03-01").collect()}
    assert found == {8: (None, None), 9: ("old", "s"), 18: ("old", "s"), 19: ("new", "s"), 29: ("new", "s"), 40: ("new", "s")}
