"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import importlib.util
import os
import re

import pytest
from conftest import FOLDER, rows

from callops import schema
from callops.operators.reshape import forecast_long, forecast_wide, roster_days
from callops.plans import shifts
from callops.plans.star import Star
from callops.queries import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load(name, file):
    spec = importlib.util.spec_from_file_location(name, os.path.join(ROOT, file))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


check = load("check", "tools/check.py")


#: These write tables first; what they return is a plain scan.
LOADS = {n for n in QUERIES if n.endswith("_result") or n.startswith(("staged_", "loaded_", "quarantined_"))} | {"last_batch_rows"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql_and_scales(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name not in LOADS:
        plan = df._jdf.queryExecution().executedPlan().toString()
        # no pairs of all rows, no Python per row, no window over everything, no cut-off
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|CollectLimit|GlobalLimit", plan)
        for line, below in zip(plan.splitlines(), plan.splitlines()[1:] + [""]):
            assert not ("Window [" in line and "SinglePartition" in below)
    result = check.compare(spark, FOLDER, name, df)
    assert result.startswith(f"{name}: ok") and "TYPES" not in result, result


def test_entry(spark):
    entry = load("spark_entry", "__spark_entry__.py")
    assert entry.entry(spark).columns == schema.INTERVAL_REPORT
    assert set(QUERIES) == set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_scans_read_only_needed_columns(spark):
    plan = QUERIES["gate_count_parity"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)) == {
        "struct<o_orderdate:timestamp_ntz>", "struct<o_orderstatus:string,o_orderdate:timestamp_ntz>"}
    assert "Not(EqualTo(o_orderstatus,P))" in plan


# --- properties of the reports -------------------------------------------------------------------
def test_call_flags(spark):
    report = QUERIES["call_insights"](spark, FOLDER)
    assert report.where("ans + abandon + outbound <> count").isEmpty()
    assert report.where("repeat_same_day > repeat_3days or repeat_3days > repeat_7days").isEmpty()
    assert report.where("sl = 1 and ans = 0").isEmpty()
    days = QUERIES["csat_agent_daily"](spark, FOLDER)
    assert days.where("csat + neutral + dsat <> response_count or great_service > csat").isEmpty()


def test_forecast_round_trip(spark):
    long = Star(spark, FOLDER).forecast()
    back = forecast_wide(forecast_long(long))
    cast = [f"cast(`{h}` as double) `{h}`" for h in schema.FORECAST_HOURS]
    assert rows(back.selectExpr("date", *cast)) == rows(long.selectExpr("date", *cast))


def roster(spark, **cells):
    row = {c: None for c in schema.ROSTER} | {"employeeid": "1", "date": "2024-01-03"} | cells
    kinds = ", ".join(f"{c} string" for c in schema.ROSTER)
    return spark.createDataFrame([tuple(row[c] for c in schema.ROSTER)], kinds).selectExpr(
        *[c for c in schema.ROSTER if c != "date"], "cast(date as date) date")


def test_roster_days_and_overnight_shift(spark):
    frame = roster(spark, mon="22:00-07:00", tue="WO", wed="09:00-18:00", sun=" 9:30 - 18:30 ")
    assert roster_days(frame).count() == 7
    planned = shifts.planned_shifts(frame)
    got = {str(r["date"]): (r["shift_start"], r["shift_end"]) for r in planned.collect()}
    assert got == {"2024-01-01": (1320, 1860), "2024-01-03": (540, 1080), "2024-01-07": (570, 1110)}

    def logins(*times):
        return spark.sql(" union all ".join(
            f"select 'n' user_name, '1' user_id, timestamp'{t}' first_login_date, timestamp'{t}' last_logout_date, "
            f"'INBOUND' campaign_id, date'{t[:10]}' date" for t in times))

    def present(*times):
        joined = shifts.attended(planned, logins(*times))
        return sorted(str(r["date"]) for r in joined.where("first_login_date is not null").collect())

    assert present("2024-01-02 00:30:00") == ["2024-01-01"]
    assert present("2024-01-02 08:30:00") == []  # the shift is over
    assert present("2024-01-01 22:05:00", "2024-01-03 09:00:00") == ["2024-01-01", "2024-01-03"]

    staff = {(str(r["date"]), r["extracted_interval"]) for r in shifts.rostered_per_interval(planned, 30).collect()}
    assert ("2024-01-01", 1410) in staff and ("2024-01-02", 390) in staff and ("2024-01-02", 420) not in staff
    assert len(staff) == 18 * 3 and ("2024-01-07", 570) in staff


def test_adherence_by_hand(spark):
    from callops.plans.adherence import adherence_report

    nobody = roster(spark, employeeid=None, wed="09:00-18:00")
    planned = roster(spark, mon="WO", wed="09:00-18:00").unionByName(nobody)
    logins = spark.sql("""
        select 'n' user_name, '1' user_id, timestamp'2024-01-03 09:20:30' first_login_date,
               timestamp'2024-01-03 18:20:30' last_logout_date, 'INBOUND' campaign_id, date'2024-01-03' date
        union all select 'n', '1', timestamp'2024-01-01 10:00:00', timestamp'2024-01-01 11:00:00', 'INBOUND',
               date'2024-01-01'""")
    days = spark.sql("select date'2024-01-03' date, '1' emp_id, 600L bio, 1800L lunch, 0L tea")
    staff = spark.createDataFrame(
        [("1", "Name", "sip", "t", "m", "s", "T", "M")],
        "employeeid string, employeename string, sip string, team_lead string, manager string, sr__manager string, "
        "team_lead_name string, manager_name string")
    report = adherence_report(planned, logins, days, staff)
    assert report.count() == 14 and report.where("employeeid is null").count() == 7
    one = {str(r["date"]): r for r in report.where("employeeid = '1'").collect()}
    wed, mon, tue = one["2024-01-03"], one["2024-01-01"], one["2024-01-02"]
    assert (wed["late_minutes"], wed["total_working_hours"], wed["total_break_hours"]) == (20, 9.0, 0.67)
    assert (wed["schedule_adherence_percentage"], wed["login_adherence_percentage"]) == (92.59, 100.0)
    assert (wed["roster_count"], wed["non_rosted_count"], wed["attendance_present"]) == (1, 0, 1)
    assert (mon["roster_count"], mon["non_rosted_count"], mon["late_minutes"]) == (0, 1, None)
    assert (tue["attendance_present"], tue["roster_count"], tue["employeename"]) == (0, 0, "Name")
