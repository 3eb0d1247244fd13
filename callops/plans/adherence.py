"""Work adherence: rostered shifts against logins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callops import schema
from callops.functions.dates import monday_week_number
from callops.functions.numbers import flag, percent
from callops.operators.reshape import roster_calendar
from callops.operators.skew import lookup_join
from callops.plans.people import one_per_employee
from callops.plans.shifts import SHIFT

_WORK = ["employeeid", "date"]


def adherence_report(roster: DataFrame, logins: DataFrame, agent_days: DataFrame,
                     employees: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """One row per employee and day that was rostered or logged in.

    The roster row of the day's week is repeated on each day, with the day's own cell as ``shift``.
    Worked time is last logout minus first login, break time is bio + lunch + tea of the agent feed,
    planned time is the shift's length. Logins match on ``user_id`` = employee id.
    ``dates`` limits the report to the given days.
    """
    rostered = roster_calendar(roster)
    sessions = logins.groupBy(F.col("user_id").alias("employeeid"), "date").agg(
        F.max("user_name").alias("user_name"),
        F.min("first_login_date").alias("first_login_date"),
        F.max("last_logout_date").alias("last_logout_date"),
    ).withColumn("log_date", F.col("date"))
    breaks = agent_days.groupBy(F.col("emp_id").alias("employeeid"), "date").agg(
        *[F.sum(c).alias(c) for c in ("bio", "lunch", "tea")])
    if dates is not None:
        days = dates.select("date")
        rostered, sessions, breaks = (df.join(days, "date", "left_semi") for df in (rostered, sessions, breaks))

    people = one_per_employee(employees).select(
        "employeeid", F.col("employeename").alias("_name"), F.col("employeeid").alias("emp_deatail_id"),
        "sip", F.col("team_lead").alias("tl"), "manager", "sr__manager", "team_lead_name", "manager_name")

    # roster rows without an id match nothing: kept out of the joins, where they would meet in one task
    known = rostered.where("employeeid is not null").join(sessions, _WORK, "full").join(breaks, _WORK, "left")
    unknown = rostered.where("employeeid is null")
    joined = lookup_join(
        known.unionByName(unknown, allowMissingColumns=True), people, ["employeeid"], ["date", "employeename"])
    on_shift = F.coalesce(F.col("shift").rlike(SHIFT), F.lit(False))

    def part(group: int):
        return F.when(on_shift, F.regexp_extract("shift", SHIFT, group)).cast("int")

    start, end = part(1) * 60 + part(2), part(3) * 60 + part(4)
    planned = (F.when(end > start, end - start).otherwise(end - start + 1440)) * 60
    came = F.col("first_login_date").isNotNull()
    login_second = (F.hour("first_login_date") * 3600 + F.minute("first_login_date") * 60
                    + F.second("first_login_date"))
    worked = F.unix_timestamp("last_logout_date") - F.unix_timestamp("first_login_date")
    paused = sum((F.coalesce(c, F.lit(0)) for c in ("bio", "lunch", "tea")), F.lit(0))
    present = flag(came & on_shift)
    return joined.withColumns({
        "employeename": F.coalesce("employeename", "_name"),
        "login_details": F.date_format("first_login_date", "HH:mm:ss"),
        "logout_details": F.date_format("last_logout_date", "HH:mm:ss"),
        "attendance_present": flag(came),
        "late_minutes": F.when(came & on_shift, F.greatest(F.lit(0), F.floor((login_second - start * 60) / 60))),
        "week_number": monday_week_number(F.col("date")),
        "roster_count": flag(on_shift),
        "non_rosted_count": flag(came & ~on_shift),
        "total_working_hours": F.round(worked / 3600, 2),
        "total_break_hours": F.round(paused / 3600, 2),
        "total_hours": F.round(planned / 3600, 2),
        "schedule_adherence_percentage": percent(worked - paused, planned),
        "login_adherence_percentage": percent(present, flag(on_shift)),
        "emp_id": F.col("employeeid"),
    }).select(*schema.ADHERENCE_REPORT)


def adherence_load(report: DataFrame, update_date=None) -> DataFrame:
    """Stamp the rows with the day they were made for."""
    stamp = F.col("date") if update_date is None else F.lit(str(update_date)).cast("date")
    return report.withColumn("update_date", stamp)
