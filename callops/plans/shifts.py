"""Rostered shifts as time spans, and the intervals they cover."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callops.functions.numbers import percent
from callops.operators.overlap import all_spans, covered_seconds
from callops.operators.reshape import roster_days

#: A roster cell is a shift when it reads ``HH:MM-HH:MM``; anything else (week off, leave) is not.
SHIFT = r"^\s*([0-2]?[0-9]):([0-5][0-9])\s*-\s*([0-2]?[0-9]):([0-5][0-9])\s*$"


def planned_shifts(roster: DataFrame) -> DataFrame:
    """One row per rostered employee and day; an end not after the start lies on the next day."""
    def minutes(first: int):
        return (F.regexp_extract("day_shift", SHIFT, first).cast("int") * 60
                + F.regexp_extract("day_shift", SHIFT, first + 1).cast("int"))

    spans = roster_days(roster).where(F.col("day_shift").rlike(SHIFT)).withColumns({
        "shift_start": minutes(1), "shift_end": minutes(3)})
    return spans.withColumn(
        "shift_end",
        F.when(F.col("shift_end") <= F.col("shift_start"), F.col("shift_end") + 1440)
        .otherwise(F.col("shift_end")))


def rostered_per_interval(shifts: DataFrame, minutes: int) -> DataFrame:
    """Employees on shift per date and interval; the part after midnight counts for the next date."""
    first = F.col("shift_start") - F.col("shift_start") % minutes
    return (
        shifts.select("date", F.explode(F.sequence(first, F.col("shift_end") - 1, F.lit(minutes))).alias("_m"))
        .select(
            F.date_add("date", F.floor(F.col("_m") / 1440).cast("int")).alias("date"),
            (F.col("_m") % 1440).cast("int").alias("extracted_interval"),
        )
        .groupBy("date", "extracted_interval")
        .agg(F.count(F.lit(1)).alias("roster_emp_count"))
    )


def attended(shifts: DataFrame, logins: DataFrame) -> DataFrame:
    """Add first/last login to each shift.

    A login on the shift's date counts. For a shift over midnight with no such login, one on the
    next date before the shift's end counts too. Each login day is offered to two dates, so the
    match is a plain equi-join. Logins match on ``user_id`` = employee id.
    """
    own = logins.select(F.col("user_id").alias("employeeid"), "date", F.col("first_login_date").alias("in0"),
                        F.col("last_logout_date").alias("out0"))
    night = logins.select(
        F.col("user_id").alias("employeeid"), F.date_sub("date", 1).alias("date"), F.col("first_login_date").alias("in1"),
        F.col("last_logout_date").alias("out1"))
    offered = own.unionByName(night, allowMissingColumns=True).groupBy("employeeid", "date").agg(
        F.min("in0").alias("in0"), F.max("out0").alias("out0"),
        F.min("in1").alias("in1"), F.max("out1").alias("out1"))
    login_minute = 1440 + F.hour("in1") * 60 + F.minute("in1")
    use_night = F.col("in0").isNull() & (login_minute < F.col("shift_end"))
    return shifts.join(offered, ["employeeid", "date"], "left").withColumns({
        "first_login_date": F.when(use_night, F.col("in1")).otherwise(F.col("in0")),
        "last_logout_date": F.when(use_night, F.col("out1")).otherwise(F.col("out0")),
    }).drop("in0", "in1", "out0", "out1")


def shift_spans(shifts: DataFrame) -> DataFrame:
    """Planned shifts as ``employeeid``, ``start``, ``end``."""
    midnight = F.unix_timestamp(F.col("date").cast("timestamp"))
    return shifts.select("employeeid", *[F.timestamp_seconds(midnight + F.col(f"shift_{name}") * 60).alias(name)
                                         for name in ("start", "end")])


def time_in_shift(shifts: DataFrame, sessions: DataFrame, pauses: DataFrame, until=None) -> DataFrame:
    """Seconds planned, worked, and worked inside and outside the plan, per employee and day.

    ``sessions`` and ``pauses`` have ``employeeid``, ``start``, ``end`` and may overlap; time in a pause is not worked. All
    spans count on the day they cover, also after midnight; sessions without an end last up to ``until``.
    """
    worked = F.col("login") & ~F.col("pause")
    spans = all_spans({"plan": shift_spans(shifts), "login": sessions, "pause": pauses}, "employeeid")
    return covered_seconds(spans, "employeeid", {
        "planned_seconds": F.col("plan"), "worked_seconds": worked, "inside_seconds": worked & F.col("plan"),
        "outside_seconds": worked & ~F.col("plan"), "absent_seconds": F.col("plan") & ~F.col("login"),
    }, ["plan", "login", "pause"], until).withColumnRenamed("day", "date").withColumn(
        "inside_per", percent(F.col("inside_seconds"), F.col("planned_seconds")))
