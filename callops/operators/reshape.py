"""Wide hourly and weekday tables ↔ long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callops.schema import FORECAST_HOURS, WEEKDAYS


def forecast_long(wide: DataFrame) -> DataFrame:
    """Columns ``0`` … ``23`` → one row per date and hour."""
    hours = [F.col(f"`{h}`").cast("double").alias(h) for h in FORECAST_HOURS]
    return (
        wide.select("date", *hours)
        .unpivot(["date"], FORECAST_HOURS, "hour", "forecast")
        .withColumn("hour", F.col("hour").cast("int"))
    )


def forecast_wide(rows: DataFrame, value: str = "forecast") -> DataFrame:
    """One row per date and hour → columns ``0`` … ``23``, ``Total``."""
    per_hour = [F.sum(F.when(F.col("hour") == int(h), F.col(value)).otherwise(0)).alias(h) for h in FORECAST_HOURS]
    return rows.groupBy("date").agg(*per_hour, F.sum(value).alias("Total"))


def roster_days(roster: DataFrame) -> DataFrame:
    """Weekday columns → one row per employee and calendar day of the roster row's week."""
    carried = [c for c in roster.columns if c not in WEEKDAYS and c != "date"]
    offsets = F.create_map(*[F.lit(x) for pair in ((d, i) for i, d in enumerate(WEEKDAYS)) for x in pair])
    return (
        roster.withColumn("week_start", F.date_trunc("week", "date").cast("date"))
        .unpivot([*carried, "week_start"], WEEKDAYS, "dow", "day_shift")
        .withColumn("date", F.date_add("week_start", offsets[F.col("dow")]))
    )


def roster_calendar(roster: DataFrame) -> DataFrame:
    """Each roster row once per day of its week, all columns kept; ``shift`` is the day's own cell."""
    week = F.date_trunc("week", "date").cast("date")
    days = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.date_add(week, i))
    cells = F.array(*[F.col(d) for d in WEEKDAYS])
    return roster.withColumn("_day", F.explode(F.arrays_zip(days.alias("date"), cells.alias("shift")))).select(
        "_day.date", "_day.shift", *[c for c in roster.columns if c not in ("date", "shift")])
