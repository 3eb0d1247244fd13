"""Service level per date and interval."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callops import schema
from callops.functions.numbers import percent, ratio
from callops.operators.reshape import forecast_long
from callops.operators.windows import REPEAT_WINDOWS, customer_day_counts, trailing_day_counts
from callops.plans.calls import CallRules, interval_label, with_flags
from callops.plans.shifts import planned_shifts, rostered_per_interval

_CELL = ["date", "extracted_interval"]


def interval_core(calls: DataFrame, rules: CallRules = CallRules()) -> DataFrame:
    """Calls, answers, service level, abandons, average handling time and speed of answer."""
    answered = F.col("ans") == 1
    return with_flags(calls, rules).groupBy(*_CELL).agg(
        F.sum("count").alias("count"),
        F.sum("ans").alias("ans"),
        F.sum("sl").alias("sl"),
        percent(F.sum("sl"), F.sum("ans")).alias("sl_per"),
        F.sum("abandon").alias("abn"),
        ratio(F.sum(F.when(answered, F.col("ht"))), F.sum("ans"), 2).alias("aht"),
        ratio(F.sum(F.when(answered, F.col("queue_seconds"))), F.sum("ans"), 2).alias("asa"),
    )


def interval_repeats(calls: DataFrame, rules: CallRules = CallRules()) -> DataFrame:
    """Repeat calls per interval.

    Calls are counted per customer, date and interval first; the repeat windows then
    see one row per such cell, however many calls one customer makes.
    """
    placed = with_flags(calls, rules).select("customer_number", *_CELL)
    cells = customer_day_counts(placed, "customer_number", "date", ["extracted_interval"])
    # cells of one date are peers in the window, so its sums are those of whole days
    counted = trailing_day_counts(cells, "customer_number", "date", keep=["extracted_interval", "_rows"])
    return counted.groupBy(*_CELL).agg(
        *[F.sum(F.col("_rows") * F.col(name)).alias(name) for name in REPEAT_WINDOWS])


def interval_report(calls: DataFrame, forecast: DataFrame, roster: DataFrame,
                    rules: CallRules = CallRules()) -> DataFrame:
    """The full report: every interval that has calls, with forecast, staff and repeats.

    The hourly forecast is spread evenly over the hour's intervals.
    """
    minutes = rules.interval_minutes
    hourly = forecast_long(forecast).withColumnRenamed("hour", "_hour")
    staff = rostered_per_interval(planned_shifts(roster), minutes)
    share = F.lit(60.0 / minutes)
    return (
        interval_core(calls, rules)
        .join(interval_repeats(calls, rules), _CELL, "left")
        .join(staff, _CELL, "left")
        .withColumn("_hour", F.floor(F.col("extracted_interval") / 60).cast("int"))
        .join(hourly, ["date", "_hour"], "left")
        .withColumns({
            "interval": interval_label(F.col("extracted_interval"), minutes),
            "forecast": F.round(F.col("forecast") / share, 2),
            "roster_emp_count": F.coalesce("roster_emp_count", F.lit(0)),
            **{name: F.coalesce(name, F.lit(0)) for name in REPEAT_WINDOWS},
        })
        .select(*schema.INTERVAL_REPORT)
    )
