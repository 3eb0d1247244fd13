"""Agent-day productivity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from callops import schema
from callops.functions.numbers import flag, percent, ratio
from callops.functions.text import blank_to_null


def _handled():
    return F.col("total_talk_time") + F.col("total_hold_time") + F.col("total_wrap_time")


def product_report(agent_days: DataFrame, calls: DataFrame) -> DataFrame:
    """Averages and shares per agent and day; ``taged`` counts the agent's calls with a disposition."""
    tagged = calls.groupBy("date", F.col("user").alias("agent_id")).agg(
        F.sum(flag(blank_to_null(F.col("query_typelevel_1")).isNotNull())).alias("taged"))
    handled, attended = _handled(), F.col("call_attended")
    busy = handled + F.col("total_idle_time")
    return (
        agent_days.join(tagged, ["date", "agent_id"], "left")
        .withColumns({
            "avg_time_hold_daily": ratio(F.col("total_hold_time"), attended),
            "avg_wrap_time_daily": ratio(F.col("total_wrap_time"), attended),
            "avg_talk_time_daily": ratio(F.col("total_talk_time"), attended),
            "avg_handling_time_daily": ratio(handled, attended),
            "utilization": percent(busy, F.col("login_duration")),
            "occupancy": percent(handled, busy),
            "wrap_perc": percent(F.col("total_wrap_time"), handled),
            "hold_perc": percent(F.col("total_hold_time"), handled),
            "taged": F.coalesce("taged", F.lit(0)),
        })
        .select(*schema.PRODUCT_REPORT)
    )


def cumulative_scores(product: DataFrame) -> DataFrame:
    """Add the month-to-date occupancy and average handling time of every agent-day."""
    so_far = (Window.partitionBy("agent_id", F.trunc("date", "MM")).orderBy("date")
              .rowsBetween(Window.unboundedPreceding, 0))

    def total(c):
        return F.sum(c).over(so_far)

    handled = _handled()
    return product.withColumns({
        "cumulative_score": percent(total(handled), total(handled + F.col("total_idle_time"))),
        "avg_handling_cumulative_score": ratio(total(handled), total(F.col("call_attended"))),
    })


def month_occupancy(product: DataFrame) -> DataFrame:
    """Occupancy of every agent's month, the score of the monthly categories."""
    handled = _handled()
    return product.groupBy(F.trunc("date", "MM").alias("month"), "agent_id").agg(
        percent(F.sum(handled), F.sum(handled + F.col("total_idle_time"))).alias("score"))


def product_csat_report(product: DataFrame, csat: DataFrame, categories: DataFrame) -> DataFrame:
    """Productivity joined with the agent's survey results of the day and last month's category."""
    survey_counts = ["ftr", "total_calls", "survey_ivr", "csat", "dsat", "neutral", "response_count",
                     "great_service"]
    results = csat.select("date", F.col("user").alias("agent_id"), *survey_counts)
    letters = categories.select(
        F.add_months("month", 1).alias("_month"), "agent_id", "categorie")
    joined = cumulative_scores(product).join(results, ["date", "agent_id"], "left").withColumn(
        "_month", F.trunc("date", "MM")).join(letters, ["_month", "agent_id"], "left")
    shares = {f"{name}_per": percent(F.col(name), F.col("response_count"))
              for name in ("csat", "dsat", "neutral", "great_service")}
    return joined.withColumns({
        **shares,
        "first_call_resolution": percent(F.col("ftr"), F.col("total_calls")),
        "ivr_transfer": percent(F.col("survey_ivr"), F.col("total_calls")),
    }).select(*schema.PRODUCT_CSAT_REPORT)
