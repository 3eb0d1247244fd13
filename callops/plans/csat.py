"""Customer satisfaction per agent and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callops import schema
from callops.functions.numbers import percent
from callops.functions.text import rating_number, upper_name


def _rating_counts(rating: Column, weight: Column | None = None) -> dict[str, Column]:
    """Responses by rating: 1-2 dissatisfied, 3 neutral, 4-5 satisfied, 5 great."""
    weight = F.lit(1) if weight is None else weight

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("bigint")

    return {
        "csat": total(rating.between(4, 5)),
        "dsat": total(rating.between(1, 2)),
        "neutral": total(rating == 3),
        "response_count": total(rating.between(1, 5)),
        "great": total(rating == 5),
    }


def csat_agent_daily(outcomes: DataFrame) -> DataFrame:
    """Resolution, survey transfers and ratings per agent and day, from the call outcomes."""
    counts = _rating_counts(rating_number(F.col("survey_feedback")))
    counts["great_service"] = counts.pop("great")
    return outcomes.groupBy("date", "user").agg(
        F.max("full_name").alias("full_name"),
        F.sum("ftr").alias("ftr"),
        F.count(F.lit(1)).alias("total_calls"),
        F.sum("survey_ivr").alias("survey_ivr"),
        *[c.alias(name) for name, c in counts.items()],
    ).select(*schema.CSAT_AGENT_REPORT)


def csat_score_daily(scores: DataFrame, ftr: DataFrame) -> DataFrame:
    """Ratings per agent and day from the score file, with resolution from the FTR file.

    Both files are reduced to agent-days before they are joined.
    """
    counts = _rating_counts(rating_number(F.col("survey_rating")), F.col("surveycount"))
    counts["great_score"] = counts.pop("great")
    per_agent = scores.groupBy("date", "emp_code").agg(
        F.max(upper_name(F.col("agentname"))).alias("agentname"),
        F.max("user_id").alias("user_id"),
        *[c.alias(name) for name, c in counts.items()],
    )
    resolved = ftr.groupBy("date", F.col("emp_id").alias("emp_code")).agg(
        F.count(F.lit(1)).alias("_calls"),
        F.sum("ftr").alias("ftr"),
        F.sum("survey_transfer").alias("survey_ivr"),
    )
    responses = F.col("response_count")
    return per_agent.join(resolved, ["date", "emp_code"], "left").withColumns({
        "csat_per": percent(F.col("csat"), responses),
        "dsat_per": percent(F.col("dsat"), responses),
        "neutral_per": percent(F.col("neutral"), responses),
        "great_score_percen": percent(F.col("great_score"), responses),
        "first_call_resolution": percent(F.col("ftr"), F.col("_calls")),
    }).withColumnRenamed("date", "csat_date").select(*schema.CSAT_SCORE_REPORT)
