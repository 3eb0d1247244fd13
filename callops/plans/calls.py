"""Per-call flags and the call report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from callops import schema
from callops.functions.numbers import flag, percent
from callops.functions.text import blank_to_null, rating_number
from callops.operators.skew import lookup_join
from callops.operators.windows import repeat_contacts


@dataclass(frozen=True)
class CallRules:
    """What the status texts mean and when an answer is in time."""

    abandoned: tuple[str, ...] = ("ABANDON", "DROP")
    outbound: tuple[str, ...] = ("OUTBOUND",)
    survey_yes: str = "Yes"
    answer_within: int = 20
    interval_minutes: int = 30


def interval_of(ts: Column, minutes: int) -> Column:
    """Start minute of the day of the interval a time falls in."""
    minute = F.hour(ts) * 60 + F.minute(ts)
    return (minute - minute % minutes).cast("int")


def interval_label(start: Column, minutes: int) -> Column:
    """``HH:MM-HH:MM``."""
    def clock(m: Column) -> Column:
        return F.format_string("%02d:%02d", F.floor(m / 60) % 24, m % 60)

    return F.concat_ws("-", clock(start), clock(start + minutes))


def with_flags(calls: DataFrame, rules: CallRules) -> DataFrame:
    """Add ans, abandon, outbound (exactly one is 1), count, tagging, survey_ivr, sl, ht, interval."""
    abandon = flag(F.col("status").isin(*rules.abandoned))
    outbound = flag(F.col("status").isin(*rules.outbound))
    return calls.withColumns({
        "abandon": abandon,
        "outbound": outbound,
        "ans": 1 - abandon - outbound,
        "count": F.lit(1),
        "tagging": flag(blank_to_null(F.col("query_typelevel_1")).isNotNull()),
        "survey_ivr": flag(F.col("call_transferred_to_survey_ivr") == rules.survey_yes),
        "extracted_time": F.date_format("call_date", "HH:mm:ss"),
        "extracted_interval": interval_of(F.col("call_date"), rules.interval_minutes),
        "ht": F.col("cust_talk_sec") + F.col("customer_hold_time") + F.col("wrap_up_time"),
    }).withColumn("sl", flag((F.col("ans") == 1) & (F.col("queue_seconds") <= rules.answer_within)))


#: Columns that tell calls apart; they decide how calls without a key are spread.
_ROW = ["call_date", "lead_id", "customer_number", "user"]


def call_outcomes(calls: DataFrame, surveys: DataFrame, rules: CallRules = CallRules()) -> DataFrame:
    """Calls with flags, repeat counts and survey answer.

    A call is resolved at first contact (``ftr``) when it was answered and no other call of the
    customer fell into the seven days up to it.
    """
    return _judged(_looked_up(calls, surveys), rules)


def _looked_up(calls: DataFrame, surveys: DataFrame) -> DataFrame:
    """Calls with repeat counts and survey answer; nothing that follows from the call alone is shuffled."""
    lead = blank_to_null(F.col("lead_id"))
    keyed = calls.withColumn("_lead", lead)
    answers = surveys.withColumn("_lead", lead).where("_lead is not null").groupBy("_lead").agg(
        F.max("survey_rating").alias("survey_feedback"))
    return lookup_join(repeat_contacts(keyed, _ROW), answers, ["_lead"], _ROW).drop("_lead")


def _judged(calls: DataFrame, rules: CallRules) -> DataFrame:
    return with_flags(calls, rules).withColumns({
        "ftr": flag((F.col("ans") == 1) & (F.col("repeat_7days") == 0)),
        "csat": flag(rating_number(F.col("survey_feedback")) >= 4),
    })


def call_report(calls: DataFrame, surveys: DataFrame, quality: DataFrame,
                rules: CallRules = CallRules()) -> DataFrame:
    """Call outcomes with the mean audit score of the call's agent and customer."""
    return judged_report(narrow_report(calls, surveys, quality), rules)


def narrow_report(calls: DataFrame, surveys: DataFrame, quality: DataFrame) -> DataFrame:
    """The call report without what follows from the row alone; this is how rows are shuffled and sorted."""
    audits = quality.dropna(subset=["agent_id", "customer_number"]).groupBy(
        F.col("agent_id").alias("user"), "customer_number",
    ).agg(F.round(F.avg("overall_score"), 2).alias("quality_score"))
    audited = lookup_join(_looked_up(calls, surveys), audits, ["user", "customer_number"], _ROW)
    return audited.select(*[c for c in audited.columns if c in _NEEDED])


#: Columns of the report, and those its flags are made from.
_NEEDED = {*schema.CALL_REPORT, *schema.EXPORT_CALL_STAGING}


def judged_report(rows: DataFrame, rules: CallRules = CallRules()) -> DataFrame:
    return _judged(rows, rules).select(*schema.CALL_REPORT)


def day_report(calls: DataFrame, rules: CallRules = CallRules()) -> DataFrame:
    """Calls, answered, abandoned and service level per day."""
    return with_flags(calls, rules).groupBy("date").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("ans").alias("ans"),
        F.sum("abandon").alias("abandon"),
        F.sum("outbound").alias("outbound"),
        F.sum("sl").alias("sl"),
        percent(F.sum("sl"), F.sum("ans")).alias("sl_per"),
        percent(F.sum("abandon"), F.count(F.lit(1))).alias("abandon_per"),
    )
