"""Landing → staging clean-up of each table: projection, types, names, derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callops import schema
from callops.functions import dates as dt
from callops.functions import numbers as nm
from callops.functions import text as tx


def _date(df: DataFrame, c: str = "date") -> Column:
    return F.col(c) if dict(df.dtypes)[c] == "date" else dt.lenient_date(F.col(c).cast("string"))


def _doubles_without_nan(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f.name: nm.nan_to_null(F.col(f"`{f.name}`"))
        for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")})


def _upper(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, tx.upper_name(F.col(name)))


def readable(c: str, value: Column) -> Column:
    """Whether a text says what it should: nothing, or something that can be read."""
    # nearly all can be read, and no more than this test is spent on them
    return value.isNotNull() | tx.blank_to_null(F.col(c).cast("string")).isNull()


CALL_NUMBERS = ("cust_talk_sec", "customer_hold_time", "wrap_up_time", "queue_seconds")


def agent_rules() -> dict[str, Column]:
    """What must hold of a row of the agent feed, by the name of the fault."""
    durations = {f"{c} unreadable": readable(c, nm.duration_seconds(F.col(c).cast("string"))) for c in schema.AGENT_DURATIONS}
    return durations | {"call_attended unreadable": readable("call_attended", F.col("call_attended").try_cast("bigint"))}


def call_rules() -> dict[str, Column]:
    """What must hold of a row of the call export."""
    numbers = {f"{c} unreadable": readable(c, F.col(c).try_cast("bigint")) for c in CALL_NUMBERS}
    return numbers | {"call_date unreadable": readable("call_date", F.col("call_date").try_cast("timestamp_ntz"))}


def clean_agents(df: DataFrame) -> DataFrame:
    """Agent feed: upper-case names, durations in seconds."""
    seconds = {c: nm.duration_seconds(F.col(c)) for c in schema.AGENT_DURATIONS}
    typed = df.withColumn("call_attended", F.col("call_attended").try_cast("bigint")).withColumns(seconds)
    return _upper(typed, "emp_name").select(*schema.AGENT_STAGING)


def clean_calls(df: DataFrame) -> DataFrame:
    """Call export: 18 columns, numbers typed, upper-case names."""
    numbers = {c: F.col(c).try_cast("bigint")
               for c in CALL_NUMBERS}
    typed = df.withColumns({**numbers, "call_date": F.col("call_date").try_cast("timestamp_ntz")})
    return _upper(typed, "full_name").select(*schema.EXPORT_CALL_STAGING)


def clean_surveys(df: DataFrame) -> DataFrame:
    """Survey feed: the rating is the first whole number of the flow list."""
    return _upper(df, "user_full_name").withColumn(
        "survey_rating", tx.first_integer(F.col("ivr_flow"))).select(*schema.SURVEY_STAGING)


def clean_forecast(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in schema.FORECAST])


def clean_csat_scores(df: DataFrame) -> DataFrame:
    return _upper(df.withColumn("date", _date(df)), "agentname").select(*schema.CSAT_SCORES)


def clean_ftr(df: DataFrame) -> DataFrame:
    return _upper(df.withColumn("date", _date(df)), "full_name").select(*schema.FTR_IVR)


def clean_quality(df: DataFrame) -> DataFrame:
    """Quality audits: names upper-case without no-break spaces, ids trimmed."""
    return df.withColumns({
        "date": _date(df),
        "agent_name": tx.drop_nbsp(F.col("agent_name")),
        "agent_id": tx.strip(F.col("agent_id")),
    }).select(*schema.QUALITY)


def clean_knowledge(df: DataFrame) -> DataFrame:
    return _upper(df.withColumn("date", _date(df)), "Employee_Name_").select(*schema.KNOWLEDGE_TEST)


def clean_training(df: DataFrame) -> DataFrame:
    return _doubles_without_nan(_upper(df.withColumn("date", _date(df)), "name").select(*schema.TRAINING))


def clean_refresher(df: DataFrame) -> DataFrame:
    typed = df.withColumn("date_of_refresher", _date(df, "date_of_refresher"))
    return _doubles_without_nan(_upper(typed, "agent_name").select("date", *schema.REFRESHER))


def clean_roster(df: DataFrame) -> DataFrame:
    return df.withColumn("date", dt.text_date(F.col("date").cast("string"))).select(*schema.ROSTER)


def clean_logins(df: DataFrame, campaign: str = "INBOUND") -> DataFrame:
    return _upper(
        df.where(F.col("campaign_id") == campaign).withColumns({
            "date": dt.text_date(F.col("date").cast("string")),
            "user_id": tx.strip(F.col("user_id")),
        }), "user_name").select(*schema.LOGIN)


def clean_employees(df: DataFrame, columns: list[str] = schema.EMPLOYEES) -> DataFrame:
    trimmed = df.withColumn("employeeid", tx.strip(F.col("employeeid")))
    return _doubles_without_nan(_upper(trimmed, "employeename").select(*columns))


def clean_attrition(df: DataFrame, lob: str) -> DataFrame:
    """One line of business; unreadable dates become NULL."""
    return _upper(df.where(F.col("lob") == lob).withColumn("date", _date(df)), "employeename").select(
        *schema.ATTRITION)
