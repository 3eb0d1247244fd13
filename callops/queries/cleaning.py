"""Cleaning rules on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from callops.functions import dates as dt
from callops.functions import numbers as nm
from callops.functions import text as tx
from callops.plans.star import Star
from callops.queries.registry import query

_OVERFLOW = "hour(ts) * 3600 + json_extract_string(props, '$.k')::int * 60 + floor(value)::int"


@query(f"""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a'
        ELSE format('{{:02d}}:{{:02d}}:{{:02d}}', t // 3600, t // 60 % 60, t % 60) END AS duration
    FROM (SELECT *, {_OVERFLOW} AS t FROM events)""")
def duration_normalise(star: Star):
    return star.durations().select("event_id", nm.normalise_duration(F.col("duration")).alias("duration"))


@query(f"""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN ({_OVERFLOW})::double END AS seconds FROM events""")
def duration_seconds(star: Star):
    return star.durations().select("event_id", nm.duration_seconds(F.col("duration")).alias("seconds"))


@query("""
    SELECT doc_id, CASE WHEN contains(t, '''') THEN translate(t, '''"', '`''') ELSE t END AS text, source, lang
    FROM (SELECT *, replace(text, 'é', '''') AS t FROM documents)""")
def quote_sanitise_a(star: Star):
    return tx.sanitise_rows(star.notes(), tx.quotes_to_backtick)


@query("""
    SELECT doc_id, CASE WHEN contains(t, '''') THEN replace(replace(t, '''', ''), '"', '''') ELSE t END AS text,
           source, lang
    FROM (SELECT *, replace(text, 'é', '''') AS t FROM documents)""")
def quote_sanitise_b(star: Star):
    return tx.sanitise_rows(star.notes(), tx.quotes_dropped)


@query("""
    WITH u AS (SELECT *, upper(replace(text, 'ß', 'SS')) AS up FROM documents)
    SELECT doc_id, up AS upper_name, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS stripped,
           replace(up, 'È', '') AS without_nbsp,
           replace(regexp_replace(text, '[^\\x00-\\x7F]+', '', 'g'), ' ', '') AS ascii_id
    FROM u""")
def name_clean(star: Star):
    """Whole texts as names; è stands for the no-break space, as text in half of the rule's cases."""
    docs = star.table("documents")
    blurred = F.replace(F.col("text"), F.lit("è"), F.lit("\\xa0"))
    blurred = F.replace(blurred, F.lit("È"), F.lit(" "))
    return docs.select(
        "doc_id",
        tx.upper_name(F.col("text")).alias("upper_name"),
        tx.strip(F.concat(F.lit("\t "), "text", F.lit(" \n"))).alias("stripped"),
        tx.drop_nbsp(blurred).alias("without_nbsp"),
        tx.ascii_only(F.col("text")).alias("ascii_id"),
    )


@query("""
    SELECT DISTINCT d AS date, lower(strftime(d, '%a')) AS weekday, strftime(d, '%W')::int AS week_number,
           strftime(d, '%d-%m-%Y') AS day_first, d - 1 AS yesterday, d - 2 AS two_before, d - 6 AS six_before,
           date_trunc('month', d)::date AS month, day(d) = 1 AS is_month_start,
           d > make_date(1998, 5, 5) AS after_cutoff, date_trunc('month', d) = DATE '1998-03-01' AS in_month
    FROM (SELECT o_orderdate::date AS d FROM orders)""")
def calendar_fields(star: Star):
    d = F.col("date")
    return star.landed().select("date").distinct().select(
        "date",
        dt.weekday_abbr(d).alias("weekday"),
        dt.monday_week_number(d).alias("week_number"),
        dt.day_first_text(d).alias("day_first"),
        dt.days_before(d, 1).alias("yesterday"),
        dt.days_before(d, 2).alias("two_before"),
        dt.days_before(d, 6).alias("six_before"),
        dt.month_start(d).alias("month"),
        dt.is_month_start(d).alias("is_month_start"),
        dt.after_cutoff(d, "1998-03-15").alias("after_cutoff"),
        dt.in_month(d, "1998-03-15").alias("in_month"),
    )


@query("""
    SELECT event_id, CASE WHEN value >= 100 THEN sqrt(value - 100) END AS root FROM events""")
def nan_to_null(star: Star):
    return star.table("events").select("event_id", nm.nan_to_null(F.sqrt(F.col("value") - 100)).alias("root"))
