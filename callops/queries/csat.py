"""Customer satisfaction."""

from __future__ import annotations

from callops import schema
from callops.plans import csat as plan
from callops.plans.calls import call_outcomes
from callops.plans.cleaning import clean_surveys
from callops.plans.star import RULES, Star
from callops.queries.registry import query
from callops.queries.sql import column_list, pct, with_views


@query(with_views(f"SELECT {column_list(schema.SURVEY_STAGING)} FROM surveys", "surveys"))
def csat_rating_extract(star: Star):
    return clean_surveys(star.surveys_raw())


@query(with_views(f"SELECT {column_list(schema.CSAT_AGENT_REPORT)} FROM csat_daily", "csat_daily"))
def csat_agent_daily(star: Star):
    return plan.csat_agent_daily(call_outcomes(star.calls(), clean_surveys(star.surveys_raw()), RULES))


@query(f"""
    WITH rated AS (
        SELECT o_orderdate::date AS csat_date, c_mktsegment AS emp_code, upper(max(c_mktsegment)) AS agentname,
               max(c_nationkey::varchar) AS user_id,
               count_if(answered AND o_orderpriority[1] IN ('4', '5'))::bigint AS csat,
               count_if(answered AND o_orderpriority[1] IN ('1', '2'))::bigint AS dsat,
               count_if(answered AND o_orderpriority[1] = '3')::bigint AS neutral,
               count_if(answered)::bigint AS response_count,
               count_if(answered AND o_orderpriority[1] = '5')::bigint AS great_score,
               count_if(o_orderstatus = 'F')::bigint AS ftr, count_if(o_orderstatus = 'O')::bigint AS survey_ivr,
               count(*) AS n
        FROM (SELECT *, o_orderstatus <> 'P' AS answered FROM orders JOIN customer ON c_custkey = o_custkey)
        GROUP BY 1, 2)
    SELECT agentname, csat_date, emp_code, user_id, csat, {pct('csat', 'response_count')} AS csat_per,
           dsat, {pct('dsat', 'response_count')} AS dsat_per, neutral, {pct('neutral', 'response_count')} AS neutral_per,
           response_count, great_score, {pct('great_score', 'response_count')} AS great_score_percen, ftr, survey_ivr,
           {pct('ftr', 'n')} AS first_call_resolution
    FROM rated""")
def csat_score_daily(star: Star):
    return plan.csat_score_daily(star.csat_scores(), star.ftr_ivr())
