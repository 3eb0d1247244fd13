"""Agent productivity."""

from __future__ import annotations

from callops import schema
from callops.operators.windows import quartile_category
from callops.plans import productivity as plan
from callops.plans.calls import call_outcomes
from callops.plans.cleaning import clean_surveys
from callops.plans.csat import csat_agent_daily
from callops.plans.people import with_leader_names, with_people
from callops.plans.star import RULES, Star
from callops.queries.registry import query
from callops.queries.sql import column_list, pct, with_views

#: The day tenure is counted to.
AS_OF = "1996-06-01"

_BAND = f"""CASE WHEN DATE '{AS_OF}' - doj <= 30 THEN '0-30 days' WHEN DATE '{AS_OF}' - doj <= 60 THEN '30-60 days'
    WHEN DATE '{AS_OF}' - doj <= 90 THEN '60-90 days' WHEN DATE '{AS_OF}' - doj <= 120 THEN '90-120 days'
    WHEN DATE '{AS_OF}' - doj <= 180 THEN '120-180 days' ELSE 'Above 180 days' END"""


@query(with_views(f"SELECT {column_list(schema.PRODUCT_REPORT)} FROM product", "product"))
def agent_productivity(star: Star):
    return plan.product_report(star.agent_days(), star.calls())


@query(with_views("""
    SELECT date, agent_id, cumulative_score, avg_handling_cumulative_score FROM cumulative""", "cumulative"))
def agent_cumulative(star: Star):
    product = plan.product_report(star.agent_days(), star.calls())
    return plan.cumulative_scores(product).select(
        "date", "agent_id", "cumulative_score", "avg_handling_cumulative_score")


@query(with_views("SELECT * FROM categories", "categories"))
def abcd_category(star: Star):
    product = plan.product_report(star.agent_days(), star.calls())
    return quartile_category(plan.month_occupancy(product), ["month"], "score")


def product_csat_plan(star: Star):
    product = plan.product_report(star.agent_days(), star.calls())
    calls = call_outcomes(star.calls(), clean_surveys(star.surveys_raw()), RULES)
    categories = quartile_category(plan.month_occupancy(product), ["month"], "score")
    return plan.product_csat_report(product, csat_agent_daily(calls), categories)


_PRODUCT_CSAT = f"""
    SELECT c.*, d.ftr, total_calls, survey_ivr, csat, dsat, neutral, response_count, great_service,
           {pct('csat', 'response_count')} AS csat_per, {pct('dsat', 'response_count')} AS dsat_per,
           {pct('neutral', 'response_count')} AS neutral_per,
           {pct('great_service', 'response_count')} AS great_service_per,
           {pct('d.ftr', 'total_calls')} AS first_call_resolution,
           {pct('survey_ivr', 'total_calls')} AS ivr_transfer, g.categorie
    FROM cumulative c LEFT JOIN csat_daily d ON d.date = c.date AND d."user" = c.agent_id
    LEFT JOIN categories g ON g.agent_id = c.agent_id
        AND g.month = (date_trunc('month', c.date) - INTERVAL 1 MONTH)::date"""


@query(with_views(f"SELECT {column_list(schema.PRODUCT_CSAT_REPORT)} FROM ({_PRODUCT_CSAT})",
                  "cumulative", "csat_daily", "categories"))
def product_csat(star: Star):
    return product_csat_plan(star)


@query(with_views(f"""
    SELECT {column_list(schema.PRODUCT_CSAT_REPORT, 'p.')}, s.team_lead, s.designation, s.role_fit, {_BAND} AS tenure,
           s.manager, s.sr__manager AS sr_manager, s.grid, s.team_lead_name, s.manager_name
    FROM ({_PRODUCT_CSAT}) p LEFT JOIN staff s ON s.employeeid = p.emp_id""",
                  "cumulative", "csat_daily", "categories", "staff"))
def employee_enrichment(star: Star):
    return with_people(product_csat_plan(star), with_leader_names(star.employees()), AS_OF)
