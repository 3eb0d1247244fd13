"""Employee dimension."""

from __future__ import annotations

from pyspark.sql import functions as F

from callops.operators import history
from callops.plans import people as plan
from callops.plans.cleaning import clean_attrition, clean_employees
from callops.plans.star import Star
from callops import schema
from callops.queries.productivity import _BAND, AS_OF
from callops.queries.registry import query
from callops.queries.sql import column_list, with_views


@query(with_views(f"SELECT {_BAND} AS tenure, count(*) AS employees FROM employees GROUP BY 1", "employees"))
def tenure_band_counts(star: Star):
    return plan.tenure_counts(star.employees(), AS_OF)


@query(with_views("SELECT * FROM staff", "staff"))
def employee_names_selfjoin(star: Star):
    return plan.with_leader_names(star.employees())


@query(with_views(f"""
    SELECT {column_list(schema.EMPLOYEES_SHORT)} FROM (SELECT * REPLACE (upper(employeename) AS employeename)
    FROM employees) WHERE lob = 'BUILDING'""", "employees"))
def employee_slice(star: Star):
    """The employees of one line of business, 12 columns."""
    return clean_employees(star.employees().where("lob = 'BUILDING'"), schema.EMPLOYEES_SHORT)


@query("""
    SELECT o_custkey::varchar AS employeeid, 'EMPLOYEE ' || o_custkey AS employeename, 'supervisor' AS supervisor,
           NULL::varchar AS attrited_from_, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::date END AS date,
           o_orderpriority AS attrition_type, NULL::varchar AS reasons, NULL::varchar AS category_,
           NULL::varchar AS resons, NULL::varchar AS ielevate_updated, c_mktsegment AS lob
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'""")
def attrition_slice(star: Star):
    return clean_attrition(star.attrition(), "BUILDING")


_HISTORY = """
    WITH each AS (
        SELECT date_trunc('month', o_orderdate)::date AS snapshot, o_custkey::varchar AS employeeid, o_orderpriority AS team_lead,
               o_orderstatus AS designation, row_number() OVER (
                   PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderpriority, o_orderstatus) AS k
        FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL),
    days AS (SELECT snapshot, row_number() OVER (ORDER BY snapshot) AS n, lead(snapshot) OVER (ORDER BY snapshot) AS next
             FROM (SELECT DISTINCT snapshot FROM each)),
    placed AS (
        SELECT each.*, n, next, n - row_number() OVER (PARTITION BY employeeid, team_lead, designation ORDER BY n) AS island
        FROM each JOIN days USING (snapshot) WHERE k = 1),
    history AS (
        SELECT employeeid, min(snapshot) AS valid_from,
               CASE WHEN max(n) < (SELECT max(n) FROM days) THEN max(next) END AS valid_to, team_lead, designation
        FROM placed GROUP BY employeeid, team_lead, designation, island)
"""


@query(_HISTORY + "SELECT * FROM history")
def employee_history(star: Star):
    """Periods in which an employee had the same lead and designation, out of monthly snapshots."""
    return history.periods(star.staff_snapshots(), "employeeid", ["team_lead", "designation"])


@query(_HISTORY + """
    SELECT f.*, team_lead, designation, valid_from
    FROM (SELECT o_orderkey AS id, o_custkey::varchar AS employeeid, o_orderdate::date + 20 AS date FROM orders) f
    LEFT JOIN history h ON h.employeeid = f.employeeid AND date >= valid_from AND (valid_to IS NULL OR date < valid_to)""")
def people_of_day(star: Star):
    """Lead and designation each employee had 20 days after each order."""
    past = history.periods(star.staff_snapshots(), "employeeid", ["team_lead", "designation"])
    facts = star.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("employeeid"),
                                        F.date_add(F.to_date("o_orderdate"), 20).alias("date"))
    return history.state_of_day(facts, past, "employeeid", "date", ["team_lead", "designation", "valid_from"], ["id"])
