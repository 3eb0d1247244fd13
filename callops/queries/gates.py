"""Change detection between two tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from callops.operators import gates
from callops.plans.star import Star
from callops.queries.registry import query

# "landed" and "staged" pairs: all orders against those no longer pending, and line items by
# shipping date against orders by order date.
_ORDERS = """
    WITH s AS (SELECT o_orderdate::date AS date, count(*) AS n FROM orders GROUP BY 1),
    t AS (SELECT o_orderdate::date AS date, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
    c AS (SELECT coalesce(s.date, t.date) AS date, coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows
          FROM s FULL JOIN t ON s.date = t.date)
"""
_SHIPPED = """
    WITH s AS (SELECT l_shipdate::date AS date, count(*) AS n FROM lineitem GROUP BY 1),
    t AS (SELECT o_orderdate::date AS date, count(*) AS n FROM orders GROUP BY 1),
    c AS (SELECT coalesce(s.date, t.date) AS date, coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows
          FROM s FULL JOIN t ON s.date = t.date)
"""


@query(_ORDERS + """
    SELECT *, CASE WHEN source_rows = 0 OR source_rows = target_rows THEN 'skip' ELSE 'reload' END AS action FROM c""")
def gate_count_parity(star: Star):
    return gates.count_parity(star.landed(), star.staged())


@query(_SHIPPED + """
    SELECT *, CASE WHEN source_rows = 0 THEN 'purge' ELSE 'reload' END AS action FROM c
    WHERE source_rows <> target_rows""")
def gate_count_diff_list(star: Star):
    return gates.count_diff_list(star.shipped(), star.landed())


@query(_SHIPPED + """,
    bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM c WHERE source_rows > 0 AND source_rows <> target_rows),
    days AS (SELECT unnest(generate_series(lo::timestamp, hi::timestamp, INTERVAL 1 DAY))::date AS date FROM bounds
             UNION SELECT date FROM c WHERE source_rows = 0)
    SELECT d.date, coalesce(source_rows, 0) AS source_rows, coalesce(target_rows, 0) AS target_rows,
           CASE WHEN coalesce(source_rows, 0) = 0 THEN 'purge' ELSE 'reload' END AS action
    FROM days d LEFT JOIN c ON c.date = d.date""")
def gate_count_diff_range(star: Star):
    return gates.count_diff_range(star.shipped(), star.landed())


@query(_SHIPPED + """
    SELECT *, CASE WHEN source_rows = 0 THEN 'purge' ELSE 'reload' END AS action FROM c
    WHERE source_rows = 0 OR target_rows = 0""")
def gate_symmetric_diff(star: Star):
    return gates.symmetric_diff(star.shipped(), star.landed())


@query(_ORDERS + """
    SELECT *, 'insert' AS action FROM c WHERE target_rows = 0""")
def gate_insert_if_absent(star: Star):
    return gates.insert_if_absent(star.landed(), star.staged())


@query("""
    SELECT l_shipdate::date AS date, l_linestatus AS status FROM lineitem
    EXCEPT ALL SELECT o_orderdate::date, o_orderstatus FROM orders""")
def gate_append_new_rows(star: Star):
    return gates.new_rows(star.shipped().select("date", "status"), star.landed().select("date", "status"))


@query("""
    WITH s AS (SELECT date_trunc('month', l_shipdate)::date AS date, count(*) AS n FROM lineitem GROUP BY 1),
    t AS (SELECT date_trunc('month', o_orderdate)::date AS date, count(*) AS n FROM orders GROUP BY 1)
    SELECT coalesce(s.date, t.date) AS date, coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows,
           CASE WHEN coalesce(s.n, 0) = coalesce(t.n, 0) THEN 'skip' WHEN s.n > 0 THEN 'reload' ELSE 'purge' END AS action
    FROM s FULL JOIN t ON s.date = t.date""")
def gate_month_parity(star: Star):
    return gates.month_parity(star.shipped(), star.landed())


@query(_ORDERS + """
    SELECT d::date AS date, coalesce(source_rows, 0) AS source_rows, coalesce(target_rows, 0) AS target_rows,
           'reload' AS action
    FROM generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) g(d)
    LEFT JOIN c ON c.date = d""")
def gate_always_range(star: Star):
    return gates.always(star.landed(), star.staged(), "1994-12-01", "2001-12-31")


@query(_SHIPPED + """
    SELECT count_if(source_rows <> target_rows) = 0 AS equal, count_if(source_rows <> target_rows)::bigint AS different_dates
    FROM c""")
def gate_same_dates_and_counts(star: Star):
    return gates.same_dates_and_counts(star.shipped(), star.landed())


@query("""
    SELECT o_orderdate::date AS date, count(*) AS rows FROM orders WHERE day(o_orderdate) = 1 GROUP BY 1""")
def gate_month_start(star: Star):
    """Days on which the monthly job would run, with their rows."""
    landed = star.landed()
    return gates.on_month_start(landed, F.col("date")).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
