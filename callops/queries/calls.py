"""Calls, repeat contacts and intervals."""

from __future__ import annotations

from callops import schema
from callops.operators import windows
from callops.operators.reshape import forecast_long
from callops.plans import calls as plan
from callops.plans import interval
from callops.plans.cleaning import clean_surveys
from callops.plans.star import RULES, Star
from callops.queries.registry import query
from callops.queries.sql import column_list, exact, pct, with_views

_CELLS = f"""
    SELECT date, extracted_interval, count(*) AS count, sum(ans)::bigint AS ans, sum(sl)::bigint AS sl,
           {pct('sum(sl)', 'sum(ans)')} AS sl_per, sum(abandon)::bigint AS abn,
           {exact('sum(ht) FILTER (ans = 1)', 'sum(ans)', 1, 2)} AS aht,
           {exact('sum(queue_seconds) FILTER (ans = 1)', 'sum(ans)', 1, 2)} AS asa,
           sum(repeat_same_day)::bigint AS repeat_same_day, sum(repeat_3days)::bigint AS repeat_3days,
           sum(repeat_7days)::bigint AS repeat_7days
    FROM flagged GROUP BY 1, 2"""


@query(with_views(f"""
    , cells AS ({_CELLS}),
    staff AS (SELECT date + (m // 1440)::int AS date, (m % 1440)::int AS extracted_interval, count(*) AS n
              FROM (SELECT date, unnest(generate_series(shift_start // 30 * 30, shift_end - 1, 30)) AS m FROM shifts)
              GROUP BY 1, 2),
    hourly AS (SELECT ts::date + 7 AS date, hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2),
    planned_days AS (SELECT DISTINCT date FROM hourly)
    SELECT c.date, format('{{:02d}}:{{:02d}}-{{:02d}}:{{:02d}}', c.extracted_interval // 60, c.extracted_interval % 60,
                  (c.extracted_interval + 30) // 60 % 24, (c.extracted_interval + 30) % 60) AS interval,
           coalesce(s.n, 0)::bigint AS roster_emp_count, c.extracted_interval, count, ans, sl, sl_per, abn, aht, asa,
           CASE WHEN p.date IS NOT NULL THEN coalesce(h.n, 0) / 2.0 END::double AS forecast,
           repeat_same_day, repeat_3days, repeat_7days
    FROM cells c LEFT JOIN staff s ON s.date = c.date AND s.extracted_interval = c.extracted_interval
    LEFT JOIN hourly h ON h.date = c.date AND h.hour = c.extracted_interval // 60
    LEFT JOIN planned_days p ON p.date = c.date""", "flagged", "shifts"))
def interval_report(star: Star):
    return interval.interval_report(star.calls(), star.forecast(), star.roster(), RULES)


@query(with_views(f"SELECT {column_list(schema.CALL_REPORT)} FROM (SELECT *, 1 AS count FROM call_rows)", "call_rows"))
def call_insights(star: Star):

    return plan.call_report(star.calls(), clean_surveys(star.surveys_raw()), star.quality(), RULES)


@query(with_views(f"""
    SELECT date, count(*) AS calls, sum(ans)::bigint AS ans, sum(abandon)::bigint AS abandon,
           sum(outbound)::bigint AS outbound, sum(sl)::bigint AS sl, {pct('sum(sl)', 'sum(ans)')} AS sl_per,
           {pct('sum(abandon)', 'count(*)')} AS abandon_per
    FROM flagged GROUP BY 1""", "flagged"))
def abandon_sl_by_day(star: Star):
    return plan.day_report(star.calls(), RULES)


@query("""
    SELECT o_orderkey AS contact_id, o_custkey AS customer_number, o_orderdate::date AS date,
           count(*) OVER (PARTITION BY o_custkey, o_orderdate) - 1 AS repeat_same_day,
           count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate
               RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW) - 1 AS repeat_3days,
           count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate
               RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) - 1 AS repeat_7days
    FROM orders""")
def repeat_contacts(star: Star):
    return windows.repeat_contacts(star.contacts(), ["contact_id"])


@query("""
    SELECT d.date, h.hour::int AS hour, count(e.ts)::double AS forecast
    FROM (SELECT DISTINCT ts::date + 7 AS date FROM events) d CROSS JOIN range(24) h(hour)
    LEFT JOIN events e ON e.ts::date + 7 = d.date AND hour(e.ts) = h.hour
    GROUP BY 1, 2""")
def forecast_unpivot(star: Star):
    return forecast_long(star.forecast())
