"""Building blocks of the checking SQL: the star views once more, in plain SQL."""

from __future__ import annotations

from callops import schema


def exact(numerator: str, denominator: str, factor: int, digits: int) -> str:
    """factor * a / b rounded half up to ``digits`` places, in whole-number arithmetic."""
    scale = 10 ** digits
    a, b = f"({numerator})", f"({denominator})"
    whole = f"((abs({a}) * {factor * scale * 2} + {b}) // (2 * {b}))"
    return f"(CASE WHEN {b} <> 0 THEN sign({a}) * {whole} / {scale}.0 END)::double"


def pct(a: str, b: str) -> str:
    return exact(a, b, 100, 2)


def rat(a: str, b: str, digits: int = 4) -> str:
    return exact(a, b, 1, digits)


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "calls": ((), """
        SELECT ts::date AS date, user_id::varchar AS "user", 'Agent ' || user_id AS full_name,
               ts AS call_date, event_type AS status,
               CASE WHEN event_type = 'signup' THEN 'OUTBOUND' ELSE 'INBOUND' END AS campaign_id,
               CASE WHEN value >= 5 THEN event_type END AS query_typelevel_1,
               CASE WHEN event_type = 'purchase' THEN 'Yes' ELSE 'No' END AS call_transferred_to_survey_ivr,
               user_id::varchar AS emp_id, json_extract_string(props, '$.k') AS phone_number,
               round(value * 100)::bigint AS cust_talk_sec, minute(ts) AS customer_hold_time,
               second(ts) AS wrap_up_time, floor(value)::bigint AS queue_seconds,
               props AS query_type_level_2, CASE WHEN value >= 100 THEN 'long' END AS subquery_type_level_2,
               event_id::varchar AS lead_id, json_extract_string(props, '$.k') AS customer_number
        FROM events"""),
    "flagged": (("calls",), """
        SELECT *, (status = 'error')::int AS abandon, (status = 'signup')::int AS outbound,
               (status NOT IN ('error', 'signup'))::int AS ans,
               (query_typelevel_1 IS NOT NULL)::int AS tagging,
               (call_transferred_to_survey_ivr = 'Yes')::int AS survey_ivr,
               (status NOT IN ('error', 'signup') AND queue_seconds <= 20)::int AS sl,
               cust_talk_sec + customer_hold_time + wrap_up_time AS ht,
               strftime(call_date, '%H:%M:%S') AS extracted_time,
               ((hour(call_date) * 60 + minute(call_date)) // 30 * 30)::int AS extracted_interval,
               count(*) OVER (PARTITION BY customer_number, date) - 1 AS repeat_same_day,
               count(*) OVER (PARTITION BY customer_number ORDER BY date
                   RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW) - 1 AS repeat_3days,
               count(*) OVER (PARTITION BY customer_number ORDER BY date
                   RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) - 1 AS repeat_7days
        FROM calls"""),
    "surveys": ((), """
        SELECT o_orderdate::date AS date, o_custkey::varchar AS user_id, o_orderdate AS call_date,
               o_custkey::varchar AS phone_number,
               CASE WHEN o_orderstatus = 'P' THEN 'NoResponse' ELSE o_orderpriority[1] END AS survey_rating,
               'CUSTOMER ' || o_custkey AS user_full_name, o_orderkey::varchar AS lead_id
        FROM orders"""),
    "call_rows": (("flagged", "surveys"), """
        SELECT f.*, (f.ans = 1 AND f.repeat_7days = 0)::int AS ftr, s.survey_rating AS survey_feedback,
               coalesce(s.survey_rating IN ('4', '5'), false)::int AS csat, q.quality_score
        FROM flagged f
        LEFT JOIN surveys s ON s.lead_id = f.lead_id
        LEFT JOIN (SELECT l_suppkey::varchar AS agent, l_quantity::int::varchar AS customer, """
        + exact("sum(100 - round(l_discount * 100)::bigint)", "count(*)", 1, 2) + """ AS quality_score
                   FROM lineitem GROUP BY 1, 2) q ON q.agent = f."user" AND q.customer = f.customer_number"""),
    "agent_days": ((), """
        SELECT ts::date AS date, user_id::varchar AS agent_id, 'Agent ' || user_id AS emp_name,
               count(*) AS call_attended, user_id::varchar AS emp_id,
               sum(c)::bigint AS login_duration,
               coalesce(sum(c) FILTER (event_type = 'click'), 0)::bigint AS total_talk_time,
               coalesce(sum(c) FILTER (event_type = 'error'), 0)::bigint AS total_break,
               coalesce(sum(c) FILTER (event_type = 'purchase'), 0)::bigint AS total_wrap_time,
               coalesce(sum(c) FILTER (event_type = 'view'), 0)::bigint AS total_hold_time,
               coalesce(sum(c) FILTER (event_type = 'error' AND h < 12), 0)::bigint AS bio,
               coalesce(sum(c) FILTER (event_type = 'error' AND h BETWEEN 12 AND 14), 0)::bigint AS lunch,
               coalesce(sum(c) FILTER (event_type = 'error' AND h > 14), 0)::bigint AS tea,
               coalesce(sum(c) FILTER (event_type = 'signup'), 0)::bigint AS total_idle_time
        FROM (SELECT *, round(value * 100)::bigint AS c, hour(ts) AS h FROM events)
        GROUP BY ts::date, user_id"""),
    "product": (("agent_days", "calls"), f"""
        SELECT a.*, handle, handle + total_idle_time AS busy,
               {rat('total_hold_time', 'call_attended')} AS avg_time_hold_daily,
               {rat('total_wrap_time', 'call_attended')} AS avg_wrap_time_daily,
               {rat('total_talk_time', 'call_attended')} AS avg_talk_time_daily,
               {rat('handle', 'call_attended')} AS avg_handling_time_daily,
               {pct('handle + total_idle_time', 'login_duration')} AS utilization,
               {pct('handle', 'handle + total_idle_time')} AS occupancy,
               {pct('total_wrap_time', 'handle')} AS wrap_perc,
               {pct('total_hold_time', 'handle')} AS hold_perc,
               coalesce(taged, 0)::bigint AS taged
        FROM (SELECT *, total_talk_time + total_hold_time + total_wrap_time AS handle FROM agent_days) a
        LEFT JOIN (SELECT date, "user", count(query_typelevel_1) AS taged FROM calls GROUP BY 1, 2) t
          ON t.date = a.date AND t."user" = a.agent_id"""),
    "cumulative": (("product",), f"""
        SELECT *, {pct('run_handle', 'run_busy')} AS cumulative_score,
               {rat('run_handle', 'run_calls')} AS avg_handling_cumulative_score
        FROM (SELECT *, sum(handle) OVER w AS run_handle, sum(busy) OVER w AS run_busy,
                     sum(call_attended) OVER w AS run_calls
              FROM product
              WINDOW w AS (PARTITION BY agent_id, date_trunc('month', date) ORDER BY date
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""),
    "categories": (("product",), f"""
        SELECT month, agent_id, score,
               'ABCD'[((rank() OVER (PARTITION BY month ORDER BY score DESC) - 1) * 4
                       // count(*) OVER (PARTITION BY month)) + 1] AS categorie
        FROM (SELECT date_trunc('month', date)::date AS month, agent_id, {pct('sum(handle)', 'sum(busy)')} AS score
              FROM product GROUP BY 1, 2)
        WHERE score IS NOT NULL
        UNION ALL
        SELECT date_trunc('month', date)::date, agent_id, NULL, NULL
        FROM product GROUP BY 1, 2 HAVING sum(busy) = 0"""),
    "csat_daily": (("call_rows",), """
        SELECT date, "user", max(full_name) AS full_name, sum(ftr)::bigint AS ftr, count(*) AS total_calls,
               sum(survey_ivr)::bigint AS survey_ivr,
               count_if(survey_feedback IN ('4', '5'))::bigint AS csat,
               count_if(survey_feedback IN ('1', '2'))::bigint AS dsat,
               count_if(survey_feedback = '3')::bigint AS neutral,
               count_if(survey_feedback IN ('1', '2', '3', '4', '5'))::bigint AS response_count,
               count_if(survey_feedback = '5')::bigint AS great_service
        FROM call_rows GROUP BY 1, 2"""),
    "employees": ((), """
        SELECT c.c_custkey AS sl_no, c_mktsegment AS lob, c_custkey::varchar AS employeeid, c_name AS employeename,
               'sip' || c_custkey AS sip, CASE WHEN c_acctbal >= 0 THEN 'F' ELSE 'M' END AS gender,
               c_nationkey::varchar AS team_lead, doj, 'ACTIVE' AS current_status, c_mktsegment AS designation,
               CASE WHEN c_acctbal >= 5000 THEN 'fit' ELSE 'open' END AS role_fit, n_name AS grid,
               n_regionkey::varchar AS manager, r_name AS sr__manager
        FROM customer c LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
        LEFT JOIN (SELECT o_custkey, min(o_orderdate)::date AS doj FROM orders GROUP BY 1) o
          ON o.o_custkey = c.c_custkey"""),
    "staff": (("employees",), """
        SELECT e.*, t.employeename AS team_lead_name, m.employeename AS manager_name
        FROM employees e LEFT JOIN employees t ON t.employeeid = e.team_lead
        LEFT JOIN employees m ON m.employeeid = e.manager"""),
    "shifts": ((), """
        SELECT user_id::varchar AS employeeid, ts::date AS date, (min(hour(ts)) * 60)::int AS shift_start,
               (min(hour(ts)) * 60 + 540)::int AS shift_end
        FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY 1, 2"""),
    "logins": ((), """
        SELECT user_id::varchar AS employeeid, ts::date AS date, min(ts) AS first_in, max(ts) AS last_out
        FROM events WHERE event_type IN ('click', 'purchase', 'signup') GROUP BY 1, 2"""),
    "roster": (("shifts",), """
        SELECT employeeid, date_trunc('week', date)::date AS week, """
        + ", ".join(
            f"coalesce(max(cell) FILTER (isodow(date) = {i + 1}), 'WO') AS {d}" for i, d in enumerate(schema.WEEKDAYS))
        + """, 7 - count(*) AS wo, count(*) AS total_planned_
        FROM (SELECT *, format('{:02d}:00-{:02d}:00', shift_start // 60, shift_end // 60 % 24) AS cell FROM shifts)
        GROUP BY 1, 2"""),
    "audit_items": (("audits",), "SELECT a.*, i.* FROM audits a POSITIONAL JOIN lineitem i"),
    "audits": ((), """
        SELECT l_shipdate::date AS date, 'agent ' || l_suppkey AS agent_name, l_suppkey::varchar AS emp_id,
               l_shipdate AS call_date, 100 - round(l_discount * 100)::int AS overall_score, 100 AS scorable,
               100 - round(l_discount * 100)::int AS scored,
               CASE WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS fatal, NULL::varchar AS tenure,
               month(l_shipdate)::int AS month, weekofyear(l_shipdate)::int AS week, l_linestatus AS qa_name,
               l_linenumber::varchar AS tl_name, CASE WHEN l_returnflag = 'R' THEN 'returned' END AS fatal_reason, """
        + ", ".join(
            f"((l_linenumber + {i}) % 4 = 0)::int AS {m}_count" for i, m in enumerate(schema.QUALITY_MARKS))
        + """
        FROM lineitem"""),
}


def with_views(body: str, *names: str) -> str:
    """``body`` preceded by the views it uses, each once and in order."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in VIEWS[name][0]:
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered) + "\n" + body


def column_list(names: list[str], prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{n}"' for n in names)
