"""Rosters, shrinkage, adherence."""

from __future__ import annotations

from callops.operators.reshape import roster_days
from callops.plans.adherence import adherence_load, adherence_report
from callops.plans.people import with_leader_names
from callops.plans.shifts import planned_shifts, time_in_shift as time_in_shift_plan
from callops.plans.shrinkage import shrinkage_report
from callops.plans.star import LOGIN_EVENTS, Star
from callops.queries.registry import query
from callops.queries.sql import exact, pct, with_views


@query(with_views("""
    SELECT r.employeeid, r.week + i.i::int AS date, ['mon', 'tue', 'wed', 'thu', 'fri', 'sat', 'sun'][i.i + 1] AS dow,
           coalesce(format('{:02d}:00-{:02d}:00', s.shift_start // 60, s.shift_end // 60 % 24), 'WO') AS day_shift
    FROM roster r CROSS JOIN range(7) i(i)
    LEFT JOIN shifts s ON s.employeeid = r.employeeid AND s.date = r.week + i.i::int""", "roster"))
def roster_unpivot(star: Star):
    return roster_days(star.roster()).select("employeeid", "date", "dow", "day_shift")


@query(with_views(f"""
    SELECT s.date, count(*) AS planned, {pct('count_if(o.date IS NULL AND n.date IS NULL)', 'count(*)')} AS shrinkage_per
    FROM shifts s LEFT JOIN logins o ON o.employeeid = s.employeeid AND o.date = s.date
    LEFT JOIN logins n ON n.employeeid = s.employeeid AND n.date = s.date + 1 AND o.date IS NULL
        AND 1440 + hour(n.first_in) * 60 + minute(n.first_in) < s.shift_end
    GROUP BY 1""", "shifts", "logins"))
def shrinkage_daily(star: Star):
    return shrinkage_report(star.roster(), star.logins())


_DAY = "coalesce(c.date, l.date)"
_WORKED = "epoch(date_trunc('second', last_out))::bigint - epoch(date_trunc('second', first_in))::bigint"


@query(with_views(f"""
    , cells AS (
        SELECT r.*, r.week + i.i::int AS date, [mon, tue, wed, thu, fri, sat, sun][i.i + 1] AS shift
        FROM roster r CROSS JOIN range(7) i(i)),
    breaks AS (SELECT emp_id, date, sum(bio) AS bio, sum(lunch) AS lunch, sum(tea) AS tea FROM agent_days GROUP BY 1, 2),
    worked AS (
        SELECT coalesce(c.employeeid, l.employeeid) AS id, {_DAY} AS day, c.* EXCLUDE (employeeid, date), l.date AS log_date,
               first_in, last_out, c.employeeid AS rostered, {_WORKED} AS w,
               CASE WHEN shift <> 'WO' THEN shift[:2]::int * 60 END AS start_minute
        FROM cells c FULL JOIN logins l ON l.employeeid = c.employeeid AND l.date = c.date)
    SELECT first_in AS first_login_date, last_out AS last_logout_date, id AS employeeid,
           CASE WHEN rostered IS NOT NULL THEN 'Agent ' || id ELSE s.employeename END AS employeename,
           w.shift, CASE WHEN rostered IS NOT NULL THEN '9h' END AS shifts_timings,
           mon, tue, wed, thu, fri, sat, sun, wo::int AS wo, (CASE WHEN rostered IS NOT NULL THEN 0 END)::int AS ph,
           (CASE WHEN rostered IS NOT NULL THEN 0 END)::int AS leaves, total_planned_::int AS total_planned_,
           strftime(first_in, '%H:%M:%S') AS login_details, strftime(last_out, '%H:%M:%S') AS logout_details,
           (first_in IS NOT NULL)::int AS attendance_present, log_date, s.sip,
           CASE WHEN first_in IS NOT NULL AND start_minute IS NOT NULL
                THEN greatest(0, hour(first_in) * 60 + minute(first_in) - start_minute) END::bigint AS late_minutes,
           b.bio::bigint AS bio, b.lunch::bigint AS lunch, b.tea::bigint AS tea,
           strftime(day, '%W')::int AS week_number, day AS date, NULL::varchar AS team_lead,
           (first_in IS NOT NULL AND start_minute IS NULL)::int AS non_rosted_count,
           (start_minute IS NOT NULL)::int AS roster_count, s.manager, s.team_lead AS tl, s.sr__manager,
           s.employeeid AS emp_deatail_id, CASE WHEN first_in IS NOT NULL THEN 'Agent ' || id END AS user_name,
           {exact('w', '3600', 1, 2)} AS total_working_hours,
           {exact('coalesce(b.bio, 0) + coalesce(b.lunch, 0) + coalesce(b.tea, 0)', '3600', 1, 2)} AS total_break_hours,
           {pct('w - (coalesce(b.bio, 0) + coalesce(b.lunch, 0) + coalesce(b.tea, 0))',
                'CASE WHEN start_minute IS NOT NULL THEN 32400 END')} AS schedule_adherence_percentage,
           CASE WHEN start_minute IS NOT NULL THEN 9.0 END::double AS total_hours, id AS emp_id,
           CASE WHEN start_minute IS NOT NULL THEN 100 * (first_in IS NOT NULL)::int END::double
               AS login_adherence_percentage,
           s.team_lead_name, s.manager_name, day AS update_date
    FROM worked w LEFT JOIN breaks b ON b.emp_id = w.id AND b.date = w.day
    LEFT JOIN staff s ON s.employeeid = w.id""", "roster", "logins", "agent_days", "staff"))
def work_adherence(star: Star):
    employees = with_leader_names(star.employees())
    return adherence_load(adherence_report(star.roster(), star.logins(), star.agent_days(), employees))


def _spans(kind: str, events: str, minutes: int) -> str:
    return f"""SELECT user_id::varchar AS employeeid, '{kind}' AS kind, epoch(date_trunc('second', ts))::bigint AS s,
        epoch(date_trunc('second', ts))::bigint + 60 * ({minutes} + floor(value)::bigint) AS e
        FROM events WHERE event_type IN ({events})"""


@query(with_views(f"""
    , spans AS (
        SELECT employeeid, 'plan' AS kind, epoch(date)::bigint + shift_start * 60 AS s, epoch(date)::bigint + shift_end * 60 AS e FROM shifts
        UNION ALL {_spans('login', "'click', 'purchase', 'signup'", 90)} UNION ALL {_spans('pause', "'error'", 10)}),
    parts AS (
        SELECT employeeid, kind, day, greatest(s, day * 86400) AS s, least(e, (day + 1) * 86400) AS e
        FROM (SELECT *, unnest(range(s // 86400, (e - 1) // 86400 + 1)) AS day FROM spans WHERE e > s)),
    points AS (SELECT employeeid, day, s AS t FROM parts UNION SELECT employeeid, day, e FROM parts),
    pieces AS (SELECT *, lead(t) OVER (PARTITION BY employeeid, day ORDER BY t) AS u FROM points),
    covered AS (
        SELECT a.employeeid, a.day, t, u - t AS n, bool_or(kind = 'plan') AS p, bool_or(kind = 'login') AS l, bool_or(kind = 'pause') AS b
        FROM pieces a JOIN parts c ON c.employeeid = a.employeeid AND c.day = a.day AND c.s <= t AND c.e >= u GROUP BY ALL),
    sums AS (
        SELECT employeeid, DATE '1970-01-01' + day::int AS date, coalesce(sum(n) FILTER (p), 0)::bigint AS planned_seconds,
               coalesce(sum(n) FILTER (l AND NOT b), 0)::bigint AS worked_seconds,
               coalesce(sum(n) FILTER (p AND l AND NOT b), 0)::bigint AS inside_seconds,
               coalesce(sum(n) FILTER (l AND NOT b AND NOT p), 0)::bigint AS outside_seconds,
               coalesce(sum(n) FILTER (p AND NOT l), 0)::bigint AS absent_seconds
        FROM covered GROUP BY 1, 2)
    SELECT *, {pct('inside_seconds', 'planned_seconds')} AS inside_per FROM sums""", "shifts"))
def time_in_shift(star: Star):
    """Time worked inside and outside planned shifts; sessions overlap, cross midnight and are cut by pauses."""
    return time_in_shift_plan(planned_shifts(star.roster()), star.sessions(LOGIN_EVENTS, 90), star.sessions(("error",), 10))
