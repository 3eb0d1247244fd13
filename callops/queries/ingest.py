"""JSON feeds → landing rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from callops import schema
from callops.functions.text import expected_rows
from callops.operators import hashtree
from callops.operators.checks import audit_rows, key_drift, reconciliation
from callops.plans.flows import FEED_PREFIXES, FEEDS
from callops.plans.star import Star
from callops.queries.registry import query
from callops.session import work_dir
from callops.sources import envelope as env

_AGENT = {
    "agent_id": "user_id::varchar", "call_attended": "floor(value)::bigint::varchar",
    "breaks": "CASE WHEN filled THEN '0' END",
    "tea": "CASE WHEN filled THEN format('{:02d}:{:02d}:15', (minute(ts) + 1) // 60, (minute(ts) + 1) % 60) "
           "ELSE 'own' END",
    "lunch": "CASE WHEN filled THEN format('00:{:02d}:30', hour(ts)) END",
}
_CALL = {
    "lead_id": "event_id::varchar", "status": "event_type", "cust_talk_sec": "floor(value)::bigint::varchar",
    "full_name": "CASE WHEN event_type = 'purchase' THEN 'O`Neil ''' || user_id || '''' "
                 "ELSE 'Ann \"' || user_id || '\"' END",
}


def _landing(columns: list[str], values: dict[str, str]) -> str:
    return ", ".join(f'{values.get(c, "NULL::varchar")} AS "{c}"' for c in columns)


@query(f"""
    SELECT ts::date AS date, {_landing(schema.AGENT_LANDING, _AGENT)}
    FROM (SELECT *, event_type NOT IN ('error', 'signup') AS filled FROM events)""")
def envelope_flatten(star: Star):
    return env.agent_feed(env.parse_envelopes(star.agent_envelopes().drop("event_id")))


@query(f"SELECT ts::date AS date, {_landing(schema.EXPORT_CALL_LANDING, _CALL)} FROM events")
def call_feed_landing(star: Star):
    return env.call_feed(env.parse_envelopes(star.call_envelopes()))


@query("""
    SELECT o_orderdate::date AS date, o_orderkey::varchar AS lead_id, strftime(o_orderdate, '%Y-%m-%d') AS call_date,
           o_custkey::varchar AS phone_number, o_custkey::varchar AS user_id, NULL::varchar AS inbound_group,
           CASE WHEN o_orderstatus = 'F' THEN '[ONeil, ' || o_orderpriority[1] || ', ''9z'']'
                ELSE '[Ann, ' || o_orderpriority[1] || ', "9z"]' END AS ivr_flow,
           'customer ' || o_custkey AS user_full_name
    FROM orders""")
def survey_feed_landing(star: Star):
    return env.survey_feed(env.parse_envelopes(star.survey_envelopes()))


@query("SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE floor(value)::bigint END AS declared FROM events")
def expected_row_count(star: Star):
    """First all-digit word of a message; digits glued to other characters do not count."""
    count = F.floor("value").cast("string")
    message = F.when(F.col("event_type") == "view", F.concat(F.lit("x"), count, F.lit(" rows, none")))
    message = message.otherwise(F.concat(F.lit("found2 "), count, F.lit(" rows 7")))
    return star.table("events").select("event_id", expected_rows(message).alias("declared"))


@query(f"""
    WITH seen AS (SELECT unnest(['lead_id', 'status', 'status', 'cust_talk_sec', 'full_name', 'colour']) AS key FROM events),
    counts AS (SELECT key, count(*) AS rows FROM seen GROUP BY 1),
    allowed AS (SELECT unnest([{", ".join(f"'{c}'" for c in schema.EXPORT_CALL_LANDING)}]) AS key)
    SELECT coalesce(c.key, a.key) AS key, coalesce(rows, 0) AS rows,
           CASE WHEN a.key IS NULL THEN 'dropped' WHEN c.key IS NULL THEN 'missing' ELSE 'kept' END AS status
    FROM counts c FULL JOIN allowed a ON a.key = c.key""")
def schema_drift(star: Star):
    return key_drift(env.received_keys(env.parse_envelopes(star.call_envelopes())), schema.EXPORT_CALL_LANDING)


@query("""
    WITH c AS (SELECT ts::date AS day, count(*) AS n FROM events GROUP BY 1),
    s AS (SELECT o_orderdate::date AS day, count(*) AS n FROM orders GROUP BY 1)
    SELECT coalesce(c.day, s.day) AS day, c.n AS agent_json_rows_count, c.n AS agent_insert_rows_count,
           c.n AS export_json_rows_count, c.n AS export_insert_rows_count, s.n AS csat_json_rows_count,
           s.n AS csat_insert_rows_count
    FROM c FULL JOIN s ON c.day = s.day""")
def reconciliation_summary(star: Star):
    """Declared against stored rows of the three feeds per day, from audits taken the same day."""
    audits = None
    for table, envelopes in (
        ("agent_info_ldb", star.agent_envelopes().drop("event_id")),
        ("daily_exportcall_ldb", star.call_envelopes()),
        ("csat_ldb", star.survey_envelopes()),
    ):
        parsed = env.parse_envelopes(envelopes)
        at = F.to_timestamp_ntz(F.concat(F.col("date").cast("string"), F.lit(" 06:00:00")))
        audit = audit_rows(FEEDS[table](parsed), env.declared_rows(parsed), table, "landing_db", at)
        audits = audit if audits is None else audits.unionByName(audit)
    return reconciliation(audits, FEED_PREFIXES)


_STORED = """
    WITH landed AS (SELECT o_orderdate::date AS date, o_orderstatus AS status, o_orderkey % 1000 AS id FROM orders),
    staged AS (SELECT date, CASE WHEN id % 97 = 3 THEN 'X' ELSE status END AS status, id FROM landed WHERE id % 89 <> 5),
    lost AS (SELECT * FROM landed EXCEPT ALL SELECT * FROM staged), added AS (SELECT * FROM staged EXCEPT ALL SELECT * FROM landed)
"""


@query(_STORED + """
    SELECT *, 'left' AS side, count(*) AS copies FROM lost GROUP BY ALL
    UNION ALL SELECT *, 'right' AS side, count(*) AS copies FROM added GROUP BY ALL""")
def row_reconciliation(star: Star):
    """Rows in which a staged table differs from the landed one; ids and rows repeat, some rows are lost, some changed."""
    landed = star.landed().withColumn("id", F.col("id") % 1000)
    staged = landed.where("id % 89 <> 5").withColumn("status", F.when(F.col("id") % 97 == 3, "X").otherwise(F.col("status")))
    paths = [work_dir(star.spark, name) for name in ("landed", "staged")]
    for rows, path in zip((landed, staged), paths):
        hashtree.write_tree(rows, ["id"], path)
    return hashtree.row_differences(star.spark, *paths)
