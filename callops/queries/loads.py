"""Write modes: each query writes to the work folder, loads, and reads the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from callops import schema
from callops.functions import dates as dt
from callops.operators import append, checks, gates
from callops.plans.cleaning import clean_employees, readable
from callops.plans.star import Star
from callops.queries.registry import query
from callops.queries.sql import column_list, with_views
from callops.session import work_dir
from callops.sinks import writers
from callops.sources import tables

# Two versions of a table: calls as they are, and an outdated copy that lies a week later.
_VERSIONS = """
    WITH fresh AS (SELECT ts::date AS date, event_type AS status, event_id::varchar AS lead_id FROM events),
    stale AS (SELECT date + 7 AS date, upper(status) AS status, lead_id FROM fresh),
    s AS (SELECT date, count(*) AS n FROM fresh GROUP BY 1), t AS (SELECT date, count(*) AS n FROM stale GROUP BY 1),
    c AS (SELECT coalesce(s.date, t.date) AS date, coalesce(s.n, 0) AS sn, coalesce(t.n, 0) AS tn
          FROM s FULL JOIN t ON s.date = t.date)
"""


def _versions(star: Star):
    fresh = star.calls().select("date", "status", "lead_id")
    stale = fresh.select(F.date_add("date", 7).alias("date"), F.upper("status").alias("status"), "lead_id")
    return fresh, stale


def _written(star: Star, purpose: str, df) -> str:
    path = work_dir(star.spark, purpose)
    writers.replace_dates(df, path)
    return path


@query(_VERSIONS + """
    SELECT * FROM fresh WHERE date IN (SELECT date FROM c WHERE sn > 0 AND sn <> tn)
    UNION ALL SELECT * FROM stale WHERE date IN (SELECT date FROM c WHERE sn = tn)""")
def replace_dates_result(star: Star):
    """Reload every date whose count differs, purge vanished dates, keep the rest."""
    fresh, stale = _versions(star)
    path = _written(star, "replace", stale)
    decided = writers.store_decisions(
        gates.count_diff_list(fresh, tables.read_table(star.spark, path)), work_dir(star.spark, "decisions"))
    writers.apply_decisions(fresh, decided, path)
    return tables.read_table(star.spark, path, ["date", "status", "lead_id"])


@query(_VERSIONS + """
    SELECT * FROM stale UNION ALL SELECT * FROM fresh WHERE date IN (SELECT date FROM c WHERE tn = 0)""")
def insert_once_result(star: Star):
    fresh, stale = _versions(star)
    path = _written(star, "once", stale)
    decided = writers.store_decisions(
        gates.insert_if_absent(fresh, tables.read_table(star.spark, path)), work_dir(star.spark, "decisions"))
    writers.insert_once(fresh, decided, path)
    return tables.read_table(star.spark, path, ["date", "status", "lead_id"])


@query("""
    WITH s AS (SELECT ts::date AS date, event_type AS status FROM events),
    t AS (SELECT date + 7 AS date, status FROM s)
    SELECT * FROM t UNION ALL (SELECT * FROM s EXCEPT ALL SELECT * FROM t)""")
def append_rows_result(star: Star):
    """Append the rows the target lacks, duplicates counted."""
    fresh, _ = _versions(star)
    rows = fresh.select("date", "status")
    path = _written(star, "append", rows.withColumn("date", F.date_add("date", 7)))
    writers.append_rows(gates.new_rows(rows, tables.read_table(star.spark, path, ["date", "status"])), path)
    return tables.read_table(star.spark, path, ["date", "status"])


_GROWING = """
    WITH s AS (SELECT event_type AS status, user_id, NULL::varchar AS note, event_id FROM events),
    old AS (SELECT status, user_id, note FROM s WHERE event_id % 50 <> 0), new AS (SELECT status, user_id, note FROM s)"""


def _growing(star: Star):
    """Rows that repeat, twice: first without every fiftieth event, then all of them."""
    rows = star.table("events").select("event_id", F.col("event_type").alias("status"), "user_id", F.lit(None).cast("string").alias("note"))
    path, beside = work_dir(star.spark, "appended"), work_dir(star.spark, "sketch")
    done = [append.append_missing(some.drop("event_id"), path, beside) for some in (rows.where("event_id % 50 <> 0"), rows, rows)]
    return tables.read_table(star.spark, path), done


@query(_GROWING + "SELECT * FROM old UNION ALL (SELECT * FROM new EXCEPT ALL SELECT * FROM old)")
def append_by_sketch(star: Star):
    """Rows that the table lacks are told from its sketch; running again appends nothing."""
    return _growing(star)[0].select("status", "user_id", "note")


@query(_GROWING + """
    SELECT 'first' AS run, count(*) AS appended FROM old UNION ALL SELECT 'second', (SELECT count(*) FROM new) - (SELECT count(*) FROM old)
    UNION ALL SELECT 'third', 0""")
def appended_by_sketch(star: Star):
    """How many rows each run appended."""
    out = None
    for name, done in zip(("first", "second", "third"), _growing(star)[1]):
        row = done.agg(F.coalesce(F.sum("appended"), F.lit(0)).alias("appended")).select(F.lit(name).alias("run"), "appended")
        out = row if out is None else out.unionByName(row)
    return out


@query("""
    WITH s AS (SELECT l_shipdate::date AS date, l_linestatus AS status, l_orderkey AS id FROM lineitem),
    t AS (SELECT o_orderdate::date AS date, o_orderstatus AS status, o_orderkey AS id FROM orders),
    c AS (SELECT coalesce(a.m, b.m) AS m, coalesce(a.n, 0) AS sn, coalesce(b.n, 0) AS tn
          FROM (SELECT date_trunc('month', date) AS m, count(*) AS n FROM s GROUP BY 1) a
          FULL JOIN (SELECT date_trunc('month', date) AS m, count(*) AS n FROM t GROUP BY 1) b ON a.m = b.m)
    SELECT * FROM s WHERE date_trunc('month', date) IN (SELECT m FROM c WHERE sn > 0 AND sn <> tn)
    UNION ALL SELECT * FROM t WHERE date_trunc('month', date) IN (SELECT m FROM c WHERE sn = tn)""")
def replace_months_result(star: Star):
    """Reload whole months whose count differs."""
    spark = star.spark
    path = work_dir(spark, "months")
    writers.replace_months(star.landed(), path)
    fresh = star.shipped()
    decided = writers.store_decisions(
        gates.month_parity(fresh, tables.read_table(spark, path)), work_dir(spark, "decisions"))
    writers.apply_decisions(
        fresh.withColumn("month", dt.month_start(F.col("date"))), decided, path, partition="month")
    return tables.read_table(spark, path, ["date", "status", "id"])


@query(with_views(f"""
    SELECT {column_list(schema.EMPLOYEES)} FROM (SELECT * REPLACE (upper(employeename) AS employeename)
    FROM employees)""", "employees"))
def snapshot_result(star: Star):
    """Two full reloads of the employee table; the newer one is read."""
    path = work_dir(star.spark, "employees")
    people = star.employees()
    writers.write_snapshot(people, path, "2024-01-01")
    writers.write_snapshot(clean_employees(people), path, "2024-01-02")
    return tables.read_snapshot(star.spark, path).select(*schema.EMPLOYEES)


@query(_VERSIONS + """
    SELECT * FROM fresh WHERE date = (SELECT max(date) FROM c WHERE sn > 0 AND sn <> tn)""")
def last_batch_rows(star: Star):
    """Reload differing dates and keep the newest of them as the last batch."""
    spark = star.spark
    fresh, stale = _versions(star)
    history, last = _written(star, "history", stale), work_dir(spark, "last")
    decided = writers.store_decisions(
        gates.count_diff_list(fresh, tables.read_table(spark, history)), work_dir(spark, "decisions"))
    reload = decided.where("action = 'reload'").select("date")
    writers.dual_write(fresh.join(reload, "date", "left_semi"), decided, history, last)
    return tables.read_table(spark, last, ["date", "status", "lead_id"])


@query("""
    WITH given AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'not yet' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
                          CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' WHEN o_orderkey % 5 = 0 THEN '' ELSE o_custkey::varchar END AS number
                   FROM orders)
    SELECT *, concat_ws(', ', CASE WHEN date = 'not yet' THEN 'date unreadable' END,
                        CASE WHEN number = 'n/a' THEN 'number unreadable' END) AS reasons FROM given""")
def quarantine_split(star: Star):
    """All rows, with what is wrong with those set aside: dates and numbers that cannot be read."""
    key = F.col("o_orderkey")
    rows = star.table("orders").select(
        key.alias("id"),
        F.when(F.col("o_orderstatus") == "P", "not yet").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(key % 7 == 0, "n/a").when(key % 5 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("number"))
    good, bad = checks.split_valid(rows, {
        "date unreadable": dt.lenient_date(F.col("date")).isNotNull(),
        "number unreadable": readable("number", F.col("number").try_cast("bigint"))})
    return good.withColumn("reasons", F.lit("")).unionByName(
        bad.withColumn("reasons", F.array_join("broken_rules", ", ")).drop("broken_rules"))


@query("""
    WITH fresh AS (SELECT ts::date AS date, event_type AS status, event_id::varchar AS lead_id FROM events)
    SELECT date, upper(status) AS status, lead_id FROM fresh WHERE date <> (SELECT min(date) FROM fresh)""")
def always_replace_result(star: Star):
    """All dates written again; the one that lost all its rows in the source is cleared."""
    fresh, _ = _versions(star)
    path = _written(star, "always", fresh)
    days = fresh.select("date").distinct()
    first = fresh.agg(F.min("date").alias("date"))
    writers.replace_dates(fresh.join(first, "date", "left_anti").withColumn("status", F.upper("status")), path, cover=days)
    return tables.read_table(star.spark, path, ["date", "status", "lead_id"])
