"""The daily loads: each query lands tables, runs the loads in the work folder, and reads a table back.

Tables are landed as the feeds bring them, numbers and times as text. The SQL is that of the plan
behind the load, with names in upper case where staging makes them so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callops import schema
from callops.plans import flows
from callops.plans.cleaning import clean_surveys
from callops.plans.people import with_leader_names
from callops.plans.star import RULES, Star
from callops.queries.registry import ORACLES, query
from callops.queries.sql import column_list, with_views
from callops.session import work_dir
from callops.sinks import writers
from callops.sources import tables

#: The days of the events.
FIRST, LAST, AS_OF = "2024-01-01", "2024-01-31", "2024-02-01"


def _text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) if c != "date" else F.col(c) for c in df.columns])


def _clock(c: str):
    s = F.col(c)
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def _run(star: Star, run_id: str = "first", root: str | None = None) -> flows.Run:
    return flows.Run(star.spark, root or work_dir(star.spark, "layers"), AS_OF, run_id, FIRST, LAST, RULES, lob="BUILDING")


def _land(run: flows.Run, layer: str = "landing", **landed: DataFrame) -> None:
    for name, df in landed.items():
        df.write.mode("overwrite").parquet(run.path(layer, name))


def _agents(star: Star) -> DataFrame:
    return _text(star.agent_days().withColumns({c: _clock(c) for c in schema.AGENT_DURATIONS}))


def _report(run: flows.Run, name: str, columns: list[str]) -> DataFrame:
    return tables.read_table(run.spark, run.path("reporting", name)).select(*columns)


#: Durations are staged as seconds with fractions.
_SECONDS = ", ".join(f"{c}::double AS {c}" for c in schema.AGENT_DURATIONS)


def _upper(name: str, sql: str) -> str:
    return f"SELECT * REPLACE (upper({name}) AS {name}) FROM ({sql})"


@query(with_views(f"""
    SELECT {column_list(schema.AGENT_STAGING)}
    FROM (SELECT * REPLACE (upper(emp_name) AS emp_name, {_SECONDS}) FROM agent_days)""", "agent_days"))
def staged_agents(star: Star):
    """Agent feed, staged twice."""
    run = _run(star)
    _land(run, agent_info_ldb=_agents(star))
    for number in ("first", "second"):
        flows.stage_agents(_run(star, number, run.root))
    return run.staging("agent_info_sdb").select(*schema.AGENT_STAGING)


def _broken(star: Star, every: int) -> DataFrame:
    """Landed calls, the talk time of one in ``every`` no number."""
    broken = F.when(F.col("lead_id").cast("bigint") % every == 0, "n/a").otherwise(F.col("cust_talk_sec").cast("string"))
    return _text(star.calls().withColumn("cust_talk_sec", broken))


@query(with_views(_upper("full_name", f"SELECT {column_list(schema.EXPORT_CALL_STAGING)} FROM calls WHERE lead_id::bigint % 10 <> 0"), "calls"))
def staged_calls(star: Star):
    """Call feed; one call in ten has a talk time that is no number and goes to quarantine."""
    run = _run(star)
    _land(run, daily_exportcall_ldb=_broken(star, 10))
    flows.stage_calls(run)
    return run.staging("exportcall_sdb").select(*schema.EXPORT_CALL_STAGING)


def _aside(run: flows.Run) -> DataFrame:
    rows = run.spark.read.parquet(run.path("quarantine", "daily_exportcall_ldb"))
    return rows.select("lead_id", F.array_join("broken_rules", ", ").alias("reasons"))


@query(with_views("""
    SELECT lead_id, 'cust_talk_sec unreadable' AS reasons FROM calls WHERE lead_id::bigint % 10 = 0""", "calls"))
def quarantined_calls(star: Star):
    """One entry per bad row, however often the load runs."""
    run = _run(star)
    _land(run, daily_exportcall_ldb=_broken(star, 10))
    for number in ("first", "second", "third"):
        flows.stage_calls(_run(star, number, run.root))
    return _aside(run)


@query(with_views("""
    SELECT lead_id, CASE WHEN lead_id::bigint % 20 = 0 THEN 'cust_talk_sec unreadable' ELSE 'staged' END AS reasons FROM calls""", "calls"))
def repaired_calls(star: Star):
    """Half of the bad rows are sent again in order: they leave quarantine and are staged."""
    run = _run(star)
    for number, every in (("first", 10), ("second", 20)):
        again = _run(star, number, run.root)
        _land(again, daily_exportcall_ldb=_broken(star, every))
        flows.stage_calls(again)
    return _aside(run).unionByName(run.staging("exportcall_sdb").select("lead_id", F.lit("staged").alias("reasons")))


def _envelope_files(star: Star, folder: str) -> None:
    """One envelope file per date, a line per call."""
    rows = star.call_envelopes().select("date", F.regexp_extract("body", r'"data": \[(.*)\]\}$', 1).alias("line"))
    counts = rows.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    head = F.concat(F.lit('{"message": "Total '), F.col("n").cast("string"), F.lit(' rows found", "data": [null'))
    lines = counts.select("date", F.lit(0).alias("part"), head.alias("line")).unionByName(
        rows.select("date", F.lit(1).alias("part"), F.concat(F.lit(",  "), "line").alias("line"))).unionByName(
        counts.select("date", F.lit(2).alias("part"), F.lit("]}").alias("line")))
    lines.repartition("date").sortWithinPartitions("date", "part").select("date", "line").write.partitionBy("date").text(folder)


def _landed_range(star: Star) -> flows.Run:
    """Envelope files of the report days, read by many tasks, landed twice."""
    run, incoming = _run(star), work_dir(star.spark, "incoming")
    _envelope_files(star, f"{incoming}/daily_exportcall_ldb")
    for hour in ("06", "07"):
        flows.land_feeds(run, incoming, f"{AS_OF} {hour}:00:00", split_files=True)
    return run


@query(ORACLES["call_feed_landing"])
def landed_calls(star: Star):
    """Landing rows with the date of their folder; landing again replaces them."""
    return _landed_range(star).landing("daily_exportcall_ldb").select("date", *schema.EXPORT_CALL_LANDING)


@query(f"""
    SELECT ts::date AS date, hour, count(*) AS json_rows, count(*) AS inserted_rows
    FROM events, (VALUES (6), (7)) h(hour) GROUP BY 1, 2""")
def landed_audit(star: Star):
    """Declared against stored rows of every date and run."""
    audit = _landed_range(star).landing("status_ldb")
    return audit.select("date", F.hour("timestamp").alias("hour"), "json_rows", "inserted_rows")


@query(with_views(f"SELECT {column_list(schema.SURVEY_STAGING)} FROM surveys", "surveys"))
def staged_surveys(star: Star):
    run = _run(star)
    _land(run, csat_ldb=star.surveys_raw())
    flows.stage_surveys(run)
    return run.staging("csat_info_sdb").select(*schema.SURVEY_STAGING)


@query("""
    SELECT date, count(*) AS rows FROM (SELECT DISTINCT ts::date + 7 AS date FROM events)
    WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' AND date <> DATE '2024-01-20' GROUP BY 1""")
def staged_forecast(star: Star):
    """Always replaced: a day that the source lost is gone after the second run."""
    run = _run(star)
    for keep in ("true", "date <> DATE '2024-01-20'"):
        _land(run, forecast=star.forecast().where(keep))
        flows.stage_forecast(run)
    return run.staging("forecast_sdb").groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


def _stage_product(star: Star) -> flows.Run:
    run = _run(star)
    _land(run, agent_info_ldb=_agents(star), daily_exportcall_ldb=_text(star.calls()))
    flows.stage_agents(run)
    flows.stage_calls(run)
    return run


@query(with_views(f"""
    SELECT {column_list([*schema.PRODUCT_REPORT, "cumulative_score", "avg_handling_cumulative_score"])}
    FROM (SELECT * REPLACE (upper(emp_name) AS emp_name, {_SECONDS}) FROM cumulative)""", "cumulative"))
def loaded_product(star: Star):
    run = _stage_product(star)
    flows.report_product(run)
    return _report(run, "product_rdb", [*schema.PRODUCT_REPORT, "cumulative_score", "avg_handling_cumulative_score"])


@query(with_views("SELECT * FROM categories", "categories"))
def loaded_categories(star: Star):
    run = _stage_product(star)
    flows.report_categories(run)
    return _report(run, "abcd_categorie", ["month", "agent_id", "score", "categorie"])


def _late_calls(star: Star) -> flows.Run:
    """Every third call of the first ten days comes late: staged and reported in a second run."""
    run = _run(star)
    calls = _text(star.calls())
    _land(run, "staging", csat_info_sdb=clean_surveys(star.surveys_raw()), quality_sdb=star.quality())
    late = (F.col("lead_id").cast("bigint") % 3 == 0) & (F.col("date") < F.lit("2024-01-11").cast("date"))
    for number, some in (("first", calls.where(~late)), ("second", calls)):
        again = _run(star, number, run.root)
        _land(again, daily_exportcall_ldb=some)
        flows.stage_calls(again)
        flows.report_calls(again)
    return run


@query(_upper("full_name", ORACLES["call_insights"]))
def loaded_calls(star: Star):
    """Repeat counts follow late calls, also on the six days after them."""
    return _report(_late_calls(star), "exportcall_rdb", schema.CALL_REPORT)


@query(_upper("full_name", ORACLES["csat_agent_daily"]))
def loaded_csat_agents(star: Star):
    run = _run(star)
    _land(run, daily_exportcall_ldb=_text(star.calls()))
    _land(run, "staging", csat_info_sdb=clean_surveys(star.surveys_raw()))
    flows.stage_calls(run)
    flows.report_csat_agents(run)
    return _report(run, "csat_agent_daily", schema.CSAT_AGENT_REPORT)


def _stage_shifts(star: Star) -> flows.Run:
    run = _run(star)
    text_date = {"date": F.col("date").cast("string")}
    _land(run, agent_roster=star.roster().withColumns(text_date), login_logout=star.logins().withColumns(text_date))
    flows.stage_roster(run)
    flows.stage_logins(run)
    return run


@query(f"SELECT * FROM ({ORACLES['shrinkage_daily']}) WHERE date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'")
def loaded_shrinkage(star: Star):
    run = _stage_shifts(star)
    flows.report_shrinkage(run)
    return tables.read_table(run.spark, run.path("reporting", "shrinkage_rdb"))


@query(ORACLES["interval_report"])
def loaded_intervals(star: Star):
    run = _stage_shifts(star)
    _land(run, daily_exportcall_ldb=_text(star.calls()), forecast=star.forecast())
    flows.stage_calls(run)
    flows.stage_forecast(run)
    flows.report_intervals(run)
    return _report(run, "interval_wise_rdb", schema.INTERVAL_REPORT)


@query(ORACLES["csat_score_daily"])
def loaded_csat_scores(star: Star):
    """Score and resolution files appended, twice, and reported."""
    run = _run(star)
    text_date = {"date": F.col("date").cast("string")}
    _land(run, csat=star.csat_scores().withColumns(text_date), ftr_ivr=star.ftr_ivr().withColumns(text_date))
    for _ in range(2):
        flows.stage_csat_scores(run)
        flows.stage_ftr(run)
    flows.report_csat_scores(run)
    return _report(run, "csat_score_daily", schema.CSAT_SCORE_REPORT)


@query(with_views("SELECT * REPLACE (upper(employeename) AS employeename, upper(team_lead_name) AS team_lead_name, "
                  "upper(manager_name) AS manager_name) FROM staff", "staff"))
def staged_employees(star: Star):
    run = _run(star)
    _land(run, emp_details=star.employees())
    flows.stage_employees(run)
    return tables.read_snapshot(run.spark, run.path("staging", "emp_details_sdb")).select(
        *with_leader_names(star.employees()).columns)


@query(with_views(f"SELECT {column_list(schema.EMPLOYEES_SHORT)} FROM (SELECT * REPLACE (upper(employeename) AS employeename) "
                  "FROM employees WHERE lob = 'BUILDING')", "employees"))
def staged_employee_slice(star: Star):
    """One line of business, staged twice: the second run finds nothing new."""
    run = _run(star)
    _land(run, emp_details=star.employees())
    for _ in range(2):
        flows.stage_employee_slice(run)
    return run.staging("emp_details_lob_sdb").select(*schema.EMPLOYEES_SHORT)


_MARKS = ", ".join(f"CASE WHEN (l_linenumber + {i}) % 4 = 0 THEN 'No' ELSE 'Yes' END AS {m}" for i, m in enumerate(schema.QUALITY_MARKS))


@query(with_views(f"""
    SELECT {column_list([c for c in schema.QUALITY if c not in ("agent_name", "agent_id", "customer_number", *schema.QUALITY_MARKS)])},
           upper(agent_name) AS agent_name, emp_id AS agent_id, {_MARKS}, l_quantity::int::varchar AS customer_number
    FROM audit_items WHERE date <> DATE '1995-06-17'""", "audit_items"))
def staged_quality(star: Star):
    """Quality audits of seven years, staged again after one date vanished at the source."""
    run = _run(star)
    # rows that vanish lie in a folder of their own: the others need not be landed again
    vanishes = ~F.coalesce(F.col("date") != F.lit("1995-06-17").cast("date"), F.lit(False))
    path = run.path("landing", "quality")
    for folder, rows in (("false", ~vanishes), ("true", vanishes)):
        star.quality().where(rows).write.parquet(f"{path}/vanishes={folder}")
    flows.stage_quality(_run(star, "first", run.root))
    writers.purge_dates(star.spark, path, star.spark.range(1).select(F.lit("true").alias("date")), "vanishes")
    flows.stage_quality(_run(star, "second", run.root))
    return run.staging("quality_sdb").select(*schema.QUALITY)


@query("""
    WITH k AS (SELECT o_orderdate::date AS date, o_custkey::varchar AS "Emp_Code_",
                      'EMPLOYEE ' || o_custkey AS "Employee_Name_", floor(o_totalprice)::bigint AS "Assessment_Scores" FROM orders)
    SELECT 'history' AS kept, * FROM k UNION ALL SELECT 'last', * FROM k WHERE date = (SELECT max(date) FROM k)""")
def staged_knowledge(star: Star):
    """The full history, and the copy of the newest reloaded date."""
    run = _run(star)
    _land(run, datawisepkt=star.knowledge())
    flows.stage_knowledge(run)
    parts = [run.staging(name).select(F.lit(kept).alias("kept"), *schema.KNOWLEDGE_TEST)
             for kept, name in (("history", "datawisepkt_sdb"), ("last", "temp_datawisepkt_sdb"))]
    return parts[0].unionByName(parts[1])


def _scores(star: Star) -> dict[str, DataFrame]:
    none = F.lit(None).cast("string")
    training = star.training()
    missing = {c: none for c in schema.TRAINING if c not in training.columns}
    return {
        "tni_efficacy": training.withColumns({**missing, "name": F.lit("n")}),
        "bq_refresher": star.refresher().withColumns({"agent_name": F.lit("n"), "date": F.col("date_of_refresher")})}


def _all_months(star: Star, stage) -> flows.Run:
    """A month's load at the end of a year and at the start of the next, each twice, and then the months of all years."""
    run = _run(star)
    _land(run, **_scores(star))
    for as_of in ("1995-12-31", "1996-01-01") * 2:
        stage(flows.Run(star.spark, run.root, as_of, as_of))
    stage(_run(star, "all", run.root), all_months=True)
    return run


@query("""
    SELECT l_shipdate::date AS date, l_suppkey::varchar AS emp_id, 'N' AS name, l_quantity AS same_day_assessment_score
    FROM lineitem WHERE l_returnflag = 'R'""")
def staged_training(star: Star):
    """A run loads the month of its day; a last one loads all the other months, and finds those two there."""
    run = _all_months(star, flows.stage_training)
    return run.staging("tni_efficacy_sdb").select("date", "emp_id", "name", "same_day_assessment_score")


@query("""
    SELECT l_shipdate::date AS date, l_shipdate::date AS date_of_refresher, l_suppkey::varchar AS emp_id, 'N' AS agent_name,
           round(l_tax * 100) AS assessment_scores
    FROM lineitem WHERE l_linestatus = 'O'""")
def staged_refresher(star: Star):
    run = _all_months(star, flows.stage_refresher)
    return run.staging("bq_refresher_sdb").select("date", *schema.REFRESHER)


@query(ORACLES["attrition_slice"])
def staged_attrition(star: Star):
    """One line of business, appended twice: the second run finds nothing new."""
    run = _run(star)
    _land(run, attrition_tracker=star.attrition())
    for _ in range(2):
        flows.stage_attrition(run)
    return run.staging("attrition_tracker_sdb").select(*schema.ATTRITION)


@query(ORACLES["attrition_slice"] + " AND o_orderstatus <> 'P'")
def loaded_attrition(star: Star):
    """Staged and reported; rows without a date are in no report."""
    run = _run(star)
    _land(run, attrition_tracker=star.attrition())
    for _ in range(2):
        flows.stage_attrition(run)
        flows.report_attrition(run)
    return _report(run, "attrition_tracker_rdb", schema.ATTRITION)


@query(ORACLES["quality_report"])
def loaded_quality(star: Star):
    """Audits of seven years with the latest scores up to each of them, and people; all columns."""
    run = _run(star)
    _land(run, "staging", quality_sdb=star.quality(), datawisepkt_sdb=star.knowledge(), tni_efficacy_sdb=star.training(),
          bq_refresher_sdb=star.refresher())
    writers.write_snapshot(with_leader_names(star.employees()), run.path("staging", "emp_details_sdb"), run.as_of)
    flows.report_quality(run)
    return _report(run, "quality_rdb", schema.QUALITY_REPORT)


_LOGGED = "SELECT ts::date FROM events WHERE event_type IN ('click', 'purchase', 'signup')"


@query(f"SELECT * REPLACE (upper(user_name) AS user_name) FROM ({ORACLES['work_adherence']}) WHERE date IN ({_LOGGED})")
def loaded_adherence(star: Star):
    """All days with logins after the cut-off of the run's year."""
    shifts = _stage_shifts(star)
    run = flows.Run(star.spark, shifts.root, "2023-12-31", "later", FIRST, LAST, RULES)
    _land(run, "staging", agent_info_sdb=star.agent_days())
    writers.write_snapshot(with_leader_names(star.employees()), run.path("staging", "emp_details_sdb"), run.as_of)
    flows.report_adherence(run)
    return tables.read_table(run.spark, run.path("reporting", "work_adherence_rdb_tl"))


@query(ORACLES["employee_enrichment"].replace("1996-06-01", AS_OF))
def loaded_product_csat(star: Star):
    run = _run(star)
    _land(run, "staging", agent_info_sdb=star.agent_days(), exportcall_sdb=star.calls(),
          csat_info_sdb=clean_surveys(star.surveys_raw()))
    writers.write_snapshot(with_leader_names(star.employees()), run.path("staging", "emp_details_sdb"), run.as_of)
    flows.report_product_csat(run)
    return tables.read_table(run.spark, run.path("reporting", "product_csat_rdb"))


@query(with_views(f"SELECT {column_list(schema.EMPLOYEE_REPORT)} FROM staff", "staff"))
def loaded_employees(star: Star):
    run = _run(star)
    writers.write_snapshot(with_leader_names(star.employees()), run.path("staging", "emp_details_sdb"), run.as_of)
    flows.report_employees(run)
    return tables.read_snapshot(run.spark, run.path("reporting", "emp_details_rdb")).select(*schema.EMPLOYEE_REPORT)
