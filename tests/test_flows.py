"""All loads end to end over the small star tables, run twice, and after changes in the source."""

import dataclasses
import json

import pytest
from conftest import FOLDER, rows
from pyspark.sql import functions as F

from callops import schema
from callops.operators.windows import quartile_category
from callops.plans import adherence, calls, csat, flows, interval, people, productivity, quality, shrinkage
from callops.plans.star import RULES, Star
from callops.sinks import writers
from callops.sources import tables
from callops.streaming.landing import land_stream

FIRST, LAST = "2024-01-01", "2024-01-31"


#: Two months of the order-based tables: one folder per date makes thousands of tiny files otherwise.
SPAN = "date between '1997-01-01' and '1997-02-28'"


def as_text(df):
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) if c != "date" else F.col(c) for c in df.columns])


def clock(c):
    s = F.col(c)
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    """Landing tables made from the star views, and every load run once."""
    root = str(tmp_path_factory.mktemp("layers"))
    star = Star(spark, FOLDER)
    run = flows.Run(spark, root, "2024-02-01", "first", FIRST, LAST, RULES, lob="BUILDING")
    agents = star.agent_days()
    agents = agents.withColumns({c: clock(c) for c in schema.AGENT_DURATIONS})
    text_date = {"date": F.col("date").cast("string")}
    landing = {
        "agent_info_ldb": as_text(agents),
        "daily_exportcall_ldb": as_text(star.calls()),
        "csat_ldb": star.surveys_raw().withColumn(
            "date", F.date_add(F.lit(FIRST).cast("date"), (F.col("lead_id").cast("int") % 30))),
        "forecast": star.forecast(),
        "csat": star.csat_scores().where(SPAN).withColumns(text_date),
        "ftr_ivr": star.ftr_ivr().where(SPAN).withColumns(text_date),
        "quality": star.quality().where(SPAN),
        "datawisepkt": star.knowledge().where(SPAN),
        "agent_roster": star.roster().withColumns(text_date),
        "login_logout": star.logins().withColumns(text_date),
        "emp_details": star.employees(),
        "attrition_tracker": star.attrition().where(SPAN + " or date = 'not yet'"),
    }
    none = F.lit(None).cast("string")
    training = star.training().withColumns({c: none for c in schema.TRAINING if c not in star.training().columns})
    landing["tni_efficacy"] = training.withColumns({"name": F.lit("n"), "date": F.make_date(F.lit(2024), F.lit(2), F.dayofmonth("date") % 28 + 1)})
    landing["bq_refresher"] = star.refresher().withColumns({
        "agent_name": F.lit("n"), "date": F.make_date(F.lit(2024), F.lit(2), F.dayofmonth("date_of_refresher") % 28 + 1)})
    for name, df in landing.items():
        df.write.parquet(run.path("landing", name))
    for load in flows.FLOWS.values():
        load(run)
    return run, star


def same(got, want):
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert rows(got.select(*[f"`{c}`" for c in columns])) == rows(want.select(*[f"`{c}`" for c in columns]))


def report(run, name):
    return tables.read_table(run.spark, run.path("reporting", name))


def test_staging_holds_the_clean_rows(layers):
    run, star = layers
    same(run.staging("agent_info_sdb").drop("emp_name"), star.agent_days().withColumns(
        {c: F.col(c).cast("double") for c in schema.AGENT_DURATIONS}).drop("emp_name"))
    assert run.staging("agent_info_sdb").first()["emp_name"].startswith("AGENT ")
    same(run.staging("exportcall_sdb").drop("full_name"), star.calls().drop("full_name"))
    assert run.staging("csat_info_sdb").where("survey_rating = 'NoResponse'").count() == star.staged().sparkSession.read.parquet(
        f"{FOLDER}/orders.parquet").where("o_orderstatus = 'P'").count()
    assert run.staging("tni_efficacy_sdb").count() == star.training().count()
    assert run.staging("bq_refresher_sdb").count() == star.refresher().count()
    assert run.staging("temp_datawisepkt_sdb").select("date").distinct().count() == 1
    assert run.staging("emp_details_lob_sdb").columns == schema.EMPLOYEES_SHORT
    assert set(schema.ATTRITION) == set(run.staging("attrition_tracker_sdb").columns)


def calls_staged(run):
    return run.staging("exportcall_sdb")


def test_reports_equal_the_plans(layers):
    run, _ = layers
    staged = calls_staged(run)
    product = productivity.product_report(run.staging("agent_info_sdb"), staged)
    same(report(run, "product_rdb"), productivity.cumulative_scores(product))
    call_rows = calls.call_report(staged, run.staging("csat_info_sdb"), run.staging("quality_sdb"), RULES)
    same(report(run, "csat_agent_daily"), csat.csat_agent_daily(call_rows))
    staff = flows._employees(run)
    letters = quartile_category(productivity.month_occupancy(product), ["month"], "score")
    same(report(run, "abcd_categorie"), letters)
    same(report(run, "product_csat_rdb"), people.with_people(
        productivity.product_csat_report(product, csat.csat_agent_daily(call_rows), letters), staff, "2024-02-01"))
    full = interval.interval_report(staged, run.staging("forecast_sdb"), run.staging("agent_roster_sdb"), RULES)
    same(report(run, "interval_wise_rdb"), full)
    shrink = shrinkage.shrinkage_report(run.staging("agent_roster_sdb"), run.staging("login_logout_sdb"))
    same(report(run, "shrinkage_rdb"), shrink.where(f"date between '{FIRST}' and '{LAST}'"))
    same(report(run, "csat_score_daily"), csat.csat_score_daily(run.staging("csat_sdb"), run.staging("ftr_ivr_sdb")))
    same(report(run, "quality_rdb"), quality.quality_report(
        run.staging("quality_sdb"), run.staging("datawisepkt_sdb"), run.staging("tni_efficacy_sdb"),
        run.staging("bq_refresher_sdb"), staff))


def test_people_of_the_reported_day(layers, spark):
    """Made again after a lead has changed, the report shows the lead of the day."""
    run, _ = layers
    days = dict(first_day="2024-01-20", last_day=LAST)
    before = report(run, "product_csat_rdb").where("date >= '2024-01-20'")
    path = run.path("staging", "emp_details_sdb")
    staff = flows._employees(run)
    writers.write_snapshot(staff, path, "2024-01-02")
    writers.write_snapshot(staff.withColumn("team_lead", F.lit("new lead")), path, "2024-02-05")
    try:
        kept = rows(before)
        late = dataclasses.replace(run, as_of="2024-02-01", run_id="late", people_of_day=True, **days)
        flows.report_product_csat(late)
        assert rows(report(run, "product_csat_rdb").where("date >= '2024-01-20'")) == kept
        flows.report_product_csat(dataclasses.replace(late, people_of_day=False))
        assert {r[0] for r in report(run, "product_csat_rdb").where("date >= '2024-01-20' and designation is not null")
                .select("team_lead").distinct().collect()} == {"new lead"}
    finally:
        gone = spark.createDataFrame([(d,) for d in ("2024-01-02", "2024-02-05")], "date string")
        writers.purge_dates(spark, path, gone, partition="snapshot")
        flows.report_product_csat(dataclasses.replace(run, **days))


def test_call_report_matches_its_gate(layers):
    run, _ = layers
    assert report(run, "exportcall_rdb").count() == calls_staged(run).count()


def test_adherence_after_the_cutoff_only(layers):
    run, _ = layers
    # all logins are in January, before the cut-off of 5 May: nothing to report this year
    assert not tables.exists(run.spark, run.path("reporting", "work_adherence_rdb_tl")) or \
        run.spark.read.schema("employeeid string").parquet(run.path("reporting", "work_adherence_rdb_tl")).count() == 0
    later = flows.Run(run.spark, run.root, "2023-12-31", "later", FIRST, LAST, RULES)
    flows.report_adherence(later)
    got = report(run, "work_adherence_rdb_tl")
    logged = run.staging("login_logout_sdb").select("date").distinct()
    want = adherence.adherence_load(adherence.adherence_report(
        run.staging("agent_roster_sdb"), run.staging("login_logout_sdb"), run.staging("agent_info_sdb"),
        flows._employees(run), logged))
    same(got, want)
    flows.report_adherence(later)
    same(report(run, "work_adherence_rdb_tl"), want)


def test_second_run_changes_nothing(layers):
    run, _ = layers
    before = {n: rows(report(run, n).drop("full_name")) for n in ("product_csat_rdb", "interval_wise_rdb", "quality_rdb")}
    counts = {n: run.staging(n).count() for n in ("csat_sdb", "ftr_ivr_sdb", "attrition_tracker_sdb", "quality_sdb", "emp_details_lob_sdb")}
    again = flows.Run(run.spark, run.root, run.as_of, "second", FIRST, LAST, RULES, lob="BUILDING")
    for load in flows.FLOWS.values():
        load(again)
    assert before == {n: rows(report(run, n).drop("full_name")) for n in before}
    assert counts == {n: run.staging(n).count() for n in counts}


def test_changed_source_is_followed(layers, tmp_path):
    """More rows on one date, a vanished date, a new date, an unreadable date."""
    run, star = layers
    root = str(tmp_path)
    first = flows.Run(run.spark, root, "2024-02-01", "a")
    logins = star.logins().withColumn("date", F.col("date").cast("string"))
    old = logins.where("date <> '2024-01-03'")
    old.write.parquet(first.path("landing", "login_logout"))
    flows.stage_logins(first)
    new = logins.where("date <> '2024-01-05'").union(logins.limit(1).withColumn("date", F.lit("soon")))
    new.write.mode("overwrite").parquet(first.path("landing", "login_logout"))
    flows.stage_logins(flows.Run(run.spark, root, "2024-02-01", "b"))
    staged = {str(r[0]) for r in first.staging("login_logout_sdb").select("date").distinct().collect()}
    assert "2024-01-03" in staged and "2024-01-05" not in staged
    aside = run.spark.read.parquet(first.path("quarantine", "login_logout")).collect()
    assert [(r["date"], r["broken_rules"]) for r in aside] == [("soon", ["date unreadable"])]


def write_envelope(folder, date, objects, declared):
    path = folder / f"date={date}"
    path.mkdir(parents=True, exist_ok=True)
    body = {"message": f"Total {declared} rows", "data": objects}
    (path / f"{len(list(path.iterdir()))}.json").write_text(json.dumps(body))


def test_feeds_are_landed_and_audited(spark, tmp_path):
    incoming = tmp_path / "incoming"
    write_envelope(incoming / "csat_ldb", "2024-01-01", [{"LEAD_ID": "1", "ivr_flow": "[a, 3]"}, {"lead_id": "2"}], 2)
    write_envelope(incoming / "csat_ldb", "2024-01-02", [{"lead_id": "3"}], 5)
    run = flows.Run(spark, str(tmp_path / "out"), "2024-01-03", "r", "2024-01-01", "2024-01-02")
    for _ in range(2):  # always replaced, never doubled
        flows.land_feeds(run, str(incoming), "2024-01-03 06:00:00")
        assert run.landing("csat_ldb").count() == 3
    audit = run.landing("status_ldb")
    assert {(r["json_rows"], r["inserted_rows"]) for r in audit.collect()} == {(2, 2), (5, 1)}
    assert flows.reconciliation_summary(run).count() == 1
    flows.stage_surveys(run)
    staged = {r["lead_id"]: r["survey_rating"] for r in run.staging("csat_info_sdb").collect()}
    assert staged == {"1": "3", "2": "NoResponse", "3": "NoResponse"}


def test_stream_lands_what_is_new(spark, tmp_path):
    incoming, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    run = flows.Run(spark, str(tmp_path / "out"), "2024-01-03")

    def land():
        land_stream(run, "csat_ldb", str(incoming), checkpoint).awaitTermination()
        return sorted((str(r["date"]), r["lead_id"]) for r in run.landing("csat_ldb").collect())

    write_envelope(incoming, "2024-01-01", [{"lead_id": "1"}], 1)
    assert land() == [("2024-01-01", "1")]
    write_envelope(incoming, "2024-01-01", [{"lead_id": "2"}], 1)  # late file of a landed date
    write_envelope(incoming, "2024-01-02", [{"lead_id": "3"}], 1)
    assert land() == [("2024-01-01", "1"), ("2024-01-01", "2"), ("2024-01-02", "3")]
    assert land() == [("2024-01-01", "1"), ("2024-01-01", "2"), ("2024-01-02", "3")]


