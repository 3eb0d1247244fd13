"""The daily loads: landing → staging → reporting, each a gate, a plan and a write.

All loads are re-runnable: what to do is decided from the two tables, stored, and carried out per
date. A load works on all its dates at once; nothing loops over days or rows on the driver.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from callops import schema
from callops.functions import dates as dt
from callops.operators import append, checks, gates, scan
from callops.operators.windows import quartile_category
from callops.plans import adherence, calls, cleaning, csat, interval, people, productivity, quality, shrinkage
from callops.sinks import writers
from callops.sources import envelope, large, tables


@dataclass(frozen=True)
class Run:
    """One run of the loads: where the layers lie, and the day it is made for.

    Reports without a gate cover ``first_day`` … ``last_day``, by default the day before ``as_of``. With
    ``people_of_day`` they show employees as they were on the reported day, else as the newest snapshot does.
    """

    spark: SparkSession
    root: str
    as_of: str
    run_id: str = "manual"
    first_day: str | None = None
    last_day: str | None = None
    rules: calls.CallRules = calls.CallRules()
    lob: str = ""
    people_of_day: bool = False

    def path(self, layer: str, table: str) -> str:
        return tables.layer_path(self.root, layer, table)

    def landing(self, table: str) -> DataFrame:
        return tables.read_table(self.spark, self.path("landing", table))

    def staging(self, table: str) -> DataFrame:
        return tables.read_table(self.spark, self.path("staging", table))

    def days(self) -> DataFrame:
        """The report days, one row each."""
        yesterday = dt.days_before(dt.as_date(self.as_of), 1)
        first = dt.as_date(self.first_day) if self.first_day else yesterday
        last = dt.as_date(self.last_day) if self.last_day else yesterday
        return gates.date_series(self.spark, first, last)

    def decide(self, name: str, gate: Callable, source: DataFrame, target_path: str, date: str = "date") -> DataFrame:
        """Ask a gate about a table and keep the answer with the run."""
        target = tables.read_table(self.spark, target_path, like=source.schema)
        return self.keep(name, gate(source, target, date=date))

    def keep(self, name: str, decisions: DataFrame) -> DataFrame:
        return writers.store_decisions(decisions, f"{self.path('audit', 'decisions')}/{name}/run={self.run_id}")

    def set_aside(self, name: str) -> DataFrame:
        """Dates (as text) of which the table has rows in quarantine, with the number of rows."""
        path = self.path("quarantine", name)
        held = tables.read_table(self.spark, path, like=T.StructType([T.StructField(writers.ASIDE, T.StringType())]))
        return held.groupBy(writers.ASIDE).agg(F.count(F.lit(1)).alias("rows"))

    def valid(self, name: str, rows: DataFrame, rules: dict[str, Column], dates: list[str] | None = None) -> DataFrame:
        """Rows that pass; the others go to quarantine with their reasons.

        ``dates`` are those that ``rows`` hold, by default all. The rows of a date replace what quarantine
        has of it, so a load may run any number of times, and a repaired row leaves quarantine.
        """
        good, bad = checks.split_valid(rows, rules)
        known = self.set_aside(name)
        if dates is not None:
            known = known.where(F.col(writers.ASIDE).isin(dates))
        writers.set_aside(bad.withColumn(writers.ASIDE, _date_text(bad)), self.path("quarantine", name), known)
        return good


# --- feeds → landing ---------------------------------------------------------------------------
FEEDS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "agent_info_ldb": envelope.agent_feed,
    "daily_exportcall_ldb": envelope.call_feed,
    "csat_ldb": envelope.survey_feed,
}

#: Column prefixes of the reconciliation summary.
FEED_PREFIXES = {"agent_info_ldb": "agent", "daily_exportcall_ldb": "export", "csat_ldb": "csat"}


def land_feed(run: Run, table: str, envelopes: DataFrame, at: str, messages: DataFrame | None = None) -> None:
    """Replace the dates the envelopes are for, and record declared against stored rows.

    ``messages`` comes beside ``envelopes`` that are cut into rows already.
    """
    path = run.path("landing", table)
    declared = envelope.declared_rows(envelopes if messages is None else messages)
    writers.replace_dates(FEEDS[table](envelopes), path, cover=declared.select("date").distinct())
    stored = tables.read_dates(run.spark, path, declared)
    audit = checks.audit_rows(stored, declared, table, "landing_db", at)
    writers.append_audit(audit, run.path("landing", "status_ldb"))


def land_feeds(run: Run, incoming: str, at: str, split_files: bool = False) -> None:
    """All feeds of the report days, from ``incoming/<table>/date=…`` folders.

    With ``split_files`` an envelope file is read by many tasks.
    """
    for table in FEEDS:
        folder = f"{incoming}/{table}"
        if tables.exists(run.spark, folder):
            if split_files:
                rows, messages = large.read_large(run.spark, folder, dates=run.days())
                land_feed(run, table, rows, at, messages)
            else:
                envelopes = envelope.read_envelopes(run.spark, folder)
                land_feed(run, table, envelopes.join(run.days(), "date", "left_semi"), at)


def reconciliation_summary(run: Run, day: str | None = None) -> DataFrame:
    return checks.reconciliation(run.landing("status_ldb"), FEED_PREFIXES, day or run.as_of)


# --- landing → staging -------------------------------------------------------------------------
def _day(rows: DataFrame) -> Column:
    """The date of a landed row, NULL where it cannot be read; a date is taken as it is."""
    return F.col("date") if dict(rows.dtypes)["date"] == "date" else dt.lenient_date(F.col("date").cast("string"))


def _dated(rows: DataFrame) -> dict[str, Column]:
    return {"date unreadable": _day(rows).isNotNull()}


#: Quarantine keeps rows by date; those whose date cannot be read stand under this word.
UNREADABLE = "unreadable"


def _date_text(rows: DataFrame) -> Column:
    """The date of a landed row as text."""
    if "date" not in rows.columns:
        return F.lit(UNREADABLE)
    return F.coalesce(_day(rows).cast("string"), F.lit(UNREADABLE))


def _of_dates(rows: DataFrame, dates: list[str]) -> DataFrame:
    """Landed rows of the given dates; where the date is one, other folders or row groups are not read."""
    if dict(rows.dtypes)["date"] != "date":
        return rows.where(_date_text(rows).isin(dates))
    on = F.col("date").isin([datetime.date.fromisoformat(d) for d in dates if d != UNREADABLE])
    return rows.where(on | F.col("date").isNull() if UNREADABLE in dates else on)


def _decided(run: Run, table: str, target: str, gate: Callable, clean: Callable, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """What a gate says about the landed rows that pass the rules, and the clean rows of the dates to load.

    The gate reads the date column alone. Only of dates with rows in quarantine are whole rows read for
    it, as there the rows that pass are fewer than those that landed. The lists of dates that are
    collected have one entry per date of the calendar.
    """
    landed = run.landing(table)
    rules = _dated(landed) | rules
    aside = [r[0] for r in run.set_aside(table).select(writers.ASIDE).collect()]
    day = _day(landed).alias("date")
    plain = landed.where(day.isNotNull()).select(day)
    if aside:
        plain = plain.where(~F.col("date").cast("string").isin(aside))
    checked, _ = checks.split_valid(_of_dates(landed, [d for d in aside if d != UNREADABLE]), rules)
    decided = run.decide(target, gate, plain.unionByName(checked.select(day)), run.path("staging", target))

    loaded = [str(r[0]) for r in decided.where("action in ('reload', 'insert')").select("date").collect()]
    unreadable = [] if landed.where(day.isNull()).isEmpty() else [UNREADABLE]
    dates = list({*loaded, *aside, *unreadable})
    return decided, clean(run.valid(table, _of_dates(landed, dates), rules, dates))


def _stage_dates(run: Run, table: str, target: str, gate: Callable, clean: Callable,
                 rules: dict[str, Column] | None = None) -> None:
    decided, rows = _decided(run, table, target, gate, clean, rules or {})
    writers.apply_decisions(rows, decided, run.path("staging", target), cover=True)


def _stage_new_rows(run: Run, table: str, target: str, clean: Callable) -> None:
    landed = run.landing(table)
    rows = clean(run.valid(table, landed, _dated(landed)))
    path = run.path("staging", target)
    present = tables.read_table(run.spark, path, like=rows.schema).select(*rows.columns)
    writers.append_rows(gates.new_rows(rows, present, date="date"), path)


def _stage_by_sketch(run: Run, rows: DataFrame, target: str) -> None:
    """Append what an undated table lacks; its rows are not read again."""
    append.append_missing(rows, run.path("staging", target), f"{run.path('audit', 'sketches')}/{target}")


def _stage_months(run: Run, table: str, target: str, clean: Callable, all_months: bool = False) -> None:
    """The month of the run's day, or with ``all_months`` every month that is landed or staged."""
    def chosen(df: DataFrame, date: str = "date") -> DataFrame:
        return df if all_months else df.where(dt.in_month(F.col(date), run.as_of))

    landed = run.landing(table)
    rows = chosen(clean(run.valid(table, landed, _dated(landed))))
    path = run.path("staging", target)

    def gate(source: DataFrame, present: DataFrame, date: str) -> DataFrame:
        # other months of the target are none of this run's business
        return gates.month_parity(source, chosen(present, date), date)

    decided = run.decide(target, gate, rows, path)
    writers.apply_decisions(rows.withColumn("month", dt.month_start(F.col("date"))), decided, path, partition="month")


def stage_agents(run: Run) -> None:
    _stage_dates(run, "agent_info_ldb", "agent_info_sdb", gates.count_parity, cleaning.clean_agents, cleaning.agent_rules())


def stage_calls(run: Run) -> None:
    _stage_dates(run, "daily_exportcall_ldb", "exportcall_sdb", gates.count_parity, cleaning.clean_calls, cleaning.call_rules())


def stage_surveys(run: Run) -> None:
    _stage_dates(run, "csat_ldb", "csat_info_sdb", gates.count_parity, cleaning.clean_surveys)


def stage_forecast(run: Run) -> None:
    """No gate: the report days are replaced each time."""
    rows = cleaning.clean_forecast(run.landing("forecast"))
    chosen = rows.join(run.days(), "date", "left_semi")
    writers.replace_dates(chosen, run.path("staging", "forecast_sdb"), cover=run.days())


def stage_csat_scores(run: Run) -> None:
    _stage_new_rows(run, "csat", "csat_sdb", cleaning.clean_csat_scores)


def stage_ftr(run: Run) -> None:
    _stage_new_rows(run, "ftr_ivr", "ftr_ivr_sdb", cleaning.clean_ftr)


def stage_quality(run: Run) -> None:
    _stage_dates(run, "quality", "quality_sdb", gates.count_diff_range, cleaning.clean_quality)


def stage_knowledge(run: Run) -> None:
    """Full history, and a copy of the newest reloaded date."""
    path = run.path("staging", "datawisepkt_sdb")
    decided, rows = _decided(run, "datawisepkt", "datawisepkt_sdb", gates.count_diff_list, cleaning.clean_knowledge, {})
    writers.purge_dates(run.spark, path, decided.where("action = 'purge'"))
    reload = decided.where("action = 'reload'")
    if not reload.isEmpty():
        chosen = rows.join(reload.select("date"), "date", "left_semi")
        writers.dual_write(chosen, decided, path, run.path("staging", "temp_datawisepkt_sdb"))


def stage_training(run: Run, all_months: bool = False) -> None:
    _stage_months(run, "tni_efficacy", "tni_efficacy_sdb", cleaning.clean_training, all_months)


def stage_refresher(run: Run, all_months: bool = False) -> None:
    _stage_months(run, "bq_refresher", "bq_refresher_sdb", cleaning.clean_refresher, all_months)


def stage_roster(run: Run) -> None:
    _stage_dates(run, "agent_roster", "agent_roster_sdb", gates.symmetric_diff, cleaning.clean_roster)


def stage_logins(run: Run) -> None:
    _stage_dates(run, "login_logout", "login_logout_sdb", gates.symmetric_diff, cleaning.clean_logins)


def stage_employees(run: Run) -> None:
    """Full reload with the names of team lead and manager."""
    rows = people.with_leader_names(cleaning.clean_employees(run.landing("emp_details")))
    writers.write_snapshot(rows, run.path("staging", "emp_details_sdb"), run.as_of)


def stage_employee_slice(run: Run) -> None:
    """One line of business, short column list; what the table does not hold yet is appended."""
    rows = cleaning.clean_employees(run.landing("emp_details").where(F.col("lob") == run.lob), schema.EMPLOYEES_SHORT)
    _stage_by_sketch(run, rows, "emp_details_lob_sdb")


def stage_attrition(run: Run) -> None:
    _stage_by_sketch(run, cleaning.clean_attrition(run.landing("attrition_tracker"), run.lob), "attrition_tracker_sdb")


# --- staging → reporting -----------------------------------------------------------------------
def _employees(run: Run) -> DataFrame:
    return tables.read_snapshot(run.spark, run.path("staging", "emp_details_sdb"))


def _on(df: DataFrame, days: DataFrame) -> DataFrame:
    return df.join(days.select("date"), "date", "left_semi")


def _with_days_before(days: DataFrame, back: int) -> DataFrame:
    """The days and the ``back`` days before each of them."""
    span = F.sequence(F.date_sub("date", back), F.col("date"), F.expr("interval 1 day"))
    return days.select(F.explode(span).alias("date")).distinct()


def _weeks_of(days: DataFrame) -> DataFrame:
    """All days of the weeks of the days, and of the days before them (shifts over midnight)."""
    first = F.date_trunc("week", F.date_sub("date", 1)).cast("date")
    last = F.date_add(F.date_trunc("week", "date").cast("date"), 6)
    return days.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date")).distinct()


def _months_of(days: DataFrame) -> DataFrame:
    """All days of the months of the days, and of the months before."""
    first = F.add_months(F.trunc("date", "MM"), -1)
    span = F.sequence(first, F.last_day("date"), F.expr("interval 1 day"))
    return days.select(F.explode(span).alias("date")).distinct()


def _product(run: Run, days: DataFrame) -> DataFrame:
    return productivity.product_report(
        _on(run.staging("agent_info_sdb"), days), _on(run.staging("exportcall_sdb"), days))


def _with_days_after(days: DataFrame, on: int) -> DataFrame:
    """The days and the ``on`` days after each of them."""
    span = F.sequence(F.col("date"), F.date_add("date", on), F.expr("interval 1 day"))
    return days.select(F.explode(span).alias("date")).distinct()


def _calls(run: Run, days: DataFrame) -> DataFrame:
    """Narrow call report of the days; repeats look back into the six days before."""
    window = _on(run.staging("exportcall_sdb"), _with_days_before(days, 6))
    return _on(calls.narrow_report(window, run.staging("csat_info_sdb"), run.staging("quality_sdb")), days)


def _outcomes(run: Run, days: DataFrame) -> DataFrame:
    """The same without audit scores, which survey reports do not read."""
    window = _on(run.staging("exportcall_sdb"), _with_days_before(days, 6))
    return _on(calls.call_outcomes(window, run.staging("csat_info_sdb"), run.rules), days)


def report_product(run: Run) -> None:
    days = run.days()
    report = productivity.cumulative_scores(_product(run, _months_of(days)))
    writers.replace_dates(_on(report, days), run.path("reporting", "product_rdb"), cover=days)


def report_calls(run: Run) -> None:
    path = run.path("reporting", "exportcall_rdb")
    decided = run.decide("exportcall_rdb", gates.count_parity, run.staging("exportcall_sdb"), path)
    changed = decided.where("action in ('reload', 'purge')").select("date")
    # repeat counts of the six days after a changed day depend on it
    days = _with_days_after(changed, 6)
    writers.replace_dates(_calls(run, days), path, cover=days, finish=lambda rows: calls.judged_report(rows, run.rules))


def report_csat_agents(run: Run) -> None:
    days = run.days()
    report = csat.csat_agent_daily(_outcomes(run, days))
    writers.replace_dates(report, run.path("reporting", "csat_agent_daily"), cover=days)


def report_employees(run: Run) -> None:
    rows = _employees(run).select(*schema.EMPLOYEE_REPORT)
    writers.write_snapshot(rows, run.path("reporting", "emp_details_rdb"), run.as_of)


def report_product_csat(run: Run) -> None:
    """Productivity with survey results, monthly category, people attributes and tenure."""
    days = run.days()
    product = _product(run, _months_of(days))
    letters = quartile_category(productivity.month_occupancy(product), ["month"], "score")
    joined = productivity.product_csat_report(product, csat.csat_agent_daily(_outcomes(run, days)), letters)
    if run.people_of_day:
        report = people.with_people_of_day(_on(joined, days), run.staging("emp_details_sdb"), run.as_of)
    else:
        report = people.with_people(_on(joined, days), _employees(run), run.as_of)
    writers.replace_dates(report, run.path("reporting", "product_csat_rdb"), cover=days)


def report_shrinkage(run: Run) -> None:
    days = run.days()
    weeks = _weeks_of(days)
    # a login on the day after can belong to a shift over midnight
    next_days = days.select(F.date_add("date", 1).alias("date"))
    logins = _on(run.staging("login_logout_sdb"), days.union(next_days).distinct())
    report = shrinkage.shrinkage_report(_on(run.staging("agent_roster_sdb"), weeks), logins)
    writers.replace_dates(_on(report, days), run.path("reporting", "shrinkage_rdb"), cover=days)


def report_intervals(run: Run) -> None:
    days = run.days()
    window = _on(run.staging("exportcall_sdb"), _with_days_before(days, 6))
    report = interval.interval_report(
        window, _on(run.staging("forecast_sdb"), days), _on(run.staging("agent_roster_sdb"), _weeks_of(days)), run.rules)
    writers.replace_dates(_on(report, days), run.path("reporting", "interval_wise_rdb"), cover=days)


def report_csat_scores(run: Run) -> None:
    """Only dates the report does not have yet."""
    path = run.path("reporting", "csat_score_daily")
    scores, ftr = run.staging("csat_sdb"), run.staging("ftr_ivr_sdb")
    source = scores.withColumnRenamed("date", "csat_date")
    decided = run.decide("csat_score_daily", gates.insert_if_absent, source, path, date="csat_date")
    report = csat.csat_score_daily(_on(scores, decided), _on(ftr, decided))
    writers.replace_dates(report, path, partition="csat_date", counts=decided)


def report_quality(run: Run) -> None:
    path = run.path("reporting", "quality_rdb")
    audits = run.staging("quality_sdb")
    decided = run.decide("quality_rdb", gates.count_diff_range, audits, path)
    reload = decided.where("action = 'reload'")
    rows, known = quality.report_parts(
        _on(audits, reload), run.staging("datawisepkt_sdb"), run.staging("tni_efficacy_sdb"),
        run.staging("bq_refresher_sdb"), _employees(run), range_rows=scan.RANGE_ROWS)
    writers.purge_dates(run.spark, path, decided.where("action = 'purge'"))
    writers.replace_dates(rows, path, counts=decided, finish=quality.unpacked, lookup=writers.Lookup(known, "emp_id", "_facts"))


def report_categories(run: Run) -> None:
    """On the first of a month: letters from the month before."""
    last_month = F.col("date").between(F.add_months(dt.as_date(run.as_of), -1), dt.days_before(dt.as_date(run.as_of), 1))
    agents = gates.on_month_start(run.staging("agent_info_sdb").where(last_month), run.as_of)
    product = productivity.product_report(agents, run.staging("exportcall_sdb").where(last_month))
    letters = quartile_category(productivity.month_occupancy(product), ["month"], "score")
    writers.replace_dates(letters, run.path("reporting", "abcd_categorie"), partition="month")


def report_adherence(run: Run) -> None:
    """Login dates after 5 May of the year that the report lacks, and report dates without logins."""
    path = run.path("reporting", "work_adherence_rdb_tl")
    logins = run.staging("login_logout_sdb")
    recent = dt.after_cutoff(F.col("date"), run.as_of)
    logged = logins.where(recent).select(F.col("date").alias("log_date"))

    def gate(source: DataFrame, target: DataFrame, date: str) -> DataFrame:
        return gates.symmetric_diff(source, target.where(dt.after_cutoff(F.col(date), run.as_of)), date)

    decided = run.decide("work_adherence_rdb_tl", gate, logged, path, date="log_date")
    reload = decided.where("action = 'reload'")
    report = adherence.adherence_load(adherence.adherence_report(
        _on(run.staging("agent_roster_sdb"), _weeks_of(reload)), logins, run.staging("agent_info_sdb"),
        _employees(run), reload))
    writers.purge_dates(run.spark, path, decided.where("action = 'purge'"), partition="update_date")
    writers.replace_dates(report, path, partition="update_date")


def report_attrition(run: Run) -> None:
    rows = run.staging("attrition_tracker_sdb")
    path = run.path("reporting", "attrition_tracker_rdb")
    writers.apply_decisions(rows, run.decide("attrition_tracker_rdb", gates.symmetric_diff, rows, path), path)


#: Every load in an order in which each finds its inputs.
FLOWS: dict[str, Callable[[Run], None]] = {f.__name__: f for f in (
    stage_agents, stage_calls, stage_surveys, stage_forecast, stage_csat_scores, stage_ftr, stage_quality,
    stage_knowledge, stage_training, stage_refresher, stage_roster, stage_logins, stage_employees,
    stage_employee_slice, stage_attrition,
    report_product, report_calls, report_csat_agents, report_employees, report_product_csat, report_shrinkage,
    report_intervals, report_csat_scores, report_quality, report_categories, report_adherence, report_attrition,
)}
