import datetime as d
import json

from conftest import rows
from pyspark.sql import functions as F

from callops import schema
from callops.operators import checks
from callops.sources import envelope as env


def feed(spark, *objects, message="Total 3 rows"):
    body = '{"message": "%s", "data": [%s]}' % (message, ", ".join(objects))
    frame = spark.createDataFrame([(d.date(2023, 1, 1), body)], "date date, body string")
    return env.parse_envelopes(frame)


def test_frozen_projection(spark):
    out = env.call_feed(feed(spark, '{"AGENT": 1, "Status": "a", "status": "b", "USER": null, "lead_id": 7.50}')).first()
    assert out["status"] == "b" and out["user"] is None and out["lead_id"] in ("7.5", "7.50")
    assert set(out.asDict()) == {"date", *schema.EXPORT_CALL_LANDING}


def test_breaks_are_merged_over_the_agent(spark):
    out = env.agent_feed(feed(
        spark,
        '{"agent_id": "1", "tea": "own", "breaks": {"TEA": "00:10:00", "X": 1, "Bio": "00:01:00"}}',
        '{"agent_id": "2", "tea": "own", "breaks": []}',
        '{"agent_id": "3", "AGENT_ID": "no", "breaks": {}}',
        '{"agent_id": "4"}',
        '{"agent_id": "5", "breaks": {"tea": "a", "TEA": "b"}}',
    ))
    got = [(r["agent_id"], r["tea"], r["bio"], r["breaks"]) for r in out.orderBy("agent_id").collect()]
    assert got == [("1", "00:10:00", "00:01:00", "0"), ("2", "own", None, None), ("3", None, None, None),
                   ("4", None, None, None), ("5", "b", None, "0")]


def test_quotes_only_in_rows_with_an_apostrophe(spark):
    objects = (json.dumps({"lead_id": "1", "remarks": "it's", "status": 'a"b'}),
               json.dumps({"lead_id": "2", "status": 'a"b'}))
    out = {r["lead_id"]: (r["status"], r["remarks"]) for r in env.call_feed(feed(spark, *objects)).collect()}
    assert out == {"1": ("a'b", "it`s"), "2": ('a"b', None)}


def test_files_with_date_folders(spark, tmp_path):
    for day, n in (("2023-01-01", 2), ("2023-01-02", 3)):
        folder = tmp_path / f"date={day}"
        folder.mkdir()
        body = {"message": f"Total {n} rows found", "data": [{"Lead_Id": str(i), "extra": {"a": 1}} for i in range(n)]}
        (folder / "part.json").write_text(json.dumps(body, indent=2))
    envelopes = env.read_envelopes(spark, str(tmp_path))
    assert rows(env.declared_rows(envelopes)) == [(d.date(2023, 1, 1), 2), (d.date(2023, 1, 2), 3)]
    landed = env.survey_feed(envelopes)
    assert landed.columns == ["date", *schema.SURVEY_LANDING] or set(landed.columns) == {"date", *schema.SURVEY_LANDING}
    assert landed.groupBy("date").count().orderBy("date").collect()[1][1] == 3

    audit = checks.audit_rows(landed, env.declared_rows(envelopes), "csat_ldb", "landing_db", "2023-01-03 06:00:00")
    again = checks.audit_rows(landed.limit(0), env.declared_rows(envelopes), "csat_ldb", "landing_db", "2023-01-03 05:00:00")
    one_day = audit.where("date = '2023-01-02'").unionByName(again.where("date = '2023-01-02'"))
    summary = checks.reconciliation(one_day, {"csat_ldb": "csat"}, "2023-01-03").first()
    assert (summary["csat_json_rows_count"], summary["csat_insert_rows_count"]) == (3, 3)


def test_empty_and_broken_envelopes(spark):
    frame = spark.createDataFrame([(d.date(2023, 1, 1), b) for b in ('{"message": "0 rows", "data": []}', "{oops")],
                                  "date date, body string")
    assert env.call_feed(env.parse_envelopes(frame)).count() == 0


def test_key_drift(spark):
    envelopes = feed(spark, '{"Lead_ID": 1, "colour": 2}', '{"lead_id": 1}')
    out = {r["key"]: (r["rows"], r["status"]) for r in
           checks.key_drift(env.received_keys(envelopes), ["lead_id", "status"]).collect()}
    assert out == {"lead_id": (2, "kept"), "colour": (1, "dropped"), "status": (0, "missing")}


def test_split_valid_is_complete(spark):
    frame = spark.createDataFrame([("1", "x"), ("a", None), (None, "y"), ("2", "z")], "n string, reasons string")
    good, bad = checks.split_valid(frame, {
        "n is a number": F.col("n").try_cast("int").isNotNull(), "reasons given": F.col("reasons").isNotNull()})
    assert rows(good) == [("1", "x"), ("2", "z")]
    assert {r["n"]: r["broken_rules"] for r in bad.collect()} == {
        "a": ["n is a number", "reasons given"], None: ["n is a number"]}
    assert good.count() + bad.count() == frame.count()
