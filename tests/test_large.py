"""Envelope files cut into ranges against the one-task reader."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from callops import schema
from callops.sources import envelope, large


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few hundred bytes, one task each."""
    conf = {"spark.sql.files.maxPartitionBytes": "400b", "spark.sql.files.openCostInBytes": "400b", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(folder, date, text):
    folder = folder / f"date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.json").write_text(text, encoding="utf-8")


def objects(rng, n):
    odd = ['a "quoted" } brace', "back\\slash\\", "{[", "Ünï日本😀}", "", "x" * 90, '\\"}', "]},{", "it's"]
    return [{"Lead_ID": str(k), "status": rng.choice(odd), "remarks": rng.choice(odd), "extra": {"deep": [{"a": rng.choice(odd)}, []]},
             "list": [1, [2, {"b": "}"}]], "n": rng.choice([1, 2.5, None, True])} for k in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_as_the_one_task_reader(spark, tmp_path, small_ranges, indent):
    rng = random.Random(7)
    for day in range(1, 4):
        data = objects(rng, 3 * day)
        body = [("message", f'Total {len(data)} rows }} "x" \\'), ("other", [{"lead_id": "no"}, {"data": [{"lead_id": "never"}]}]), ("data", data)]
        write(tmp_path, f"2024-01-0{day}", json.dumps(dict(body), indent=indent, ensure_ascii=day == 1) + "\n" * (day - 1))
        write(tmp_path, f"2024-01-0{day}", json.dumps(dict(body[::-1]), indent=indent, ensure_ascii=False))
    write(tmp_path, "2024-01-04", '{"message": "0 rows", "data": []}')
    envelopes = envelope.read_envelopes(spark, str(tmp_path))
    cut, messages = large.read_large(spark, str(tmp_path))
    assert cut.select("raw").count() == 2 * (3 + 6 + 9)
    columns = ["date", *schema.EXPORT_CALL_LANDING]
    assert rows(envelope.call_feed(cut).select(*columns)) == rows(envelope.call_feed(envelopes).select(*columns))
    assert rows(envelope.agent_feed(cut)) == rows(envelope.agent_feed(envelopes))
    assert rows(messages.select("date", "message")) == rows(envelopes.select("date", "message"))
    assert rows(envelope.declared_rows(messages)) == rows(envelope.declared_rows(envelopes))


def test_ranges_are_tasks(spark, tmp_path, small_ranges):
    write(tmp_path, "2024-01-01", json.dumps({"message": "200 rows", "data": [{"lead_id": str(k)} for k in range(200)]}, indent=1))
    text = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert text.rdd.getNumPartitions() > 10
    cut, _ = large.read_large(spark, str(tmp_path))
    assert sorted(int(json.loads(r["raw"])["lead_id"]) for r in cut.collect()) == list(range(200))


@pytest.mark.parametrize("text", ['{"message": "2 rows", "data": [{"lead_id": "1"}, {"lead_id": "2"}', '{"message": "1 row", "data": [{"lead_id": "1"}]',
                                  '{"message": "1 row", "data": [{"lead_id": "1}]}', '{"message": "1 row", "data": [{"lead_id": "1"]}', ""])
def test_broken_files_have_no_rows(spark, tmp_path, text):
    write(tmp_path, "2024-01-01", text)
    assert large.read_large(spark, str(tmp_path))[0].count() == 0


def test_transitions_compose():
    """From every state, a piece gives what its letters give one after another."""
    rng = random.Random(3)

    def letters(text, state):
        depth = 0
        for c in text:
            if state == large.ESCAPE:
                state = large.STRING
            elif state == large.STRING:
                state = {'"': large.OUTSIDE, "\\": large.ESCAPE}.get(c, large.STRING)
            elif c == '"':
                state = large.STRING
            else:
                depth += (c in "{[") - (c in "}]")
        return state, depth

    for _ in range(4000):
        text = "".join(rng.choice('"\\{}[]a,:\n') for _ in range(rng.randint(0, 14)))
        for state in range(3):
            assert large._pass(text, state) == letters(text, state), (text, state)
