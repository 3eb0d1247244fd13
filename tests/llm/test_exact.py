import hashlib
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from callops.llm import exact
from llm_samples import FOLDER, ODD, table  # noqa: F401

WHITE = dict.fromkeys(map(ord, " \t\n\x0b\f\r"))


def expected(rows):
    groups = defaultdict(list)
    for number, (k, t) in enumerate(rows):
        groups[(t or "").translate(WHITE)].append((-len(t or ""), k is None, k or 0, number))
    out = []
    for norm, members in groups.items():
        best = min(members)
        out += [(rows[m[3]][0], rows[best[3]][0], len(members), m == best, hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=repr)


def cases():
    rows = [(1, "a b"), (2, "ab"), (3, " a b "), (4, None), (5, ""), (6, " \n"), (7, ODD), (7, ODD), (None, ODD), (8, "A b"),
            (9, "a b"), (None, "only"), (None, "only"), (10, "x" * 300_000), (11, "x" * 300_000 + "\r\n")]
    return rows + [(100 + k, f"text {k % 37}" + " " * (k % 3)) for k in range(400)] + [(1000 + k, "hot copy") for k in range(300)]


def test_groups(table):
    found = exact.dedup(table(cases(), "doc_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(cases())


def test_texts_under_one_digest_are_told_apart(table):
    weak = exact.dedup(table(cases(), "doc_id long, text string"), digest=lambda norm: F.substring(F.sha2(norm, 256), 1, 1))
    assert sorted(map(tuple, weak.collect()), key=repr) == expected(cases())


def test_whole_rows_travel(table):
    docs = table(cases(), "doc_id long, text string")
    kept = exact.dedup(docs, carry=True).where("kept").select("doc.*")
    assert kept.columns == docs.columns
    assert kept.count() == len({(t or "").translate(WHITE) for _, t in cases()})


def test_empty(table):
    assert exact.dedup(table([], "doc_id long, text string")).collect() == []


def test_fuse_filter_knows_its_keys():
    random = np.random.default_rng(0)
    for n in (1, 2, 3, 10, 1000, 40_000):
        keys = random.integers(-2**63, 2**63 - 1, n)
        others = random.integers(-2**63, 2**63 - 1, 20_000)
        fuse = exact.build_fuse(keys)
        assert exact.probe_fuse(keys, *fuse).all()
        assert exact.probe_fuse(others, *fuse).mean() < 0.01


def test_buckets_without_positives_are_not_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact, "FILTER_KEYS", 16)
    schema = "digest string, rows long, best struct<chars:int,unknown:boolean,id:long>"
    old = spark.createDataFrame([(f"{k:064x}", 1, (-k, False, k)) for k in range(400)], schema)
    exact.build_snapshot(old, str(tmp_path / "snapshot"))
    batch = spark.createDataFrame([(f"{k:064x}", 2, (-1, False, k)) for k in [7, 399, *range(1000, 1010)]], schema)
    screened = exact.screen_batch(batch, str(tmp_path / "snapshot"), old.schema)
    assert {(int(r["digest"], 16), r["known"]["best"]["id"]) for r in screened.where("known is not null").collect()} == {(7, 7), (399, 399)}
    assert screened.count() == 12
    plan = screened._jdf.queryExecution().optimizedPlan().toString()
    read = {int(b) for b in re.findall(r"bucket#\d+L (?:IN|INSET|=) ?\(?([\d, ]+)", plan)[0].replace(",", " ").split()}
    assert 0 < len(read) < 8  # of 25


def test_bitmap_never_misses(spark):
    rows = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), "id")
    flagged = exact.may_repeat(rows, rows.where("id % 10 = 0").select("digest"))
    assert flagged.count() == 3000 and flagged.where("id % 10 = 0 and not may_repeat").count() == 0
    assert flagged.where("id % 10 <> 0 and may_repeat").count() < 500
