import base64
import hashlib

import zstandard
from pyspark.sql import functions as F

from callops.llm import warc
from llm_samples import FOLDER, ODD, table  # noqa: F401

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    out = []
    for number, (k, _, html) in enumerate(rows):
        payload = (html or "").encode()
        known = [x[0] for x in rows if (x[2] or "").encode() == payload and x[0] is not None]
        largest = max(known, default=None)
        revisit = largest is not None and k != largest
        out.append((k, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response",
                    largest if revisit else None))
    return sorted(out, key=repr)


def cases():
    rows = [(1, "http://a/", "x"), (2, None, None), (3, "u\r\nX: y%", ""), (4, "http://ü/", ODD + "\r\n\r\nWARC/1.1\r\n"), (5, "http://a/", "x"),
            (5, "http://a/", "x"), (None, "http://a/", "x"), (None, "n", "alone"), (None, "n", "alone"), (6, "big", "y" * 3_000_000)]
    return rows + [(100 + k, "http://c/", "same page" if k % 3 else f"page {k}") for k in range(200)]


def test_round_trip(table):  # noqa: F811
    manifest, _ = warc.write(table(cases(), SCHEMA))
    assert sorted(map(tuple, warc.read(manifest).collect()), key=repr) == expected(cases())


def test_index_finds_records_in_their_frames(table):  # noqa: F811
    rows = [(k, f"http://h/{k}", f"{k} " * 20_000) for k in range(60)]
    _, index = warc.write(table(rows, SCHEMA).coalesce(1))
    places = index.collect()
    assert len({(r.bundle, r.frame) for r in places}) > 3
    for r in places[::7]:
        headers, block = warc.fetch(r.bundle, r.frame, r.start, r.length)
        number = int(r.record_id.rsplit(":", 1)[1])
        assert headers["WARC-Record-ID"] == f"<{r.record_id}>" and headers["WARC-Target-URI"] == f"http://h/{number}"
        assert block.endswith(b"\r\n\r\n" + rows[number][2].encode())


def test_bundles_are_ordinary_zstandard(table):  # noqa: F811
    manifest, _ = warc.write(table([(1, "http://a/", "hello")], SCHEMA))
    path = manifest.first().bundle
    with open(path.removeprefix("file:"), "rb") as f:
        raw = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"hello" in raw


def test_many_bundles(table, monkeypatch):  # noqa: F811
    bundle = warc.Bundle  # limits are read when a task runs, so a small table is cut here by hand
    assert bundle and warc.BUNDLE_BYTES > warc.FRAME_BYTES
    manifest, index = warc.write(table(cases(), SCHEMA).repartition(5))
    assert manifest.count() >= 2 and index.count() == len(cases())


def test_bundles_are_read_by_different_tasks(table):  # noqa: F811
    index = warc.write(table(cases(), SCHEMA))[1]
    for _ in range(3):
        index = index.union(warc.write(table(cases(), SCHEMA))[1])
    manifest = index.groupBy("bundle").agg(F.count(F.lit(1)).alias("records"))
    bundles = manifest.count()
    assert bundles >= 4
    tasks = warc.read(manifest).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == bundles and sum(r["count"] for r in tasks) == 4 * len(cases())


def test_empty(table):  # noqa: F811
    manifest, index = warc.write(table([], SCHEMA))
    assert manifest.collect() == index.collect() == [] and warc.read(manifest).collect() == []
