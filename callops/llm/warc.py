"""WARC archives as seekable Zstandard bundles.

Each task writes its records into bundles: independent frames of some records each, a skippable
frame with the seek table (compressed and plain size of every frame) as footer, and an index from a
record's identifier to its frame and the offset within the frame. A bundle's file name belongs to
one task attempt; the manifest, written by Spark, lists the files of the attempts that count, so the
files of lost or repeated attempts are never read.

Of records with equal payloads the one with the largest page_id is a response with the payload, the
others are revisits that hold the HTTP head only. Equal means the same SHA-256 and length.

Defined results: a null html is an empty payload; rows that repeat the largest page_id of their
payload are responses each; records with a null page_id have the identifier ``urn:page:`` and are
responses only if no other has the payload; a null url is an empty target; columns other than the
named ones are not carried.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callops.llm.common import map_arrow, text_of, written
from callops.session import settings, work_dir

#: Plain bytes of a frame and of a bundle; a record larger than a frame has a frame of its own.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
#: Fixed values of the seekable format: skippable frame, footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_CRLF = b"\r\n"


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def identifier(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record: an HTTP response, or a revisit with the HTTP head of an equal payload."""
    # a header value has no line breaks; such a url travels percent-encoded
    target = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A").encode()
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    lines = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"),
             b"WARC-Record-ID: <" + identifier(page_id).encode() + b">", b"WARC-Target-URI: " + target,
             b"WARC-Date: 1970-01-01T00:00:00Z", b"WARC-Payload-Digest: sha1:" + digest.encode()]
    if revisit:
        lines += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  b"WARC-Refers-To: <" + identifier(refers_to).encode() + b">"]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return _CRLF.join(lines) + _CRLF + _CRLF + block + _CRLF + _CRLF


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at ``at``."""
    end = raw.index(_CRLF + _CRLF, at)
    headers = dict(line.decode().split(": ", 1) for line in raw[at:end].split(_CRLF)[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    if raw[stop:stop + 4] != _CRLF + _CRLF:
        raise ValueError("broken record")
    return headers, raw[start:stop], stop + 4


def _open(path: str, write: bool):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system.open_output_stream(name, compression=None) if write else system.open_input_file(name)


class Bundle:
    """Writes one bundle; ``index`` gets (identifier, frame, offset in the frame, length) rows."""

    def __init__(self, path: str):
        from zstandard import ZstdCompressor

        self.path, self.file, self.codec = path, _open(path, True), ZstdCompressor(level=3)
        self.pending, self.size, self.total, self.frames, self.index = [], 0, 0, [], []

    def add(self, name: str, raw: bytes) -> None:
        if self.size and self.size + len(raw) > FRAME_BYTES:
            self._flush()
        self.index.append((name, len(self.frames), self.size, len(raw)))
        self.pending.append(raw)
        self.size += len(raw)
        self.total += len(raw)

    def _flush(self) -> None:
        if self.pending:
            packed = self.codec.compress(b"".join(self.pending))
            self.file.write(packed)
            self.frames.append((len(packed), self.size))
            self.pending, self.size = [], 0

    def close(self) -> None:
        self._flush()
        table = b"".join(struct.pack("<II", *frame) for frame in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.file.close()


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of every frame, read from the footer."""
    size = file.size()
    frames, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    table, start, found = file.read_at(8 * frames, size - 9 - 8 * frames), 0, []
    for packed, plain in struct.iter_unpack("<II", table):
        found.append((start, packed, plain))
        start += packed
    return found


def read_frame(file, frame: tuple[int, int, int]) -> bytes:
    from zstandard import ZstdDecompressor

    start, packed, plain = frame
    return ZstdDecompressor().decompress(file.read_at(packed, start), max_output_size=plain)


def fetch(path: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record of the index; only its frame is read."""
    with _open(path, False) as file:
        raw = read_frame(file, seek_table(file)[frame])
    headers, block, _ = parse(raw[offset:offset + length])
    return headers, block


def roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with ``refers_to`` and ``revisit``."""
    keyed = pages.withColumns({"seal": F.sha2(F.col("html"), 256), "size": F.octet_length("html")})
    first = (keyed.where(F.col("size") >= least).groupBy("seal", "size").agg(
        F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("rows")))
    # records that stand alone need no partner, and their payloads no join with a large table
    met = keyed.join(first.where(F.col("rows") > 1), ["seal", "size"], "left")
    revisit = F.col("largest").isNotNull() & ~F.col("largest").eqNullSafe(F.col("page_id"))
    return met.select("page_id", "url", "html", F.when(revisit, F.col("largest")).alias("refers_to"), revisit.alias("revisit"))


def write(pages: DataFrame, least: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """(manifest of bundles, index of records) of the archives written below the shared folder."""
    folder = work_dir(pages.sparkSession, "warc")
    pages.sparkSession.range(1).write.parquet(f"{folder}/made")  # makes the folder on any store
    told = roles(pages.select(F.col(page_id).alias("page_id"), text_of(url).alias("url"), text_of(html).alias("html")), least)

    def run(batches):
        bundle = None
        for batch in batches:
            for row in range(batch.num_rows):
                number, target, payload, refers_to, revisit = (batch.column(k)[row].as_py() for k in range(5))
                if bundle is None:
                    bundle = Bundle(f"{folder}/{uuid.uuid4().hex}.warc.zst")
                raw = payload.encode()
                bundle.add(identifier(number), record(number, target, raw, sha1(raw), refers_to, revisit))
                if bundle.total >= BUNDLE_BYTES:
                    bundle.close()
                    yield _index(bundle)
                    bundle = None
        if bundle is not None:
            bundle.close()
            yield _index(bundle)

    # tables of less than a MB a core are written by several tasks too; larger ones are dealt as ever
    with settings(pages.sparkSession, {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}):
        index = written(map_arrow(told, run, "bundle string, record_id string, frame int, start long, length long"), "index")
    return index.groupBy("bundle").agg(F.count(F.lit(1)).alias("records")), index


def _index(bundle: Bundle) -> pa.RecordBatch:
    names, frames, offsets, lengths = zip(*bundle.index)
    return pa.RecordBatch.from_arrays([
        pa.array([bundle.path] * len(names)), pa.array(names), pa.array(frames, pa.int32()), pa.array(offsets, pa.int64()),
        pa.array(lengths, pa.int64())], ["bundle", "record_id", "frame", "start", "length"])


def records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records of a bundle, a frame at a time."""
    with _open(path, False) as file:
        for frame in seek_table(file):
            raw, at = read_frame(file, frame), 0
            while at < len(raw):
                headers, block, at = parse(raw, at)
                yield headers, block


def read(manifest: DataFrame) -> DataFrame:
    """Per record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Bundles are dealt over as many tasks as there are.
    """

    def number(name: str) -> int | None:
        tail = name.removeprefix("<urn:page:").removesuffix(">")
        return int(tail) if tail else None

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for headers, block in records(path):
                    head, _, payload = block.partition(_CRLF + _CRLF)
                    size = int(head.rsplit(b"Content-Length: ", 1)[1])
                    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                    if kind == "response" and (size != len(payload) or digest != sha1(payload)):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} is not what was written")
                    refers = headers.get("WARC-Refers-To")
                    rows.append((number(headers["WARC-Record-ID"]), size, digest, kind, number(refers) if refers else None))
                    if len(rows) == 5000:
                        yield _report(rows)
                        rows = []
                if rows:
                    yield _report(rows)

    # a manifest is a few KB, which adaptive execution would hand to one task; a number asked for stays
    dealt = manifest.select("bundle").repartition(max(1, manifest.count()))
    return map_arrow(dealt, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _report(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
