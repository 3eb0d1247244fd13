"""SimHash near-dedup by multi-index hashing.

A document's fingerprint has a bit set where more than half of its word shingles' XXH64 values have
it set. The fingerprints are cut into segments; two within ``k`` bits agree in some segment up to few
bits, so each distinct fingerprint is filed under the exact value of every segment and looked up
under all values of a small Hamming ball around it. What meets is verified by the whole distance.

Equal fingerprints are one node. The links found in a cell of the tables leave it as a spanning star
and not as pairs, and a cell with very many entries or look-ups is split into a grid, so the work of
a group of near copies is spread and its output grows with its members only.

Defined results: null and empty texts have fingerprint zero, linked like any other; a null doc_id is
the smallest of its component only if there is no other; rows repeated whole count each.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from callops.llm.common import batches_of, map_arrow, text_of, written
from callops.llm.graph import components, stars

#: Entries or look-ups of one cell; larger cells are split.
CELL_ROWS = 4096
#: Pairs compared at a time, shingles hashed at a time.
PAIRS = 1 << 21
SHINGLES = 1 << 17
#: Bytes of a text whose words are held at a time.
PART_BYTES = 4 << 20
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _word_parts(data: bytes):
    """The words of a text, part by part; parts end at white space."""
    at = 0
    while at < len(data):
        end = _WHITE.search(data, at + PART_BYTES)
        stop = end.start() if end else len(data)
        yield data[at:stop].split()  # bytes split at the six ASCII white-space characters
        at = stop


def _count_bits(words: list[bytes], size: int, ones: np.ndarray) -> int:
    """Add the bits of the hashes of all shingles of ``size`` words; their number."""
    from xxhash import xxh64_intdigest

    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:len(words) - size + 1]
    ends = ends[size - 1:] - 1
    for at in range(0, len(starts), SHINGLES):
        spans = zip(starts[at:at + SHINGLES].tolist(), ends[at:at + SHINGLES].tolist())
        hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in spans], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return len(starts)


def fingerprint(text: str, shingle: int) -> int:
    """The 64-bit SimHash of a text, unsigned."""
    ones, total, kept = np.zeros(64, np.int64), 0, []
    for part in _word_parts(text.encode().translate(_LOWER)):
        words = kept + part
        if len(words) >= shingle:
            total += _count_bits(words, shingle, ones)
            words = words[len(words) - shingle + 1:]  # start the next part's first shingles
        kept = words
    if not total and kept:
        total = _count_bits(kept, len(kept), ones)
    return int(_BITS[2 * ones > total].sum())


def fingerprints(docs: DataFrame, shingle: int, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.array(found, np.uint64).view(np.int64))], [*keep, "fp"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("fp", T.LongType())])
    return map_arrow(docs.select(*keep, text_of(text).alias("_text")), run, schema)


def ball_plan(bits: int, segments: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment: within ``bits`` overall, one segment is within its radius.

    With bits = segments * r + a, radius r in the first a + 1 segments and r - 1 in the others is
    enough (a radius of -1 needs no look-up).
    """
    if not 2 <= segments <= 16:
        raise ValueError("2 to 16 segments")
    r, a = divmod(bits, segments)
    shifts = [64 * i // segments for i in range(segments + 1)]
    return [(shifts[i], shifts[i + 1] - shifts[i], r if i <= a else r - 1) for i in range(segments)
            if r > 0 or i <= a]


def _probes(fps: DataFrame, bits: int, segments: int) -> DataFrame:
    """Table entries (role 0) and look-ups (role 1): ``cell``, ``role``, ``fp``."""
    parts = []
    for number, (shift, width, radius) in enumerate(ball_plan(bits, segments)):
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        masks = [sum(1 << b for b in flips) for n in range(radius + 1) for flips in combinations(range(width), n)]
        seg = F.lit(number << 58)
        parts.append(fps.select("fp", F.lit(0).alias("role"), value.alias("value"), seg.alias("seg")))
        tried = fps.select("fp", value.alias("value"), F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
        # of two values that differ, the one without the mask's lowest bit looks the other up
        lowest = F.col("mask").bitwiseAND(-F.col("mask"))
        parts.append(tried.where(F.col("value").bitwiseAND(lowest) == 0)
                     .select("fp", F.lit(1).alias("role"), F.col("value").bitwiseXOR(F.col("mask")).alias("value"), seg.alias("seg")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return rows.select(F.col("seg").bitwiseOR(F.col("value")).alias("cell"), "role", "fp")


def _split(rows: DataFrame, cell_rows: int) -> DataFrame:
    """Give every row a ``tile``: cells beyond ``cell_rows`` become a grid of entries by look-ups."""
    sizes = rows.groupBy("cell").agg(F.sum(1 - F.col("role")).alias("entries"), F.sum("role").alias("lookups"))
    parts = [F.ceil(F.col(c) / cell_rows).cast("int").alias(p) for c, p in (("entries", "rows_"), ("lookups", "cols"))]
    large = written(sizes.where((F.col("entries") > cell_rows) | (F.col("lookups") > cell_rows)).select("cell", *parts), "large")
    known = rows.join(large, "cell", "left")
    n_rows, n_cols = (F.greatest(F.coalesce(p, F.lit(1)), F.lit(1)) for p in ("rows_", "cols"))
    mine = F.pmod(F.xxhash64("fp"), F.when(F.col("role") == 0, n_rows).otherwise(n_cols)).cast("int")
    others = F.sequence(F.lit(0), F.when(F.col("role") == 0, n_cols).otherwise(n_rows) - 1)
    spread = known.select("cell", "role", "fp", mine.alias("mine"), n_cols.alias("width"), F.explode(others).alias("other"))
    tile = F.when(F.col("role") == 0, F.col("mine") * F.col("width") + F.col("other")).otherwise(
        F.col("other") * F.col("width") + F.col("mine"))
    return spread.select("cell", tile.alias("tile"), "role", "fp")


def _links_of(group: np.ndarray, role: np.ndarray, fp: np.ndarray, bits: int):
    """Stars of the links between entries and look-ups of each group (rows in order of group and role)."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    entries = np.add.reduceat(1 - role, starts)
    totals = np.diff(np.r_[starts, len(group)])
    lookup = np.flatnonzero(role == 1)
    of = np.searchsorted(starts, lookup, side="right") - 1
    first, n = starts[of], entries[of]
    for a, b in batches_of(n, PAIRS):
        count = n[a:b]
        left = np.repeat(fp[lookup[a:b]], count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        right = fp[np.repeat(first[a:b], count) + within]
        near = (left != right) & (np.bitwise_count(left ^ right) <= bits)
        if near.any():
            yield stars(left[near].view(np.int64), right[near].view(np.int64))


def links(fps: DataFrame, bits: int, segments: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints (column ``fp``) joined by chains of near pairs."""
    tiles = _split(written(_probes(fps, bits, segments), "probes"), cell_rows)
    dealt = tiles.repartition("cell", "tile").sortWithinPartitions("cell", "tile", "role", "fp")

    def run(batches):
        held: list[pa.Table] = []

        def finish(rows: pa.Table):
            cell, tile, role, fp = (rows.column(c).to_numpy() for c in ("cell", "tile", "role", "fp"))
            change = np.r_[False, (cell[1:] != cell[:-1]) | (tile[1:] != tile[:-1])]
            for a, b in _links_of(np.cumsum(change), role.astype(np.int64), fp.view(np.uint64), bits):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:  # a group may go on in the next batch
            held.append(pa.Table.from_batches([batch]))
            rows = pa.concat_tables(held)
            cell, tile = rows.column("cell").to_numpy(), rows.column("tile").to_numpy()
            whole = int(np.argmax((cell == cell[-1]) & (tile == tile[-1]))) if len(cell) else 0
            if whole:
                yield from finish(rows.slice(0, whole))
            held = [rows.slice(whole)]
        if held and len(held[0]):
            yield from finish(pa.concat_tables(held))

    return map_arrow(dealt, run, "a long, b long")


def near_groups(docs: DataFrame, shingle: int, bits: int, doc_id: str = "doc_id", text: str = "text",
                segments: int = 4, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, seal, fp per row; fp, component_id, head per distinct fingerprint).

    ``seal`` is a hash of the text; ``head`` is the (doc_id, seal) that stays for the component.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("seal"), F.col(text).alias("text"))
    marked = written(fingerprints(given, shingle, ["doc_id", "seal"], "text"), "fingerprints")
    head = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("seal"))
    nodes = written(marked.groupBy("fp").agg(F.min(head).alias("head")), "nodes")
    roots = components(links(nodes.select("fp"), bits, segments, cell_rows)).toDF("fp", "linked")
    rooted = nodes.join(roots, "fp", "left").select("fp", "head", F.coalesce("linked", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    heads = written(rooted.groupBy("root").agg(F.min("head").alias("head")), "heads")
    decided = rooted.select("fp", "root").join(heads, "root").select("fp", F.col("head.doc_id").alias("component_id"), "head")
    return marked, decided


def report(docs: DataFrame, shingle: int, bits: int, **columns) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    marked, decided = near_groups(docs, shingle, bits, **columns)
    return marked.join(decided, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, shingle: int, bits: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each component."""
    _, decided = near_groups(docs, shingle, bits, doc_id, text)
    heads = decided.select(F.col("head.doc_id").alias("id"), F.col("head.seal").alias("seal")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(doc_id).alias("id"), F.xxhash64(text_of(text)).alias("seal"))
    once = rows.dropDuplicates(["id", "seal"])  # rows repeated whole
    kept = once.join(heads, once["id"].eqNullSafe(heads["id"]) & (once["seal"] == heads["seal"]), "left_semi")
    return kept.select("doc.*")
