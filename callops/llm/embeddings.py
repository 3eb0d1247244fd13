"""Embedding near-dedup by an epsilon grid order join.

Unit vectors are sorted by the cells of a grid, as wide as the largest distance that still links, on
their leading principal axes. The sequence is cut into blocks with bounding boxes. Starting from the
whole sequence joined with itself, pairs of intervals are split level by level; a pair whose boxes
are farther apart than that distance cannot hold a link and is skipped. What is left are pairs of
blocks, in which the recursion goes on down to small runs, and the cosines of those are computed in
double precision.

Equal vectors of one label are one class with a count. A pair of blocks yields a count per vector and
a spanning star of its links, never the pairs themselves. Axes only decide what can be skipped: any
axes give the same links.

Defined results: a vector that is null, zero, or holds null or non-finite components, or whose label
is null, links with nothing and is its own component; vectors of different length do not link; rows
repeated link with each other; a null vec_id is a component's id only if it has no other; columns
other than the named ones are not carried.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from callops.llm.common import map_arrow, written
from callops.llm.graph import components, stars

#: Vectors of a block, of the runs that end the recursion, and axes of boxes and of the grid order.
BLOCK_ROWS, RUN_ROWS = 1024, 128
BOX_AXES, GRID_AXES = 8, 4
#: Axes are fitted on about this many vectors.
FIT_VECTORS = 4096
#: Blocks handed to Python at a time.
BLOCKS_A_BATCH = 16
#: A tree node has this many bits' worth of children.
FAN_BITS = 3
_SLACK = 1e-9


def _prepared(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """vec_id, label, and for vectors that can link: dim, key (hash of the components), vec (doubles)."""

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            dims, keys, vecs = [], [], []
            for known, row in zip(batch.column(1).is_valid().to_pylist(), lists):
                values = row.values if known and row.is_valid else None
                vec = None if values is None or not len(values) or values.null_count else np.asarray(values.to_numpy(), np.float64)
                if vec is None or not np.isfinite(vec).all() or not vec.any():
                    vec = None
                dims.append(None if vec is None else len(vec))
                keys.append(None if vec is None else hashlib.blake2b(vec.tobytes(), digest_size=16).digest())
                vecs.append(None if vec is None else vec.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()),
                                              pa.array(vecs, pa.binary())], ["vec_id", "label", "dim", "key", "vec"])

    given = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding))
    return map_arrow(given, run, "vec_id long, label string, dim int, key binary, vec binary")


def _units(vecs: list[bytes]) -> np.ndarray:
    found = np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)
    # the largest component first, so that squares neither overflow nor vanish
    found = found / np.abs(found).max(axis=1, keepdims=True)
    return found / np.sqrt((found * found).sum(axis=1, keepdims=True))


def fit_axes(classes: DataFrame, fit_vectors: int = FIT_VECTORS) -> dict[int, np.ndarray]:
    """Length → its principal axes (columns), from a sample of at most ``fit_vectors`` vectors by hash."""
    sample = classes.orderBy(F.xxhash64("key"), "label").limit(fit_vectors).select("dim", "vec").collect()
    axes = {}
    for dim in {row["dim"] for row in sample}:
        units = _units([row["vec"] for row in sample if row["dim"] == dim])
        _, vectors = np.linalg.eigh(units.T @ units - len(units) * np.outer(units.mean(0), units.mean(0)))
        axes[dim] = np.ascontiguousarray(vectors[:, ::-1][:, :BOX_AXES])
    return axes


def _project(units: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    dim = units.shape[1]
    found = units @ axes.get(dim, np.eye(dim)[:, :BOX_AXES])
    return np.pad(found, ((0, 0), (0, BOX_AXES - found.shape[1])))


def _cells(classes: DataFrame, axes: dict[int, np.ndarray], reach: float) -> DataFrame:
    """``classes`` with its grid cells c0, c1, ..."""
    shared = classes.sparkSession.sparkContext.broadcast(axes)  # some axes per length: a few kilobytes

    def run(batches):
        for batch in batches:
            dims, vecs = batch.column("dim").to_numpy(), batch.column("vec").to_pylist()
            cells = np.zeros((len(vecs), GRID_AXES), np.int32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                cells[at] = np.floor(_project(_units([vecs[k] for k in at]), shared.value)[:, :GRID_AXES] / reach)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, cells.T)], [*batch.schema.names, *names])

    names = [f"c{k}" for k in range(GRID_AXES)]
    schema = "node long, label string, dim int, n long, vec binary, " + ", ".join(f"{c} int" for c in names)
    return map_arrow(classes.select("node", "label", "dim", "n", "vec"), run, schema)


def _blocks(classes: DataFrame, axes: dict[int, np.ndarray], reach: float) -> DataFrame:
    """Blocks of the sorted sequence: label, dim, part, place, rows, box, and the rows packed."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(axes)
    order = ["label", "dim", *[f"c{k}" for k in range(GRID_AXES)], "node"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = _cells(classes, axes, reach).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def pack(place: int, rows: list[tuple]) -> pd.DataFrame:
        label, dim = rows[0][1:3]
        box = _project(_units([r[4] for r in rows]), shared.value)
        return pd.DataFrame({
            "label": [label], "dim": [dim], "part": [TaskContext.get().partitionId()], "place": [place],
            "low": [box.min(0)], "high": [box.max(0)], "nodes": [np.array([r[0] for r in rows]).tobytes()],
            "counts": [np.array([r[3] for r in rows]).tobytes()], "vecs": [b"".join(r[4] for r in rows)]})

    def run(batches):
        place, rows = 0, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("node", "label", "dim", "n", "vec"))):
                if rows and (len(rows) == BLOCK_ROWS or row[1:3] != rows[0][1:3]):
                    yield pa.RecordBatch.from_pandas(pack(place, rows), schema=layout, preserve_index=False)
                    place, rows = place + 1, []
                rows.append(row)
        if rows:
            yield pa.RecordBatch.from_pandas(pack(place, rows), schema=layout, preserve_index=False)

    box = pa.list_(pa.float64())
    layout = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("part", pa.int64()), ("place", pa.int64()), ("low", box),
                        ("high", box), ("nodes", pa.binary()), ("counts", pa.binary()), ("vecs", pa.binary())])
    return written(map_arrow(ordered, run, "label string, dim int, part long, place long, low array<double>, high array<double>, "
                                           "nodes binary, counts binary, vecs binary"), "blocks")


def _near(reach: float):
    """Whether two boxes (a_low, a_high, b_low, b_high) may hold vectors within reach."""
    gaps = [F.greatest(F.lit(0.0), F.col("a_low")[k] - F.col("b_high")[k], F.col("b_low")[k] - F.col("a_high")[k]) for k in range(BOX_AXES)]
    return sum((g * g for g in gaps), F.lit(0.0)) <= reach * reach + _SLACK


def block_pairs(boxes: DataFrame, reach: float) -> DataFrame:
    """(label, dim, a, b), a <= b: pairs of blocks that may hold links.

    ``boxes`` has label, dim, seq, low, high. Intervals of the sequence are the prefixes of ``seq``;
    each level splits both intervals of a pair and keeps the near pairs of children.
    """
    last = boxes.agg(F.max("seq")).first()[0] or 0
    levels = -(-int(last).bit_length() // FAN_BITS)
    kind = ["label", "dim"]
    pairs = boxes.select(*kind).distinct().select(*kind, F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    bounds = [F.min(F.col("low")[k]).alias(f"l{k}") for k in range(BOX_AXES)] + [F.max(F.col("high")[k]).alias(f"h{k}") for k in range(BOX_AXES)]
    for level in reversed(range(levels)):
        nodes = boxes.groupBy(*kind, F.shiftright("seq", FAN_BITS * level).alias("id")).agg(*bounds).select(
            *kind, "id", F.array(*[f"l{k}" for k in range(BOX_AXES)]).alias("low"), F.array(*[f"h{k}" for k in range(BOX_AXES)]).alias("high"))
        side = {x: nodes.select(*kind, F.shiftright("id", FAN_BITS).alias(x), F.col("id").alias(f"{x}_id"),
                                F.col("low").alias(f"{x}_low"), F.col("high").alias(f"{x}_high")) for x in "ab"}
        near = (pairs.join(side["a"], [*kind, "a"]).join(side["b"], [*kind, "b"])
                .where((F.col("a_id") <= F.col("b_id")) & _near(reach)))
        pairs = written(near.select(*kind, F.col("a_id").alias("a"), F.col("b_id").alias("b")), "pairs")
    return pairs


def _join_runs(a: dict, b: dict, same: bool, cosine: float, reach: float):
    """Counts and stars of the links between two blocks, by recursion over intervals of their rows."""
    found_a, found_b, links = np.zeros(len(a["n"]), np.int64), np.zeros(len(b["n"]), np.int64), []

    def join(i: slice, j: slice) -> None:
        if same and i.start > j.start:
            return
        gap = np.maximum(0, np.maximum(a["at"][i].min(0) - b["at"][j].max(0), b["at"][j].min(0) - a["at"][i].max(0)))
        if (gap * gap).sum() > reach * reach + _SLACK:
            return
        if i.stop - i.start > RUN_ROWS or j.stop - j.start > RUN_ROWS:
            for left in _halves(i):
                for right in _halves(j):
                    join(left, right)
            return
        hit = a["unit"][i] @ b["unit"][j].T >= cosine
        if same and i == j:
            np.fill_diagonal(hit, False)
        if hit.any():
            found_a[i] += hit @ b["n"][j]
            if not (same and i == j):
                found_b[j] += hit.T @ a["n"][i]
            x, y = np.nonzero(hit)
            links.append(stars(a["node"][i][x], b["node"][j][y]))

    join(slice(0, len(a["n"])), slice(0, len(b["n"])))
    if same:
        found_a += found_b
        found_b = np.zeros(0, np.int64)
    return found_a, found_b, links


def _halves(rows: slice) -> list[slice]:
    """Halves at a multiple of the run length, so that both sides of a block joined with itself split alike."""
    if rows.stop - rows.start <= RUN_ROWS:
        return [rows]
    middle = rows.start + (rows.stop - rows.start + 2 * RUN_ROWS - 1) // (2 * RUN_ROWS) * RUN_ROWS
    return [slice(rows.start, middle), slice(middle, rows.stop)]


def _pair_links(pairs: DataFrame, blocks: DataFrame, axes: dict[int, np.ndarray], cosine: float, reach: float) -> DataFrame:
    """(node, links, root): counts of links per node and pair of blocks, and stars (links 0, root set)."""
    spark = pairs.sparkSession
    shared = spark.sparkContext.broadcast(axes)
    packed = {x: blocks.select("label", "dim", F.col("seq").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("nodes", "counts", "vecs")])
              for x in "ab"}
    fetched = pairs.join(packed["a"], ["label", "dim", "a"]).join(packed["b"], ["label", "dim", "b"])

    def side(row: dict, x: str) -> dict:
        counts = np.frombuffer(row[f"{x}_counts"], np.int64)
        size = len(row[f"{x}_vecs"]) // len(counts)
        unit = _units([row[f"{x}_vecs"][k * size:(k + 1) * size] for k in range(len(counts))])
        return {"n": counts, "node": np.frombuffer(row[f"{x}_nodes"], np.int64), "unit": unit, "at": _project(unit, shared.value)}

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: column[0].as_py() for name, column in zip(batch.schema.names, batch.slice(k, 1).columns)}
                same = row["a"] == row["b"]
                a = side(row, "a")
                b = a if same else side(row, "b")
                for_a, for_b, links = _join_runs(a, b, same, cosine, reach)
                for block, found in ((a, for_a), (b, for_b)):
                    if found.any():
                        at = np.flatnonzero(found)
                        yield pa.RecordBatch.from_arrays([pa.array(block["node"][at]), pa.array(found[at]), pa.nulls(len(at), pa.int64())],
                                                         ["node", "links", "root"])
                if links:
                    node, root = stars(*map(np.concatenate, zip(*links)))
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.zeros(len(node), np.int64)), pa.array(root)],
                                                     ["node", "links", "root"])

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BLOCKS_A_BATCH))  # a row holds two blocks
    try:
        return written(map_arrow(fetched, run, "node long, links long, root long"), "links")
    finally:
        spark.conf.set(name, before)


def near_groups(vectors: DataFrame, cosine: float, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: vec_id, n_links, component_id (smallest vec_id reachable), kept."""
    reach = float(np.sqrt(2 - 2 * cosine))
    prepared = written(_prepared(vectors, vec_id, embedding, label), "vectors")
    kind = ["label", "dim", "key"]
    classes = prepared.where(F.col("key").isNotNull()).groupBy(*kind).agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("vec").alias("vec"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    axes = fit_axes(classes)
    blocks = _blocks(classes, axes, reach)
    bits = int(blocks.agg(F.max("place")).first()[0] or 0).bit_length()
    blocks = blocks.withColumn("seq", F.shiftleft("part", bits).bitwiseOR(F.col("place")))
    pairs = block_pairs(blocks.select("label", "dim", "seq", "low", "high"), reach)
    found = _pair_links(pairs, blocks, axes, cosine, reach)

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where(F.col("root").isNotNull()).select("node", "root")).toDF("node", "linked")
    rooted = (classes.join(counts, "node", "left").join(roots, "node", "left")
              .select(*kind, "least", F.coalesce("linked", "node").alias("root"),
                      (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    rooted = written(rooted, "rooted")
    ids = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    decided = written(rooted.join(ids, "root").select(*kind, "n_links", "component_id"), "decided")
    able = prepared.where(F.col("key").isNotNull()).join(decided, kind).select("vec_id", "n_links", "component_id")
    alone = prepared.where(F.col("key").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return able.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
