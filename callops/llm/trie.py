"""Prefix trie of conversations, and sums over its subtrees by centroid decomposition.

Building. A conversation's turns get their positions from a global sort (``_numbered``), so that one
conversation may fill many tasks. A turn's node is known by the exclusive or of 128-bit hashes of
(depth, role, text) over the turns up to it; the running value comes from the same ranges with a
carry between them. Turns with equal depth and value are one node, named by its smallest member and
its depth.

Summing. The parent-edge forest is decomposed at weighted centroids, the weight of a node being its
members: the weight below a node is the sum of (turns left) over its members, one aggregation, so no
sum over the tree is needed to find centroids. In a component the nodes with at least half of the
weight below them are the path from its top to its centroid. The centroid's total is added along that
path, its weight is taken off it, and the component falls into the centroid's children and the rest,
each with at most half of the weight. Components over ``TASK_NODES`` nodes are split with joins, all
of them in one round; smaller ones are decomposed to the end in numpy, many in a task.

Defined results: null role or text counts as empty; rows without ``conv_id`` belong to no
conversation and are left out; turns that share a number (or have none: first) are ordered by role,
then by text's digest; repeated rows are turns of their own; an empty table has no nodes; only the
four named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from callops.llm.common import WORD, map_arrow, text_of, written

#: Nodes of a component that one task may decompose at once.
TASK_NODES = 1024
#: Ids that one row carries on the way to a node's digest.
CHUNK_IDS = 1024


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text digest, words: what the trie needs of a turn, without its text."""
    role, text = text_of("role"), text_of("text")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.sha2(text, 256).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def _numbered(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows with ``part`` and ``at``, numbers that follow conversation, turn, role and digest over all tasks."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    return written(ranged.withColumn("at", at), purpose).withColumn("part", F.shiftright("at", 33))


def _positions(numbered: DataFrame) -> DataFrame:
    """Numbered turns with ``pos``, their place in the conversation from 1."""
    ranges = numbered.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return numbered.join(ranges, ["conv_id", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before") + 1)


def shared_heads(numbered: DataFrame, family: int, most: int) -> DataFrame:
    """Turns of rebuilt conversations: conv_id, depth, role, digest, words, length.

    Conversation c takes the first h turns of conversation c - c % ``family``, h being crc32(c) %
    ``most``, in place of its own first h turns. A conversation without a turn has one row of depth 0.
    """
    placed = _positions(numbered)
    own = written(placed.select("conv_id", "pos", "role", "digest", "words"), "positions")
    sizes = own.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn(
        "h", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)))
    heads = own.where((F.col("pos") < most) & (F.col("conv_id") % family == 0)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "digest", "words"))).alias("head"))  # most - 1 turns at most
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array().cast(heads.schema["head"].dataType))
    convs = sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(
        heads.withColumnRenamed("conv_id", "base"), "base", "left").select("conv_id", "n", "h", head.alias("head"))
    convs = convs.withColumn("kept", F.size("head").cast("long")).withColumn(
        "length", F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("kept"))
    convs = written(convs, "conversations")
    tails = own.join(convs.select("conv_id", "h", "kept", "length"), "conv_id").where(F.col("pos") > F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("kept")).alias("depth"), "role", "digest", "words", "length")
    fronts = convs.select("conv_id", F.explode("head").alias("x"), "length").select(
        "conv_id", F.col("x.pos").alias("depth"), "x.role", "x.digest", "x.words", "length")
    none = convs.where(F.col("length") == 0).select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("role"), F.lit("").alias("digest"),
        F.lit(0).cast("long").alias("words"), "length")
    return tails.union(fronts).union(none)


def _prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, words, length and the hash ``a``, ``b`` of all turns up to the row's."""
    hashes = [F.xxhash64(F.lit(seed), "depth", "role", "digest").alias(name) for name, seed in (("a", 1), ("b", 2))]
    hashed = rows.where(F.col("depth") > 0).select("conv_id", "depth", "words", "length", *hashes)
    ranged = hashed.repartitionByRange("conv_id", "depth").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "hashes")
    whole = ranged.groupBy("conv_id", "part").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = whole.select("conv_id", "part", *(F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in "ab"))
    running = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(carry, ["conv_id", "part"]).select(
        "conv_id", "depth", "words", "length", *(F.bit_xor(c).over(running).bitwiseXOR(F.col(f"{c}0")).alias(c) for c in "ab"))


def build(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths) of the trie of rebuilt turns.

    nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, words (of the last text), weight
    (members below it, itself included). paths: conv_id, depth and the node there, named ``node``, with
    its ``parent``, for every turn of every conversation, and ``ends``, whether it is the last.
    """
    prefixes = written(_prefixes(rows), "prefixes")
    found = written(prefixes.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.first("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight")), "nodes")
    own = prefixes.join(found.select("depth", "a", "b", "node"), ["depth", "a", "b"]).select(
        "conv_id", "depth", "node", (F.col("depth") == F.col("length")).alias("ends"))
    # the root: its members are all conversations
    lengths = rows.groupBy("conv_id").agg(F.max("length").alias("length"))
    least, n_convs, n_turns = lengths.agg(F.min("conv_id"), F.count(F.lit(1)), F.sum("length")).first()  # one row
    none, root = F.lit(None).cast("long"), F.lit(least).cast("long")
    own = written(own, "own")
    above = own.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    paths = own.where(F.col("depth") > 1).join(above, ["conv_id", "depth"]).select("conv_id", "depth", "node", "parent", "ends")
    first = own.where(F.col("depth") == 1).select("conv_id", "depth", "node", root.alias("parent"), "ends")
    empty = rows.where(F.col("length") == 0).select("conv_id", "depth", root.alias("node"), none.alias("parent"), F.lit(True).alias("ends"))
    paths = written(paths.union(first).union(empty), "paths")
    parents = paths.where((F.col("depth") > 0) & (F.col("conv_id") == F.col("node"))).select("node", "depth", F.col("parent").alias("parent_conv_id"))
    nodes = found.join(parents, ["node", "depth"]).select(
        F.col("node").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "words", "weight")
    top = rows.sparkSession.range(1 if n_convs else 0).select(
        root.alias("conv_id"), F.lit(0).cast("long").alias("depth"), none.alias("parent_conv_id"), F.lit(n_convs).cast("long").alias("n_convs"),
        F.lit(0).cast("long").alias("words"), F.lit((n_turns or 0) + n_convs).cast("long").alias("weight"))
    return written(nodes.union(top), "trie"), paths


# ------------------------------------------------------------------ centroid decomposition

def _decompose(top: np.ndarray, parent: np.ndarray, own: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (columns) below every node of a forest, by centroid decomposition of all its trees.

    ``parent`` is the index of a node's parent in its tree, -1 at the top; ``top`` the index of the
    tree's top; ``weight`` the sum of ``own`` (at least 1) below a node.
    """
    n = len(parent)
    # preorder: a node's place leaves room for the weight of what comes before it
    place, follow = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at, heavy, free = own.tolist(), weight.tolist(), 0
    places, nexts = place.tolist(), follow.tolist()
    for i, p in enumerate(parent.tolist()):  # parents come first
        if p < 0:
            places[i], free = free, free + heavy[i]
        else:
            places[i] = nexts[p]
            nexts[p] += heavy[i]
        nexts[i] = places[i] + at[i]
    order = np.argsort(np.array(places))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    tree = rank[top[order]]                       # the component, named by its top
    up = np.where(parent[order] < 0, -1, rank[parent[order]])
    sorted_places = np.array(places)[order]
    end = np.searchsorted(sorted_places, sorted_places + weight[order])
    below, values = weight[order].copy(), values[order]
    sums, node = np.zeros_like(values), np.arange(n)  # nodes not yet centroids, in (component, preorder)
    while len(node):
        total = below[tree[node]]
        path = 2 * below[node] >= total
        centroid = np.zeros(n, np.int64)
        np.maximum.at(centroid, tree[node[path]], node[path])
        mine = centroid[tree[node]]
        inside = (node >= mine) & (node < end[mine])
        amounts = np.zeros_like(values)
        np.add.at(amounts, mine[inside], values[node[inside]])
        sums[node[path]] += amounts[mine[path]]       # along the path from the centroid to the top
        lighter = path & (node != mine)
        below[node[lighter]] -= below[mine[lighter]]
        # below the centroid: a component for each child, named by it
        starts = inside & (up[node] == mine)
        last = np.maximum.accumulate(np.where(starts, np.arange(len(node)), 0))
        moved = inside & (node != mine)
        tree[node[moved]] = node[last[moved]]
        node = node[node != mine]
        node = node[np.argsort(tree[node], kind="stable")]
    out = np.empty_like(sums)
    out[order] = sums
    return out


_PIECE = ["top", "top_depth", "conv_id", "depth", "parent_conv_id", "own", "weight", "leaves", "saved"]


def _in_tasks(components: DataFrame) -> DataFrame:
    """conv_id, depth and the sums of leaves and saved below each node of whole components of bounded size."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        c = {name: table[name].to_numpy() for name in table.column_names if name != "parent_conv_id"}
        above = table["parent_conv_id"].fill_null(0).to_numpy()
        where = {key: i for i, key in enumerate(zip(c["conv_id"].tolist(), c["depth"].tolist()))}
        tops = np.array([where[key] for key in zip(c["top"].tolist(), c["top_depth"].tolist())], np.int64)
        parent = np.array([-1 if t == i else where[key] for i, (t, key) in enumerate(
            zip(tops.tolist(), zip(above.tolist(), (c["depth"] - 1).tolist())))], np.int64)
        sums = _decompose(tops, parent, c["own"], c["weight"], np.stack([c["leaves"], c["saved"]], 1))
        return pa.RecordBatch.from_arrays([table["conv_id"].combine_chunks(), table["depth"].combine_chunks(),
                                           pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["conv_id", "depth", "leaves", "saved"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.table(batch)
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows >= 16 * TASK_NODES:  # the last component may go on in the next batch
                top, deep = held["top"].to_numpy(), held["top_depth"].to_numpy()
                cut = int(np.flatnonzero((top != top[-1]) | (deep != deep[-1])).max(initial=-1)) + 1
                if cut:
                    yield solve(held.slice(0, cut).combine_chunks())
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield solve(held.combine_chunks())

    together = components.select(*_PIECE).repartition("top", "top_depth").sortWithinPartitions(
        "top", "top_depth", "depth", "conv_id")
    return map_arrow(together, run, "conv_id long, depth long, leaves long, saved long")


def roll_up(nodes: DataFrame, paths: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """conv_id, depth, leaves, saved: the sums of the columns of those names over each node's subtree.

    ``nodes`` and ``paths`` are those of ``build``, with ``leaves`` and ``saved``. The number of rounds
    over large components is at most the logarithm of the number of turns.
    """
    root = nodes.where("depth = 0").first()  # one row; none without conversations
    state = nodes.select(
        F.lit(root and root["conv_id"]).cast("long").alias("top"), F.lit(0).cast("long").alias("top_depth"), "conv_id", "depth",
        "parent_conv_id", F.col("n_convs").alias("own"), "weight", "leaves", "saved",
        F.lit(0).cast("long").alias("more_leaves"), F.lit(0).cast("long").alias("more_saved"))
    state = written(state, "component")
    done: list[DataFrame] = []
    key = ["top", "top_depth"]
    while True:
        sizes = written(state.groupBy(*key).agg(F.count(F.lit(1)).alias("nodes"), F.max("weight").alias("total")), "sizes")
        large = sizes.where(F.col("nodes") > task_nodes)
        # a bounded component is solved in a task; what was added on paths is added again to its nodes
        small = state.join(sizes.where(F.col("nodes") <= task_nodes).select(*key), key)
        done.append(written(_in_tasks(small).unionByName(
            small.select("conv_id", "depth", F.col("more_leaves").alias("leaves"), F.col("more_saved").alias("saved"))), "solved"))
        if large.isEmpty():
            break
        active = state.join(large.select(*key, "total"), key).withColumn("heavy", 2 * F.col("weight") >= F.col("total"))
        active = written(active, "active")
        centroids = written(active.where("heavy").groupBy(*key).agg(
            F.max(F.struct("depth", "conv_id", "weight")).alias("c")).select(
            *key, F.col("c.conv_id").alias("cc"), F.col("c.depth").alias("cd"), F.col("c.weight").alias("cw")), "centroids")
        # which child of the centroid a node is below: the node of the child's depth on its own conversation's path
        members = paths.join(centroids.select(F.col("cc").alias("parent"), (F.col("cd") + 1).alias("depth"), *key), ["parent", "depth"]).select(
            *key, "conv_id", F.col("node").alias("child"))
        placed = active.join(centroids, key).join(members, [*key, "conv_id"], "left")
        placed = placed.withColumn("is_centroid", (F.col("conv_id") == F.col("cc")) & (F.col("depth") == F.col("cd")))
        placed = written(placed.withColumn("below", F.col("is_centroid") | (F.col("child").isNotNull() & (F.col("depth") > F.col("cd")))), "placed")
        amounts = written(placed.where("below").groupBy(*key).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")), "amounts")
        added = placed.join(amounts, key)
        moved = F.col("below") & ~F.col("is_centroid")
        step = [F.when(F.col("heavy"), F.col(add)).otherwise(F.lit(0)) for add in ("l", "s")]
        added = written(added.select(
            F.when(moved, F.col("child")).otherwise(F.col("top")).alias("top"),
            F.when(moved, F.col("cd") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            "conv_id", "depth", "parent_conv_id", "own",
            F.when(F.col("heavy") & ~F.col("is_centroid"), F.col("weight") - F.col("cw")).otherwise(F.col("weight")).alias("weight"),
            "leaves", "saved", (F.col("more_leaves") + step[0]).alias("more_leaves"), (F.col("more_saved") + step[1]).alias("more_saved"),
            "is_centroid"), "added")
        done.append(added.where("is_centroid").select("conv_id", "depth", F.col("more_leaves").alias("leaves"), F.col("more_saved").alias("saved")))
        state = added.where(~F.col("is_centroid")).drop("is_centroid")
    out = done[0]
    for one in done[1:]:
        out = out.unionByName(one)
    return out.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def end_digests(paths: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256: over the ids of the conversations that end in each node, ascending.

    A digest is taken of one stream in order; ids travel to it in chunks of joined text, CHUNK_IDS to a row.
    """
    ends = paths.where("ends").select("node", "depth", "conv_id")
    order = ["node", "depth", "conv_id"]

    def joined(batches):
        for batch in batches:
            node, depth = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ids = batch.column(2).to_pylist()
            if not ids:
                continue
            cuts = np.flatnonzero((np.diff(node) != 0) | (np.diff(depth) != 0)) + 1
            edges = np.concatenate([[0], cuts, [len(ids)]]).tolist()
            spans = [(a, min(a + CHUNK_IDS, e)) for s, e in zip(edges, edges[1:]) for a in range(s, e, CHUNK_IDS)]
            first = [a for a, _ in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[first]), pa.array(depth[first]), pa.array([ids[a] for a in first], pa.int64()),
                 pa.array([",".join(map(str, ids[a:b])) for a, b in spans])], ["node", "depth", "first", "ids"])

    def digested(batches):
        now, digest = None, None
        out: list[tuple] = []
        for batch in batches:
            for node, depth, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                if (node, depth) != now:
                    if now is not None:
                        out.append((*now, digest.hexdigest()))
                    now, digest = (node, depth), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
            if len(out) > 10_000:
                yield record(out)
                out = []
        if now is not None:
            out.append((*now, digest.hexdigest()))
        yield record(out)

    def record(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
                                          ["conv_id", "depth", "ends_sha256"])

    chunks = map_arrow(ends.repartitionByRange(*order).sortWithinPartitions(*order), joined, "node long, depth long, first long, ids string")
    by_node = chunks.repartition("node", "depth").sortWithinPartitions("node", "depth", "first")
    return map_arrow(by_node, digested, "conv_id long, depth long, ends_sha256 string")


def report(conversations: DataFrame, family: int, most: int, task_nodes: int = TASK_NODES) -> DataFrame:
    """One row per node: members, children, leaves and saved tokens below it, digest of the ids that end in it."""
    rows = written(shared_heads(_numbered(turns(conversations), "turns"), family, most), "rebuilt")
    nodes, paths = build(rows)
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    saved: Column = (F.col("n_convs") - 1) * F.col("words")
    nodes = written(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", saved), "valued")
    sums = roll_up(nodes, paths, task_nodes).select("conv_id", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    return nodes.join(sums, ["conv_id", "depth"]).join(end_digests(paths), ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
