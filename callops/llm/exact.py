"""Exact dedup against an immutable snapshot behind binary-fuse filters.

A snapshot (``build_snapshot``) is a folder of earlier documents' digests by bucket, and one static
binary-fuse filter per bucket. The digests of a new batch, grouped among themselves first, are screened
(``screen_batch``): what no filter knows is new for certain; positives are joined with the exact digests
of their buckets, the only ones that are read. Texts that share a digest are then compared byte by byte;
texts that differ in spite of one digest form groups by the bytes themselves.

Only texts that may have a copy travel: digests with more than one row set bits of a bitmap of bounded
size, and a row whose bit is not set is alone, which its own scan tells.

Equal means equal after deleting all white space. Of a group the row with the most code points, then
the smallest doc_id, stays. Defined results: null text counts as empty; a null doc_id loses every
tie; of rows repeated whole, one stays; an empty batch or snapshot works; clashing column names do
not matter, as a document's columns travel in one struct.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from callops.llm.common import WHITE, free_memory, importable, text_of, work_dir, written

#: Digests per filter; the number of filters grows with the snapshot.
FILTER_KEYS = 32_768
#: Most bits of the bitmap of repeated digests, which goes to all executors: 16 MB.
MOST_BITS = 1 << 27
_SEED_STEP = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str | Column) -> Column:
    return F.translate(text_of(text), WHITE, "")


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser, a bijection of the keys for each seed."""
    h = keys ^ (np.uint64(seed + 1) * _SEED_STEP)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _slots(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots of each key, in neighbouring segments of ``length`` (a power of two), and its fingerprint."""
    h = _mix(keys, seed)
    first = ((h >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64), ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_fuse(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) of a binary-fuse filter of distinct 64-bit keys."""
    keys = np.unique(keys.astype(np.uint64))
    n = max(len(keys), 2)
    length = 1 << int(np.clip(np.floor(np.log(n) / np.log(3.33) + 2.25), 2, 18))
    capacity = n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    segments = max(1, int(np.ceil(capacity / length)) - 2)
    for seed in range(1000):
        slots, prints = _slots(keys, seed, length, segments)
        size = (segments + 2) * length
        count = np.bincount(slots.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # the exclusive or of the keys that use a slot: the key, where one is left
        for row in slots:
            np.bitwise_xor.at(owner, row, np.arange(len(keys)))
        peeled, layers, alone = 0, [], np.flatnonzero(count == 1)
        while len(alone):
            key, first = np.unique(owner[alone], return_index=True)
            layers.append((key, alone[first]))
            peeled += len(key)
            touched = slots[:, key].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(owner, touched, np.tile(key, 3))
            alone = np.unique(touched[count[touched] == 1])
        if peeled == len(keys):
            table = np.zeros(size, np.uint8)
            for key, slot in reversed(layers):
                mine = slots[:, key]
                table[slot] = prints[key] ^ np.bitwise_xor.reduce(np.where(mine == slot, 0, table[mine]), axis=0)
            return seed, length, segments, table.tobytes()
    raise RuntimeError("no seed peels these keys")


def probe_fuse(keys: np.ndarray, seed: int, length: int, segments: int, table: bytes) -> np.ndarray:
    """Which keys the filter may hold: all that it was built of, and one in 256 of the others."""
    slots, prints = _slots(keys.astype(np.uint64), seed, length, segments)
    return np.bitwise_xor.reduce(np.frombuffer(table, np.uint8)[slots], axis=0) == prints


def _bucketed(digests: DataFrame, buckets: int) -> DataFrame:
    key = F.xxhash64("digest")
    return digests.withColumn("key", key).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))


def filters(digests: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of the snapshot's digests; a bucket holds about FILTER_KEYS of them."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        seed, length, segments, table = build_fuse(group["key"].to_numpy())
        free_memory()
        return pd.DataFrame({"bucket": [group["bucket"].iloc[0]], "buckets": [buckets], "seed": [seed], "length": [length],
                             "segments": [segments], "fingerprints": [table]})

    return _bucketed(digests, buckets).select("bucket", "key").groupBy("bucket").applyInPandas(
        build, "bucket long, buckets long, seed int, length int, segments int, fingerprints binary")


def screen(digests: DataFrame, filter_table: DataFrame, buckets: int) -> DataFrame:
    """The batch's distinct digests with their bucket and ``positive``: whether the snapshot's filter of it knows them."""

    def probe(group: pd.DataFrame, filter_: pd.DataFrame) -> pd.DataFrame:
        known = np.zeros(len(group), bool)
        if len(filter_) and len(group):
            f = filter_.iloc[0]
            known = probe_fuse(group["key"].to_numpy(), f["seed"], f["length"], f["segments"], f["fingerprints"])
        free_memory()
        return pd.DataFrame({"digest": group["digest"], "bucket": group["bucket"], "positive": known})

    given = _bucketed(digests.select("digest"), buckets)
    return given.groupBy("bucket").cogroup(filter_table.groupBy("bucket")).applyInPandas(
        probe, "digest string, bucket long, positive boolean")


def _best(doc_id: str, *ties: str) -> Column:
    """Least for the row that stays."""
    return F.struct((-F.col("n_chars")).alias("chars"), F.col(doc_id).isNull().alias("unknown"),
                    F.col(doc_id).alias("id"), *ties)


def build_snapshot(digests: DataFrame, folder: str) -> None:
    """Store distinct digests, with all their columns, by bucket, and a filter per bucket, below ``folder``."""
    importable(digests.sparkSession)
    buckets = max(1, -(-digests.count() // FILTER_KEYS))
    bucketed = _bucketed(digests, buckets).drop("key")
    bucketed.repartition("bucket").write.partitionBy("bucket").parquet(f"{folder}/digests")
    filters(digests.select("digest"), buckets).write.parquet(f"{folder}/filters")


def read_snapshot(spark, folder: str, schema) -> DataFrame:
    """The stored digests; ``schema`` is that of the table given to ``build_snapshot``."""
    return spark.read.schema(schema.add("bucket", "long") if "bucket" not in schema.names else schema).parquet(f"{folder}/digests")


def screen_batch(digests: DataFrame, folder: str, schema) -> DataFrame:
    """Distinct digests of a batch with ``known``: the snapshot's row of the digest, null where it is new.

    Buckets without a positive are not read; their numbers are a long per FILTER_KEYS digests.
    """
    spark = digests.sparkSession
    importable(spark)
    filter_table = spark.read.parquet(f"{folder}/filters")
    first = filter_table.select("buckets").first()
    screened = written(screen(digests, filter_table, first[0] if first else 1), "screened")
    hit = [r[0] for r in screened.where("positive").select("bucket").distinct().collect()]
    stored = read_snapshot(spark, folder, schema).where(F.col("bucket").isin(hit))
    # positives meet the exact digests; a false positive meets none and is new
    exact = screened.where("positive").select("digest").join(
        stored.select("digest", F.struct(*[c for c in stored.columns if c not in ("digest", "bucket")]).alias("known")), "digest")
    return digests.join(exact, "digest", "left")


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: ``digest``, ``rows`` and ``best``, from ``arrival`` (0 snapshot, 1 batch), digest, n_chars, doc_id."""
    sums = written(rows.groupBy("arrival", "digest").agg(
        F.count(F.lit(1)).alias("rows"), F.min(_best("doc_id")).alias("best")), "digests")
    snapshot, batch = (sums.where(F.col("arrival") == k).drop("arrival") for k in (0, 1))
    folder = work_dir(rows.sparkSession, "snapshot")
    build_snapshot(snapshot, folder)
    screened = written(screen_batch(batch, folder, snapshot.schema), "batch")
    met = screened.where("known is not null").select(
        "digest", (F.col("rows") + F.col("known.rows")).alias("rows"), F.least("best", "known.best").alias("best"))
    same = snapshot.join(met.select("digest"), "digest", "left_anti")
    return same.union(met).union(screened.where("known is null").drop("known"))


def _bit(digest: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(bits))


def may_repeat(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with ``may_repeat``: false only where the digest is not among ``repeated`` for certain.

    A bit is set for every repeated digest, sixteen bits for one of them up to MOST_BITS in all; the bitmap
    is at most 4096 rows of 4 kB, so it is sent to all executors.
    """
    bits = min(MOST_BITS, 1 << max(15, (16 * repeated.count()).bit_length()))
    place = _bit("digest", bits)
    bitmap = repeated.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
    at = F.bitmap_bit_position(place)
    octet = F.conv(F.hex(F.substring("bitmap", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(octet, (at % 8).cast("int")) == 1
    return rows.withColumn("part", F.bitmap_bucket_number(place)).join(F.broadcast(bitmap), "part", "left").withColumn(
        "may_repeat", F.coalesce(is_set, F.lit(False))).drop("part", "bitmap")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: bool = False,
          digest=lambda norm: F.sha2(norm, 256)) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256; with ``carry`` also ``doc``, the whole row.

    A quarter of the rows by a hash of the id stands for the incoming batch, the rest for the snapshot.
    """
    norm = normalised(text)
    told = [F.col(doc_id).alias("doc_id"), F.length(text_of(text)).alias("n_chars"), digest(norm).alias("digest"), F.sha2(norm, 256).alias("sha")]
    row = docs.select(*told, F.struct(*(docs.columns if carry else [text])).alias("doc"))
    arrival = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 3
    narrow = written(row.select("doc_id", "n_chars", "digest", "sha"), "rows")
    found = groups(narrow.select(arrival.cast("int").alias("arrival"), "digest", "n_chars", "doc_id"))
    repeated = written(found.where("rows > 1"), "repeated")

    alone = [F.col("doc_id").alias("keep_id"), F.lit(1).alias("group_size"), F.lit(True).alias("kept")]
    single = may_repeat(row if carry else narrow.withColumn("doc", F.lit(None)), repeated.select("digest")).where(
        ~F.col("may_repeat")).select("doc_id", "sha", *alone, "doc")

    # rows that may have a copy; those that were taken for one only have none
    best = (F.col("best.id").eqNullSafe(F.col("doc_id"))) & (F.col("best.chars") == -F.col("n_chars"))
    met = may_repeat(row, repeated.select("digest")).where("may_repeat").join(repeated, "digest", "left")
    met = written(met.select("doc_id", "n_chars", "digest", "sha", "rows", "best", best.alias("candidate"), "doc",
                             F.monotonically_increasing_id().alias("row")), "met")
    mistaken = met.where("rows is null").select("doc_id", "sha", *alone, "doc" if carry else F.lit(None).alias("doc"))

    # byte check: every row of a group against the text of the row that stays
    copies, mine = met.where("rows is not null"), normalised(F.col("doc")[text])
    # written, so that the join below has a plain exchange on either side and a hot group can be split
    heads = written(copies.where("candidate").groupBy("digest")
                    .agg(F.min(F.struct("row", mine.alias("text"))).alias("head")), "heads")
    compared = copies.join(heads, "digest").withColumn("same", mine == F.col("head.text"))
    needed = F.col("doc") if carry else F.when(~F.col("same"), F.col("doc"))
    checked = written(compared.select("doc_id", "n_chars", "digest", "sha", "row", "same", F.col("best.id").alias("keep_id"),
                                      (F.col("row") == F.col("head.row")).alias("kept"), needed.alias("doc")), "checked")
    equal = checked.where("same")
    sizes = written(equal.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size")), "sizes")
    equal = equal.join(sizes, "digest").select("doc_id", "sha", "keep_id", "group_size", "kept", "doc" if carry else F.lit(None).alias("doc"))

    # one digest, other bytes: groups by the bytes
    strays = checked.where(~F.col("same")).drop("keep_id", "kept").withColumn("text", mine)
    by_text = strays.groupBy("text").agg(F.count(F.lit(1)).alias("group_size"), F.min(_best("doc_id", "row")).alias("best"))
    strays = strays.join(by_text, "text").select("doc_id", "sha", F.col("best.id").alias("keep_id"), "group_size",
                                                 (F.col("row") == F.col("best.row")).alias("kept"), "doc" if carry else F.lit(None).alias("doc"))
    return single.unionByName(mistaken).unionByName(equal).unionByName(strays).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept",
        F.col("sha").alias("text_sha256"), *(["doc"] if carry else []))
