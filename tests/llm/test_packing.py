"""Packing against a piece-by-piece best-two-fit, tokens against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callops.llm import packing
from callops.llm.queries import op11_packing
from llm_samples import FOLDER, ODD, table  # noqa: F401

FILE = public_tokenizers.path("byte_bpe_50k.json")


def one_by_one(lengths, capacity):
    """Best-two-fit with single pieces: the fillings in order."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        held, gap = [], capacity
        for size in list(left):
            if size <= gap:
                held.append(size)
                left.remove(size)
                gap -= size
        smallest = held[-1]
        pairs = [(a + b, b) for i, b in enumerate(left) for a in left[i + 1:] if smallest < a + b <= gap + smallest] if gap else []
        if pairs:
            total, b = max(pairs)
            held[-1:] = [b, total - b]
            left.append(smallest)
            left.remove(b)
            left.remove(total - b)
            left.sort(reverse=True)
        out.append(sorted(held))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_two_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 40, 97])
    lengths = [min(capacity, int(rng.paretovariate(0.7)) if seed % 2 else rng.randint(1, capacity)) for _ in range(rng.randint(1, 250))]
    if seed % 3 == 0:
        lengths += [rng.randint(1, capacity)] * 90
    plan = []
    for filling, times in packing.best_two_fit(np.bincount(lengths, minlength=capacity + 1), capacity):
        plan += [sorted(Counter(filling).elements())] * times
    assert plan == one_by_one(lengths, capacity)


def slow():
    told = Tokenizer.from_file(FILE)
    told.encode_special_tokens = True
    return told


def test_ids_are_those_of_the_tokenizers_library():
    with open(FILE, encoding="utf-8") as f:
        encoder, told = packing.Encoder(f.read()), slow()
    assert encoder.fast is not None
    texts = ["", ODD, "a<|endoftext|>b", "x" * 3000, " " * 30_000 + "a", "a\x1c\x1d b\x85\xa0c", ("wörd, " * 90_000) + "\n \n" + "日本" * 500]
    marks = [chr(c) for c in [*range(0x3100), *range(0xF900, 0x10400), *range(0x1F000, 0x1FB00)] if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{c}1 {c}{c} ,{c}a\n{c} x  {c}'s" for c in marks[k:k + 100]) for k in range(0, len(marks), 100)]
    for text in texts:
        assert encoder.ids(text).tolist() == told.encode(text, add_special_tokens=False).ids


def test_slices_lose_nothing(monkeypatch):
    with open(FILE, encoding="utf-8") as f:
        encoder = packing.Encoder(f.read())
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "B.", " ", "  ", "\n", " ", "　 ", "'s", "12", "!\x1c"]) for _ in range(300)) for _ in range(100)]
    whole = [encoder.ids(t).tolist() for t in texts]
    monkeypatch.setattr(packing, "SLICE_CHARS", 7)
    assert [encoder.ids(t).tolist() for t in texts] == whole


def check(rows, texts, capacity=1024):
    told, want = slow(), Counter()
    for doc_id, text in texts:
        ids = [*told.encode(text or "", add_special_tokens=False).ids, 2]
        for k, a in enumerate(packing.piece_starts(len(ids), capacity)):
            b = min(a + capacity, len(ids)) if a or len(ids) % capacity == 0 or len(ids) < capacity else len(ids) % capacity
            want[doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter(tuple(r[:5]) for r in rows) == want
    placed = defaultdict(list)
    for r in rows:
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in placed.values():
        spans.sort()
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) <= capacity
    return len(placed)


def test_given_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = op11_packing(docs).collect()
    n = check(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert n == len(one_by_one([r["length"] for r in rows], 1024))


def test_odd_rows(table):  # noqa: F811
    texts = [(1, None), (2, ""), (3, ODD), (None, "a b"), (4, "same"), (4, "same"), (5, "long one " * 5000), (6, "x" * 40_000)]
    df = table(texts * 3, "doc_id long, text string").withColumn("sequence_id", F.lit("x")).withColumn("offset", F.lit(0))
    check(op11_packing(df.repartition(4)).collect(), texts * 3)
    assert op11_packing(table([], "doc_id long, text string")).count() == 0


def test_common_length_over_many_tasks_and_sequences(spark):
    df = spark.range(5000, numPartitions=9).select("id", F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") % 7 + 1).alias("length"), F.lit(1).alias("part"))
    rows = packing.pack(df, 300).select("length", "sequence_id", "offset").toPandas().sort_values(["sequence_id", "offset"])
    assert len(rows) == 5000 and (rows.groupby("sequence_id").length.cumsum() - rows.length == rows.offset).all()
    assert rows.sequence_id.nunique() == -(-rows.length.sum() // 300)
    pieces = packing.pieces(spark.createDataFrame([(k, "word " * (k * 40)) for k in range(20)], "doc_id long, text string"), FILE, 64, 2)
    packed = packing.pack(pieces, 64)
    joined = packing.sequences(packed).select(F.sum(F.length("ids")), F.max(F.length("ids"))).first()
    assert tuple(joined) == (packed.agg(F.sum(4 * F.col("length"))).first()[0], 256)
