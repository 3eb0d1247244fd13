import base64
import hashlib
import random

import public_tokenizers
import regex
import tiktoken

from callops.llm import bpe
from callops.llm.queries import QUERIES, VOCABULARY
from llm_samples import FOLDER, ODD, table  # noqa: F401

PATH, PATTERN = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(text, encoding):
    text = text or ""
    ids = encoding.encode_ordinary(text)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_the_reference_tokenizer(spark):
    encoding = reference()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op1_bpe"](spark, FOLDER).collect()}
    assert found == {k: expected(t, encoding) for k, t in texts.items()}


def test_odd_rows(spark, table):
    random.seed(1)
    texts = [None, "", ODD, ODD, "a" * 5000, " " * 3000, "ab" * 400, "".join(random.choice("etaoin") for _ in range(1500)),
             "".join(chr(random.randrange(0x20, 0x3000)) for _ in range(4000)), "word " * 200_000]
    rows = [(k % 9 if k < 9 else None, t) for k, t in enumerate(texts)]
    encoding = reference()
    docs = table(rows, "doc_id long, text string")
    want = sorted(((k, *expected(t, encoding)) for k, t in rows), key=repr)
    tokens = bpe.encode(docs, PATH, PATTERN)
    apart = bpe.decode(tokens, PATH, ["doc_id", "ids"])
    for found in (bpe.round_trip(docs, PATH, PATTERN), apart):
        assert sorted((tuple(r) for r in bpe.digests(found, ["doc_id"]).collect()), key=repr) == want


def test_empty_table(spark, table):
    empty = table([], "doc_id long, text string")
    assert bpe.digests(bpe.round_trip(empty, PATH, PATTERN), ["doc_id"]).collect() == []
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(none, PATH, ["doc_id"]).collect()] == [b""]


def test_slices_and_cache_do_not_matter(monkeypatch):
    with open(PATH, "rb") as f:
        merger = bpe.Merger(f.read())
    encoding, texts = reference(), ["one two  three", "", "four five six seven " * 30, ODD]
    monkeypatch.setattr(bpe, "SLICE_WORDS", 3)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 2)
    found = bpe._encode_texts(texts, regex.compile(PATTERN), merger).to_pylist()
    assert found == [encoding.encode_ordinary(t) for t in texts]
