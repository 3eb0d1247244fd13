import base64
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from callops.llm import langid, mixing
from callops.llm.common import written
from llm_samples import FOLDER, ODD, table  # noqa: F401
from test_exact import WHITE
from test_simhash import expected as near


def test_registered():
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "language ID" and len(corpus_pipeline.STAGES) == 5
    names = __spark_entry__.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))


def check_stages(spark, docs):
    """Every stage against brute force over its own input."""
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    kept = written(stages["language ID"](spark, docs, FOLDER), "s1")
    judged = langid.report(docs).collect()
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (r.doc_id for r in judged if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE), key=repr)

    once = written(stages["exact dedup"](spark, kept, FOLDER), "s2")
    best = {}
    for r in kept.collect():
        norm = (r.text or "").translate(WHITE)
        best[norm] = min(best.get(norm, (1, True, 0)), (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    assert sorted((r.doc_id for r in once.collect()), key=repr) == sorted((b[2] if not b[1] else None for b in best.values()), key=repr)

    apart = written(stages["SimHash near-dedup"](spark, once, FOLDER), "s3")
    groups = near([(r.doc_id, r.text) for r in once.collect()])
    assert sorted((r.doc_id for r in apart.collect()), key=repr) == sorted({c for _, _, c in groups}, key=repr)

    mixed = written(stages["mixing sources"](spark, apart, FOLDER), "s4")
    taken = {r.doc_id: r.taken // r["size"] for r in mixing.report(apart, (3, 1, 2), 1.5, 2).collect() if r["size"]}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: n for k, n in taken.items() if n})
    assert kept.columns == once.columns == apart.columns == mixed.columns == columns

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in mixed.collect()}
    tokens = stages["BPE tokens"](spark, mixed, FOLDER).collect()
    assert len(tokens) == mixed.count()
    assert all(r.ids == encoding.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.decodes for r in tokens)


def test_stages_on_the_documents(spark):
    check_stages(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_stages_on_odd_rows(spark, table):  # noqa: F811
    text = [f"the {w} house and the {w} dog went to town number {k}" for k, w in enumerate(["old", "red", "big"] * 10)]
    rows = [(k, t, "en", "a" if k % 3 else None) for k, t in enumerate(text)]
    rows += [(100, text[0], None, "b"), (101, text[0] + " ", "en", "b"), (102, None, "en", None), (103, "", None, None), (104, ODD, "de", "c"),
             (104, ODD, "de", "c"), (105, "das Haus und der Hund " * 2000, "de", "c"), (106, "12 34", "en", "a")]
    check_stages(spark, table(rows, "doc_id long, text string, lang string, source string"))


def test_run_is_the_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), "step")
    one, two = (sorted((r.doc_id, r.n_tokens) for r in df.collect()) for df in (docs, corpus_pipeline.run(spark, FOLDER)))
    assert one == two


@pytest.mark.parametrize("stage", range(5))
def test_empty(spark, table, stage):  # noqa: F811
    empty = table([], "doc_id long, text string, lang string, source string")
    assert corpus_pipeline.STAGES[stage][1](spark, empty, FOLDER).collect() == []
