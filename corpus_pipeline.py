"""From raw documents to token ids: language, exact copies, near copies, mix, tokens.

Every stage works on all rows that the one before it kept; its result is written as Parquet in the
shared folder and read again, so a lost executor never costs more than a stage.

Defined results, in every stage: an empty table gives an empty table with the stage's columns; columns
other than doc_id, text, lang and source are carried as they are, whatever their names; null doc_id,
lang and source are kept. Each stage says what it does with null and empty texts and with repeated rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from callops.llm import bpe, exact, langid, mixing, simhash
from callops.llm.common import written
from callops.llm.queries import MIX_REPEATS, MIX_SHARE, MIX_WEIGHTS, SIMHASH_BITS, SIMHASH_WORDS, VOCABULARY

#: A document goes if no language is found with this probability.
LEAST_SCORE = 0.5


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; ``und`` and undecided ones go, so null and empty texts do. Repeated rows stay."""
    return langid.keep_identified(docs, LEAST_SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space: that with the most characters,
    then the smallest doc_id. Null and empty texts are one group; of rows repeated whole one stays."""
    return exact.dedup(docs, carry=True).where("kept").select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints. Texts without words have the fingerprint zero and link."""
    return simhash.survivors(docs, SIMHASH_WORDS, SIMHASH_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those without words go. Repeated rows count one by one."""
    return mixing.mix(docs, MIX_WEIGHTS, MIX_SHARE, MIX_REPEATS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, ids, n_tokens, and whether the ids decode to the text. Null and empty texts have no ids;
    repeated rows are encoded each."""
    keep = ["doc_id", "source", "lang", "sha"]
    told = docs.select("doc_id", "source", "lang", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    tokens = bpe.round_trip(told, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep)
    return tokens.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids",
                         (F.sha2("decoded", 256) == F.col("sha")).alias("decodes"))


STAGES = [
    ("language ID", identify),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE tokens", tokenize),
]

#: Language model, Hamming links and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
