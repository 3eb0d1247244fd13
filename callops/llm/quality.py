"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or abstain on every document. Expectation-maximisation over the
counts of all vote patterns estimates how often each heuristic is right on good and on bad documents,
and the share of good ones; it also gives each pattern its posterior. A linear scorer over hashed
features is trained on the posteriors and scores every whole text, also where the heuristics abstain.

The patterns number 3 to the power of the heuristics at most, so their counts, taken over all
documents, fit on the driver at any size. The scorer is fitted on a bounded sample, ``FIT_DOCS``.

Defined results: a null or empty text gets score 0 and goes; rows repeated are scored each; where
there is nothing to learn from (no documents) the result is empty; columns other than the named ones
are not carried.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from callops.llm.common import batches_of, map_arrow, text_of

GOOD, BAD, ABSTAIN = "+", "-", "0"
#: The scorer is fitted on about this many documents, chosen by a hash of id and text.
FIT_DOCS = 4_000
FEATURES = 1 << 14
ROUNDS, STEPS, STEP, RIDGE = 200, 150, 0.4, 1e-4
SLICE_CHARS = 500_000
AHEAD = 8
LEAST_SCORE = 0.4
_PLAIN = re.compile(r"[\w\s.,;:!?'\"()-]")
_SENTENCE = re.compile(r"[.!?…]")


def _three_way(value: float, good: float, bad: float) -> str:
    """Good up to ``good``, bad from ``bad`` on (the other way round if bad is smaller)."""
    if good <= bad:
        return GOOD if value <= good else BAD if value >= bad else ABSTAIN
    return GOOD if value >= good else BAD if value <= bad else ABSTAIN


def votes(text: str) -> str:
    """A character per heuristic; all see the whole text.

    In order: symbols among the characters; words that carry symbols; words equal to the word before;
    the commonest word; words per end of a sentence; word length; repeated lines; length; upper-case words.
    """
    words = text.split()
    n = len(words)
    if not n:
        return BAD * 9
    symbols = len(_PLAIN.sub("", text))
    marked = sum(1 for w in words if not w.strip(".,;:!?'\"()-").isalnum())
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    loud = sum(1 for w in words if len(w) > 2 and w.isupper())
    again = sum(map(str.__eq__, words, words[1:] + [""]))
    ends = len(_SENTENCE.findall(text))
    lines = [line for line in text.split("\n") if line.strip()]
    return "".join((
        _three_way(symbols / len(text), 0.01, 0.05),
        _three_way(marked / n, 0.05, 0.3),
        _three_way(again / n, 0.02, 0.25),
        _three_way(max(counts.values()) / n, 0.12, 0.3) if n >= 30 else ABSTAIN,
        ABSTAIN if n < 40 else GOOD if 2 <= n / max(ends, 1) <= 40 else BAD,
        GOOD if 2.5 <= sum(map(len, words)) / n <= 10 else BAD,
        ABSTAIN if len(lines) < 4 else _three_way(1 - len(set(lines)) / len(lines), 0.1, 0.5),
        BAD if n < 3 else GOOD if n >= 20 else ABSTAIN,
        _three_way(loud / n, 0.05, 0.25),
    ))


def fit_votes(patterns: list[str], counts: list[int], rounds: int = ROUNDS) -> tuple[np.ndarray, dict[str, float]]:
    """(accuracies: [heuristic, class bad/good, vote bad/good]; pattern → posterior of good).

    Heuristics are taken as independent given the class; to abstain says nothing. Bad documents are
    bad in one way or another, so it starts from: bad is what any heuristic calls bad.
    """
    codes = np.array([[(BAD, GOOD, ABSTAIN).index(c) for c in p] for p in patterns])
    weight = np.array(counts, float)
    one_hot = np.eye(3)[codes][:, :, :2]
    good = np.where(one_hot[:, :, 0].any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        mass = np.stack([weight * (1 - good), weight * good])
        accuracy = np.einsum("cp,phv->hcv", mass, one_hot) + 0.5
        accuracy /= accuracy.sum(axis=2, keepdims=True)
        share = (mass.sum(axis=1) + 1) / (weight.sum() + 2)
        log = np.log(share) + np.einsum("phv,hcv->pc", one_hot, np.log(accuracy))
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
        moved, good = np.abs(new - good).max(), new
        if moved < 1e-9:
            break
    return accuracy, dict(zip(patterns, good.tolist()))


def _sparse(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature, value) of hashed character trigrams and equal neighbours; values have length 1 per text."""
    pieces, owner = [], []
    for k, text in enumerate(map(str.lower, texts)):  # very long texts in pieces, each with what its last trigrams look ahead to
        for at in range(0, len(text), SLICE_CHARS):
            pieces.append(text[at:at + SLICE_CHARS + AHEAD])
            owner.append(k)
    owner, cells, sums = np.array(owner, np.int64), [np.zeros(0, np.int64)], [np.zeros(0)]
    for a, b in batches_of([len(p) for p in pieces], SLICE_CHARS):
        joined = "\x00\x00\x00".join(pieces[a:b])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.array([len(p) for p in pieces[a:b]])
        number = np.repeat(np.arange(b - a), lengths + 3)[:len(points)]
        place = np.arange(len(points)) - (np.cumsum(lengths + 3) - lengths - 3)[number]
        number[place >= lengths[number]] = -1  # what parts the pieces
        points[np.isin(points, np.arange(48, 58))] = 48
        if len(points) < 3:
            continue
        code = points[:-2] + points[1:-1] * np.uint64(0x110000) + points[2:] * np.uint64(0x110000 ** 2 % (1 << 64))
        code = (code + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        feature = (code >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)
        inside = (number[:-2] == number[2:]) & (number[:-2] >= 0) & (place[:-2] < SLICE_CHARS)
        # a trigram that comes again six characters later: a mark of repetition
        again = np.zeros(len(feature), bool)
        again[:-6] = (feature[:-6] == feature[6:]) & (number[:-8] == number[8:])
        feature = np.where(again, (feature * 7 + 3) % FEATURES, feature)
        cell, count = np.unique(owner[a + number[:-2][inside]] * FEATURES + feature[inside], return_counts=True)
        cells.append(cell)
        sums.append(count)
    cell, where = np.unique(np.concatenate(cells), return_inverse=True)
    value = np.sqrt(np.bincount(where, np.concatenate(sums), minlength=len(cell)))
    number, feature = cell // FEATURES, cell % FEATURES
    norm = np.sqrt(np.bincount(number, value * value, minlength=len(texts)))
    return number, feature, value / norm[number] if len(cell) else value


def fit_scorer(sizes: np.ndarray, feature: np.ndarray, value: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights (the last is the constant) of a logistic scorer for soft labels, classes weighed alike.

    ``sizes`` are the numbers of features per document, whose features and values follow each other.
    """
    row = np.repeat(np.arange(len(sizes)), sizes)
    weights, constant = np.zeros(FEATURES), 0.0
    good, bad = max(labels.sum(), 1.0), max((1 - labels).sum(), 1.0)
    for_good, for_bad = labels / (2 * good), (1 - labels) / (2 * bad)
    total = np.zeros(FEATURES)
    for _ in range(STEPS):
        log = constant + np.bincount(row, weights[feature] * value, minlength=len(sizes))
        p = 1 / (1 + np.exp(-np.clip(log, -60, 60)))
        error = for_good * (1 - p) - for_bad * p
        slope = np.bincount(feature, error[row] * value, minlength=FEATURES) - RIDGE * weights
        total += slope * slope  # steps by the slopes so far
        weights += STEP * slope / (np.sqrt(total) + 1e-6)
        constant += 10 * STEP * error.sum()
    return np.r_[weights, constant]


def label(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``votes``."""

    def run(batches):
        for batch in batches:
            found = [votes(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())], [*keep, "votes"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("votes", T.StringType())])
    return map_arrow(docs.select(*keep, text_of(text).alias("_text")), run, schema)


def _features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` with the sparse features of ``text``: two arrays."""

    def run(batches):
        for batch in batches:
            number, feature, value = _sparse(batch.column(batch.num_columns - 1).to_pylist())
            offsets = pa.array(np.searchsorted(number, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(feature.astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(value))], [*keep, "features", "amounts"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("features", T.ArrayType(T.IntegerType())),
                           T.StructField("amounts", T.ArrayType(T.DoubleType()))])
    return map_arrow(docs.select(*keep, "text"), run, schema)


def score(docs: DataFrame, weights: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``score`` (0 to 1; 0 for texts without a word)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # FEATURES + 1 numbers

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = np.zeros(len(texts))
            for a, b in batches_of([len(t) for t in texts], 4 * SLICE_CHARS):
                number, feature, value = _sparse(texts[a:b])
                log = shared.value[-1] + np.bincount(number, shared.value[feature] * value, minlength=b - a)
                found[a:b] = 1 / (1 + np.exp(-np.clip(log, -60, 60)))
            found[[not t.strip() for t in texts]] = 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())], [*keep, "score"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("score", T.DoubleType())])
    return map_arrow(docs.select(*keep, text_of(text).alias("_text")), run, schema)


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fit_docs: int = FIT_DOCS,
             least: float = LEAST_SCORE) -> DataFrame:
    """Per row: doc_id, score, kept."""
    given = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    patterns = label(given, ["doc_id"]).groupBy("votes").count().collect()  # 3 ** 9 at most
    if not patterns:
        return given.select("doc_id", F.lit(0.0).alias("score"), F.lit(False).alias("kept"))
    _, posterior = fit_votes([r["votes"] for r in patterns], [r["count"] for r in patterns])

    share = min(1.0, fit_docs / sum(r["count"] for r in patterns))
    seal = F.xxhash64("doc_id", "text")
    drawn = given.select(seal.alias("seal"), "text").where(F.pmod(F.col("seal"), F.lit(1 << 32)) < F.lit(share * (1 << 32))).distinct()
    fit = _features(label(drawn, ["seal", "text"]), ["seal", "votes"]).toArrow().sort_by([("seal", "ascending"), ("votes", "ascending")])
    features, amounts = (fit[name].combine_chunks() for name in ("features", "amounts"))
    weights = fit_scorer(np.diff(features.offsets.to_numpy()), features.flatten().to_numpy(), amounts.flatten().to_numpy(),
                         np.array([posterior[v] for v in fit["votes"].to_pylist()], float))
    return score(given, weights, ["doc_id"]).withColumn("kept", F.col("score") >= least)
