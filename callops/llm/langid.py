"""Language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes one blank, and the character 1- to 3-grams are
hashed to ``BUCKETS`` features. Counts per language give a matrix of log probabilities, which is
broadcast (languages x BUCKETS numbers). Texts are scored in numpy: the features of a slice of texts
become sparse (text, feature, count) triples that multiply the matrix.

The posterior compares learned languages with each other only and is near 1 for any longer text, also
in none of them. So the score is the posterior times how typical the text is of the language found: its
mean log probability per n-gram, against those of the documents learned from, each by the counts of the
others. A language learned from very few documents tells little more than its scripts apart.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text when
nothing could be learned; equal scores go to the language that is first in code point order; rows
repeated are predicted each; columns other than the named ones are not carried.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from callops.llm.common import batches_of, map_arrow, text_of, written

BUCKETS = 1 << 15
GRAMS = 3
#: The model is fitted on about this many labelled documents of each language, chosen by a hash of
#: the id; languages with fewer use all of theirs.
FIT_DOCS = 4_000
#: N-grams a text is taken to have besides its own, of the mean its language has: short texts tell little.
PRIOR_GRAMS = 50
#: The score halves where a mean is so many times as far below the language's median as that of the lowest
#: hundredth of its documents, and at least this far (in log probability per n-gram).
TIMES, LOW_SHARE, LEAST_WIDTH = 3.0, 0.01, 0.5
#: How steep the score falls around there.
STEEPNESS = 8.0
#: Characters handled at a time.
SLICE_CHARS = 200_000
UNKNOWN = "und"


class _Letters:
    """Code point → lower-case letter, or a blank; built once in a worker."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            table = np.full(0x110000, 32, np.uint32)
            for point in range(0x110000):
                if unicodedata.category(char := chr(point))[0] == "L":
                    table[point] = ord(low) if len(low := char.lower()) == 1 else point
            cls.table = table
        return cls.table


def _letters(text: str) -> np.ndarray:
    return _Letters.get()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _counted(chars: np.ndarray, owner: np.ndarray, seen: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text number) of every n-gram that does not end among the first ``seen`` characters."""
    chars = chars.astype(np.uint64)
    features, owners, code = [], [], np.zeros(len(chars), np.uint64)
    for n in range(1, GRAMS + 1):
        code = chars[:len(chars) - n + 1] + code[1:][:len(chars) - n + 1] * np.uint64(0x110000) if n > 1 else chars
        mixed = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        feature = (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
        first, last = owner[:len(code)], owner[n - 1:]
        inside = (first == last) & (chars[:len(code)] != 32 if n == 1 else True)
        inside[:max(seen - n + 1, 0)] = False
        features.append(feature[inside])
        owners.append(first[inside])
    return np.concatenate(features), np.concatenate(owners)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text number) of every n-gram; runs of blanks count once, one blank ends each text and none starts it."""
    chars = _letters("".join(t + " \x00 " for t in texts))  # NUL is no letter: it becomes a blank, and parts texts
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)) + 3)
    keep = (chars != 32) | (np.r_[32, chars[:-1]] != 32)
    return _counted(chars[keep], owner[keep])


def _grams_of_long(text: str):
    """The features of one text, slice by slice: a slice takes over the last characters of those before it."""
    held, last = np.zeros(0, np.uint64), 32
    for at in range(0, len(text), SLICE_CHARS):
        chars = _letters(text[at:at + SLICE_CHARS] + (" " if at + SLICE_CHARS >= len(text) else ""))
        chars = chars[(chars != 32) | (np.r_[last, chars[:-1]] != 32)]
        if len(chars):
            joined = np.r_[held, chars]
            yield _counted(joined, np.zeros(len(joined), np.int64), len(held))[0]
            held, last = joined[-(GRAMS - 1):], chars[-1]


def sparse_counts(texts: list[str]):
    """Sparse (text number, feature, count) triples, many texts at once or slices of one; cuts change no count."""
    for a, b in batches_of([len(t) for t in texts], SLICE_CHARS):
        if len(texts[a]) > SLICE_CHARS:
            for feature in _grams_of_long(texts[a]):
                counts = np.bincount(feature, minlength=BUCKETS)
                cells = np.flatnonzero(counts)
                yield np.full(len(cells), a), cells, counts[cells]
            continue
        feature, number = _grams(texts[a:b])
        n = b - a
        if n * BUCKETS <= 2 * len(feature):  # few long texts: count in place
            counts = np.bincount(number * BUCKETS + feature, minlength=n * BUCKETS)
            cells = np.flatnonzero(counts)
            yield a + cells // BUCKETS, cells % BUCKETS, counts[cells]
        else:
            cells, counts = np.unique(number * BUCKETS + feature, return_counts=True)
            yield a + cells // BUCKETS, cells % BUCKETS, counts


def _whole_counts(texts: list[str]):
    """The triples of ``sparse_counts`` with all counts of a text in one slice."""
    held = None
    for triple in sparse_counts(texts):
        if held is not None:
            number, feature, counts = (np.concatenate(pair) for pair in zip(held, triple))
            cells, where = np.unique(number * BUCKETS + feature, return_inverse=True)
            triple = cells // BUCKETS, cells % BUCKETS, np.bincount(where, counts, minlength=len(cells)).astype(np.int64)
        if not len(triple[0]):
            continue
        last = np.searchsorted(triple[0], triple[0][-1])
        if last:
            yield tuple(x[:last] for x in triple)
        held = tuple(x[last:] for x in triple)
    if held is not None:
        yield held


def _typical(drawn: DataFrame, names: list[str], sums: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Per language: the median of its documents' mean log probabilities, and the width at which the score halves.

    A document's own counts are taken off before it is measured; those that another language fits better
    do not count. The driver receives two numbers per document learned from.
    """
    shared = drawn.sparkSession.sparkContext.broadcast((np.ascontiguousarray(sums.T), sums.sum(axis=1), prior))
    place = {name: k for k, name in enumerate(names)}

    def run(batches):
        table, totals, before = shared.value
        for batch in batches:
            own = np.array([place[x] for x in batch.column(0).to_pylist()], int)
            log, grams, alone = np.zeros((batch.num_rows, len(names))) + before, np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for number, feature, counts in _whole_counts(batch.column(1).to_pylist()):
                edges = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
                at = number[edges]
                log[at] += np.add.reduceat(np.log(table[feature] / totals) * counts[:, None], edges)
                grams[at] = np.add.reduceat(counts, edges)
                rest = np.log((table[feature, own[number]] - counts) / (totals[own] - grams)[number])
                alone[at] = np.add.reduceat(rest * counts, edges)
            rows = np.arange(batch.num_rows)
            log[rows, own] = alone + before[own]
            fits = (grams > 0) & (log.argmax(axis=1) == own)
            yield pa.RecordBatch.from_arrays([pa.array(own[fits]), pa.array(alone[fits]), pa.array(grams[fits])], ["k", "log", "grams"])

    found = map_arrow(drawn, run, "k long, log double, grams double").toArrow()
    which, log, grams = (found[name].to_numpy() for name in ("k", "log", "grams"))
    floor = -np.log(BUCKETS)  # a text of n-grams in no language, all equally likely
    out = np.tile([floor, 0.0], (len(names), 1))
    for k in np.unique(which):
        one = which == k
        centre = max(floor, np.median(log[one] / grams[one]))
        below = np.quantile((grams[one] * centre - log[one]) / (grams[one] + PRIOR_GRAMS), 1 - LOW_SHARE)
        out[k] = centre, min(max(TIMES * below, LEAST_WIDTH), centre - floor)
    out[:, 1] = np.maximum(out[:, 1], 1e-3)
    return out


def _drawn(labelled: DataFrame, sizes: DataFrame, fit_docs: int) -> DataFrame:
    """About ``fit_docs`` documents of each language: those whose hash falls into its share of all hashes; equal rows once."""
    place = F.pmod(F.xxhash64("id", F.xxhash64("text")), F.lit(1 << 32))
    return labelled.join(sizes, "lang").where(place < F.lit(float(1 << 32)) * fit_docs / F.col("docs")
                                               ).select("lang", "id", "text").distinct().select("lang", "text")


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        fit_docs: int = FIT_DOCS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log probabilities, typical means): one row per language; of the log probabilities one
    column per feature, the prior last; of the typical means median and width.

    Counting runs in Spark; the driver receives a number per language and feature, and two per document learned from.
    """
    labelled = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), text_of(text).alias("text"), F.col(doc_id).alias("id"))
    sizes = written(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")), "languages")

    def count(batches):
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            which, names = langs.indices.to_numpy(), langs.dictionary
            for number, feature, counts in sparse_counts(batch.column(1).to_pylist()):
                cells, where = np.unique(which[number] * BUCKETS + feature, return_inverse=True)
                sums = np.bincount(where, counts, minlength=len(cells)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(cells // BUCKETS)), pa.array(cells % BUCKETS), pa.array(sums)], ["lang", "feature", "n"])

    drawn = written(_drawn(labelled, sizes, fit_docs), "learned")
    counted = map_arrow(drawn, count, "lang string, feature long, n long")
    found = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    docs_of = {r["lang"]: r["docs"] for r in sizes.collect()}
    names = sorted(docs_of, key=str.encode)
    if not names:
        return [], np.zeros((0, BUCKETS + 1)), np.zeros((0, 2))
    sums = np.full((len(names), BUCKETS), 0.5)
    row = np.searchsorted(np.array([n.encode() for n in names], object), np.array([x.encode() for x in found["lang"].to_pylist()], object))
    sums[row, found["feature"].to_numpy()] += found["n"].to_numpy()
    prior = np.array([docs_of[n] for n in names], float)
    prior = np.log(prior / prior.sum())
    return names, np.c_[np.log(sums / sums.sum(axis=1, keepdims=True)), prior], _typical(drawn, names, sums, prior)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep``, ``lang_pred`` and ``score``, the posterior probability of the prediction
    times how typical the text is of its language."""
    names, matrix, typical = model
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(matrix.T))  # (BUCKETS + 1) x languages

    def run(batches):
        weights = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            log = np.zeros((len(texts), len(names))) + weights[-1] if names else np.zeros((len(texts), 0))
            grams = np.zeros(len(texts))
            for number, feature, counts in sparse_counts(texts) if names else ():
                edges = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else np.zeros(0, int)
                if len(edges):
                    log[number[edges]] += np.add.reduceat(weights[feature] * counts[:, None], edges)
                    grams[number[edges]] += np.add.reduceat(counts, edges)
            best, score, label = np.zeros(len(texts), int), np.zeros(len(texts)), [UNKNOWN] * len(texts)
            if names:
                best = log.argmax(axis=1)
                posterior = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
                centre, width = typical[best].T
                above = (log.max(axis=1) - weights[-1][best] - grams * centre) / (grams + PRIOR_GRAMS)
                like = 1 / (1 + np.exp(np.clip(-STEEPNESS * (1 + above / width), -700, 700)))
                score = np.where(grams > 0, posterior * like, 0.0)
                label = [names[k] if n else UNKNOWN for k, n in zip(best, grams)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(label, pa.string()), pa.array(score, pa.float64())],
                                             [*keep, "lang_pred", "score"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_arrow(docs.select(*keep, text_of(text).alias("_text")), run, schema)


def held_out(doc_id: str) -> Column:
    """One document in five, by a hash of its id, is never learned from."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def report(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    model = fit(docs.where(~held_out("doc_id")), fit_docs=fit_docs)
    told = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return predict(told, model, ["doc_id", "held_out"])


def keep_identified(docs: DataFrame, least: float, fit_docs: int = FIT_DOCS) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is found with a score of ``least`` or more."""
    model = fit(docs.where(~held_out("doc_id")), fit_docs=fit_docs)
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.col("text").alias("text"))
    judged = predict(whole, model, ["doc"])
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("doc.*")
