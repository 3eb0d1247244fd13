import math
import re
from collections import Counter

import numpy as np

from callops.llm import quality
from callops.llm.queries import QUERIES
from llm_samples import FOLDER, ODD, table  # noqa: F401

SCHEMA = "doc_id long, text string"


def test_accuracy_on_labels_it_never_saw(spark):
    folder = FOLDER.replace("0.001", "0.01")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = {r.doc_id: r.kept for r in QUERIES["op9_quality"](spark, folder).collect()}
    good, bad = ([found[k] for k, q in truth.items() if q == x and k in found] for x in (1, 0))
    assert sum(good) / len(good) > 0.95
    assert sum(bad) / len(bad) < 0.25


def test_accuracies_are_recovered():
    random = np.random.default_rng(0)
    good = random.random(20_000) < 0.8
    right = np.array([[0.7, 0.99], [0.6, 0.97], [0.5, 0.995], [0.8, 0.98]])  # says bad of a bad one, good of a good one
    votes = ["".join(("+" if (random.random() < r[1] if g else random.random() >= r[0]) else "-") if random.random() < 0.9 else "0" for r in right)
             for g in good]
    patterns, counts = np.unique(votes, return_counts=True)
    accuracy, posterior = quality.fit_votes(patterns.tolist(), counts.tolist())
    assert np.abs(accuracy[:, 0, 0] - right[:, 0]).max() < 0.06 and np.abs(accuracy[:, 1, 1] - right[:, 1]).max() < 0.02
    assert np.mean([(posterior[v] > 0.5) == g for v, g in zip(votes, good)]) > 0.9


def test_odd_rows(table):  # noqa: F811
    random = np.random.default_rng(5)
    words = "it was quiet day in town people went about their work and nobody said much when rain came down over old stone bridges".split()

    def prose(lines):
        return "\n".join(" ".join(random.choice(words, 9)).capitalize() + "." for _ in range(lines))

    rows = [(k, prose(12)) for k in range(40)] + [(100 + k, f"{k}$$$ buy*** now### " * 60) for k in range(8)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, ODD), (203, ODD), (None, prose(12)), (204, prose(4000)), (205, "\x00"), (206, "İİ")]
    found = quality.classify(table(rows, SCHEMA)).collect()
    told = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert all(told[k].score == 0 and not told[k].kept for k in (200, 201, 202))
    assert all(told[k].kept for k in (*range(40), None, 204)) and not any(told[100 + k].kept for k in range(8))


def test_empty(table):  # noqa: F811
    assert quality.classify(table([], SCHEMA)).collect() == []


def plain_features(text):
    """Feature → value of a text, trigram by trigram."""
    low = re.sub("[0-9]", "0", text.lower())
    marks = [(sum(ord(c) * 0x110000 ** i for i, c in enumerate(low[k:k + 3])) + 1) * 0x9E3779B97F4A7C15 % 2 ** 64
             >> 64 - quality.FEATURES.bit_length() + 1 for k in range(len(low) - 2)]
    counts = Counter((f * 7 + 3) % quality.FEATURES if k + 6 < len(marks) and marks[k + 6] == f else f for k, f in enumerate(marks))
    norm = math.sqrt(sum(counts.values()))
    return {f: math.sqrt(n) / norm for f, n in counts.items()}


def test_cut_features_are_those_of_the_whole(monkeypatch):
    texts = ["Σ abc123 abc456 ΑΣ İ " * 30, "", "ab", "x" * 101, "abcabcabc" * 40, "short one", ODD]
    for size in (37, 100, 500_000):
        monkeypatch.setattr(quality, "SLICE_CHARS", size)
        found = [{} for _ in texts]
        for k, f, v in zip(*quality._sparse(texts)):
            found[k][int(f)] = v
        for got, text in zip(found, texts):
            want = plain_features(text)
            assert got.keys() == want.keys() and all(abs(got[f] - want[f]) < 1e-12 for f in want)


def test_posteriors_by_brute_force():
    patterns, counts = ["++0", "+-+", "---", "0++", "000", "-+-"], [50, 7, 9, 30, 2, 4]
    good = [0.05 if "-" in p else 0.95 for p in patterns]
    for _ in range(quality.ROUNDS):
        right = {}
        for h in range(3):
            for c in (0, 1):
                mass = [0.5 + sum(n * (g if c else 1 - g) for p, n, g in zip(patterns, counts, good) if p[h] == v) for v in "-+"]
                right[h, c] = {"-": mass[0] / sum(mass), "+": mass[1] / sum(mass), "0": 1.0}
        share = (sum(n * g for n, g in zip(counts, good)) + 1) / (sum(counts) + 2)
        new = []
        for p in patterns:
            bad, fine = ((1 - share) * math.prod(right[h, 0][p[h]] for h in range(3)), share * math.prod(right[h, 1][p[h]] for h in range(3)))
            new.append(fine / (bad + fine))
        moved, good = max(abs(a - b) for a, b in zip(new, good)), new
        if moved < 1e-9:
            break
    _, found = quality.fit_votes(patterns, counts)
    assert all(abs(found[p] - g) < 1e-7 for p, g in zip(patterns, good))


def test_scores_by_brute_force(table):  # noqa: F811
    weights = np.random.default_rng(1).normal(size=quality.FEATURES + 1)
    texts = ["it was a quiet day", "buy now!!! buy now!!!", ODD, "", " \n", None, "a"]
    rows = list(enumerate(texts))
    for r in quality.score(table(rows, SCHEMA), weights, ["doc_id"]).collect():
        text = texts[r.doc_id] or ""
        log = weights[-1] + sum(weights[f] * v for f, v in plain_features(text).items())
        assert abs(r.score - (1 / (1 + math.exp(-log)) if text.strip() else 0)) < 1e-9


def test_scorer_follows_the_slope():
    """One step of the scorer against its formula, document by document."""
    docs, labels = [{1: 0.6, 5: 0.8}, {5: 1.0}, {}], [0.9, 0.2, 0.7]
    sizes = np.array([len(d) for d in docs])
    feature, value = (np.array([x for d in docs for x in part(d)]) for part in (dict.keys, dict.values))
    weights, constant, total = [0.0] * quality.FEATURES, 0.0, [0.0] * quality.FEATURES
    good, bad = max(sum(labels), 1), max(sum(1 - x for x in labels), 1)
    for _ in range(quality.STEPS):
        errors = []
        for d, x in zip(docs, labels):
            p = 1 / (1 + math.exp(-constant - sum(weights[f] * v for f, v in d.items())))
            errors.append(x / (2 * good) * (1 - p) - (1 - x) / (2 * bad) * p)
        for f in (1, 5):
            slope = sum(e * d.get(f, 0) for e, d in zip(errors, docs)) - quality.RIDGE * weights[f]
            total[f] += slope * slope
            weights[f] += quality.STEP * slope / (math.sqrt(total[f]) + 1e-6)
        constant += 10 * quality.STEP * sum(errors)
    found = quality.fit_scorer(sizes, feature, value, np.array(labels))
    assert np.allclose(found[[1, 5, -1]], [weights[1], weights[5], constant]) and np.count_nonzero(found) == 3
