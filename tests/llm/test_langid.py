import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from callops.llm import langid
from callops.llm.queries import QUERIES
from llm_samples import FOLDER, ODD, table  # noqa: F401


def test_held_out_accuracy(spark):
    folder = FOLDER.replace("0.001", "0.01")
    truth = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op5_language_id"](spark, folder).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r.lang_pred == truth[r.doc_id].lang for r in found if r.held_out and truth[r.doc_id].lang]
    assert sum(held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_only_text_and_labels_of_others_are_learned(table):  # noqa: F811
    rows = [(k, t * 3, x) for k in range(60) for t, x in (("the house and the dog ", "en"), ("das Haus und der Hund ", "de"))]
    docs = table(rows, "doc_id long, text string, lang string")
    lied = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 'xx' ELSE lang END AS lang")
    one, two = (sorted(map(tuple, langid.report(d).collect())) for d in (docs, lied))
    assert one == two
    assert {r[2] for r in one} == {"en", "de"}


def test_odd_rows(table):  # noqa: F811
    rows = [(k, "the house and the dog ", "en") for k in range(20)] + [(20 + k, "das Haus und der Hund ", "de") for k in range(20)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "123 !!! \x00", None), (103, ODD, None), (103, ODD, None), (None, "der Hund", None),
             (104, "the dog and " * 100_000, None), (105, "x", None), (106, "\x00\x00das Haus", None)]
    found = langid.report(table(rows, "doc_id long, text string, lang string")).collect()
    told = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert len(found) == len(rows)
    assert told[100] == told[101] == told[102] == ("und", 0.0)
    assert told[104][0] == "en" and told[None][0] == "de" and told[106][0] == "de"


def plain_grams(text):
    """Feature counts of a text, gram by gram."""
    letters = re.sub(r"\s+", " ", "".join(c.lower() if c.isalpha() else " " for c in text)).strip()
    found = Counter()
    for n in range(1, langid.GRAMS + 1):
        for k in range(len(letters + " ") - n + 1 if letters else 0):
            gram = (letters + " ")[k:k + n]
            if gram != " ":
                code = sum(ord(c) * 0x110000 ** i for i, c in enumerate(gram))
                found[(code + n) * 0x9E3779B97F4A7C15 % 2 ** 64 >> 64 - langid.BUCKETS.bit_length() + 1] += 1
    return found


def test_cuts_and_neighbours_change_no_count(monkeypatch):
    texts = ["The quick brown fox, the lazy dog; " * 50, "  two", "", "12", "a" + " " * 450 + "b " * 130, " " * 700, "x" * 100, "y" * 101 + " ", "end"]
    for size in (100, 101, 200_000):
        monkeypatch.setattr(langid, "SLICE_CHARS", size)
        for order in (texts, texts[::-1]):
            total = {k: Counter() for k in range(len(order))}
            for number, feature, count in langid.sparse_counts(order):
                for n, f, c in zip(number.tolist(), feature.tolist(), count.tolist()):
                    total[n][f] += c
            assert [total[k] for k in range(len(order))] == [plain_grams(t) for t in order]


def test_scores_by_brute_force(table):  # noqa: F811
    samples = {"en": ["the house and the dog", "a dog in the old town", "the town"], "de": ["das Haus und der Hund", "ein Hund in der alten Stadt"]}
    rows = [(k, " ".join([t] * (1 + k % 3)), x) for k, (x, t) in enumerate((x, t) for _ in range(6) for x, ts in samples.items() for t in ts)]
    rows += [(900, "der Hund and the dog", None), (901, "", "en")]
    found = {r.doc_id: r for r in langid.report(table(rows, "doc_id long, text string, lang string")).collect()}

    learned = [(plain_grams(t), x) for k, t, x in rows if x and zlib.crc32(str(k).encode()) % 5]
    names = sorted({x for _, x in learned})
    prior = {x: math.log(sum(y == x for _, y in learned) / len(learned)) for x in names}
    sums = {x: Counter() for x in names}
    for grams, x in learned:
        sums[x].update(grams)
    total = {x: sum(sums[x].values()) + 0.5 * langid.BUCKETS for x in names}

    def log(grams, x, less=Counter()):
        return sum(n * math.log((sums[x][f] + 0.5 - less[f]) / (total[x] - sum(less.values()))) for f, n in grams.items())

    floor, typical = -math.log(langid.BUCKETS), {}
    for x in names:
        own = []
        for grams, y in learned:
            alone = log(grams, x, grams) if y == x else 0
            if y == x and grams and all(alone + prior[x] >= log(grams, z) + prior[z] for z in names if z != x):
                own.append((alone, sum(grams.values())))
        centre = max(floor, np.median([a / n for a, n in own]))
        below = np.quantile([(n * centre - a) / (n + langid.PRIOR_GRAMS) for a, n in own], 1 - langid.LOW_SHARE)
        typical[x] = centre, max(min(max(langid.TIMES * below, langid.LEAST_WIDTH), centre - floor), 1e-3)

    for k, text, _ in rows:
        grams = plain_grams(text)
        if not grams:
            assert (found[k].lang_pred, found[k].score) == ("und", 0.0)
            continue
        logs = {x: log(grams, x) + prior[x] for x in names}
        best = max(names, key=logs.get)
        posterior = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
        n, (centre, width) = sum(grams.values()), typical[best]
        above = (logs[best] - prior[best] - n * centre) / (n + langid.PRIOR_GRAMS)
        assert found[k].lang_pred == best
        assert abs(found[k].score - posterior / (1 + math.exp(-langid.STEEPNESS * (1 + above / width)))) < 1e-9


def test_nothing_to_learn(table):  # noqa: F811
    assert langid.report(table([], "doc_id long, text string, lang string")).collect() == []
    silent = table([(1, "text", None), (2, None, None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.report(silent).collect()] == [("und", 0.0)] * 2


def test_rejected_documents_go_and_columns_stay(table):  # noqa: F811
    rows = [(k, "the house and the dog ", "en") for k in range(20)] + [(50, None, "en"), (51, "12", "en")]
    docs = table(rows, "doc_id long, text string, lang string")
    kept = langid.keep_identified(docs, 0.5)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(20))


def test_texts_in_no_learned_language_are_rejected(spark):
    learned = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    random.seed(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    strange = ["Все люди рождаются свободными и равными в своем достоинстве и правах.", "Привет, мир",
               "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
               "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten",
               "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza",
               "".join(random.choice(letters) for _ in range(50)),
               " ".join("".join(random.choice(letters) for _ in range(6)) for _ in range(20_000))]
    docs = learned.union(spark.createDataFrame([(-1 - k, t, None) for k, t in enumerate(strange)], learned.schema))
    kept = {r.doc_id for r in langid.keep_identified(docs, 0.5).collect()}
    assert not {k for k in kept if k < 0}
    assert len(kept) > 0.99 * learned.count()


def test_strangers_of_a_language_with_one_document(table):  # noqa: F811
    rows = [(k, "the house and the dog " * 5, "en") for k in range(20)] + [(30, "das Haus und der Hund " * 5, "de")]
    assert zlib.crc32(b"30") % 5  # learned from
    rows += [(200, "Все люди рождаются свободными и равными в своем достоинстве и правах.", None), (201, "der Hund und das Haus", None)]
    kept = {r.doc_id for r in langid.keep_identified(table(rows, "doc_id long, text string, lang string"), 0.5).collect()}
    assert 200 not in kept and {30, 201} <= kept


def test_counts_of_a_text_stay_together(monkeypatch):
    monkeypatch.setattr(langid, "SLICE_CHARS", 100)
    texts = ["short one", "The quick brown fox, the lazy dog; " * 50, "", "12", "another", "more and more " * 30]
    seen, total = [], 0
    for number, feature, counts in langid._whole_counts(texts):
        cells = number * langid.BUCKETS + feature
        assert len(np.unique(cells)) == len(cells)
        seen += np.unique(number).tolist()
        total += counts.sum()
    assert seen == sorted(set(seen)) == [0, 1, 4, 5]
    assert total == sum(c.sum() for _, _, c in langid.sparse_counts(texts))
