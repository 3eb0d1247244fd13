import random
import re
from collections import defaultdict

import xxhash

from callops.llm import simhash
from callops.llm.queries import QUERIES
from llm_samples import FOLDER, ODD, table  # noqa: F401


def fingerprint(text, shingle=4):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    n = min(shingle, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def expected(rows, bits=4):
    prints = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for (k, _), p in zip(rows, prints):
        least[find(p)].append(k)
    least = {p: min((k for k in ks if k is not None), default=None) for p, ks in least.items()}
    return sorted(((k, f"{p:016x}", least[find(p)]) for (k, _), p in zip(rows, prints)), key=repr)


def near_copies(n, words=400):
    random.seed(2)
    base = [f"w{random.randrange(5000)}" for _ in range(words)]
    for k in range(n):
        text = list(base)
        for _ in range(k % 4):
            text[random.randrange(words)] = f"v{random.randrange(5000)}"
        yield 5000 + k, " ".join(text)


def cases():
    return [(1, None), (2, ""), (3, " \n"), (4, "A B c"), (5, "a b C"), (6, ODD), (6, ODD), (None, ODD), (None, "lonely words here now ok"),
            (7, "long " * 50_000), *near_copies(300)]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op8_simhash"](spark, FOLDER).collect()), key=repr) == expected(rows)


def test_odd_rows_and_a_large_group(table):
    for segments, cell_rows in ((4, 4096), (3, 4096), (2, 4096), (5, 8), (4, 8)):
        found = simhash.report(table(cases(), "doc_id long, text string"), 4, 4, segments=segments, cell_rows=cell_rows)
        assert sorted(map(tuple, found.collect()), key=repr) == expected(cases())


def test_links_of_random_fingerprints(spark):
    random.seed(5)
    prints = [random.getrandbits(64) for _ in range(40)]
    prints = list({p ^ sum(1 << b for b in random.sample(range(64), n)) for p in prints for n in (0, 1, 2, 3, 4, 5, 5) for _ in range(2)})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.components(simhash.links(spark.createDataFrame(signed, "fp long"), 4))
    joined = {r[0] % (1 << 64): r[1] % (1 << 64) for r in found.collect()}
    least = {}
    for a in prints:
        reach, todo = {a}, [a]
        while todo:
            x = todo.pop()
            for y in prints:
                if y not in reach and (x ^ y).bit_count() <= 4:
                    reach.add(y)
                    todo.append(y)
        least[a] = min(reach, key=lambda p: p - (1 << 64) if p >> 63 else p)
    assert {p: joined.get(p, p) for p in prints} == least


def test_parts_of_a_text_count_as_the_whole(monkeypatch):
    texts = ["a", " a b", "one two three four five\n" * 40, ODD * 30, "x" * 100, " \t\r\n" * 9]
    whole = [simhash.fingerprint(t, 4) for t in texts]
    assert whole == [fingerprint(t) for t in texts]
    for size in (1, 3, 50):
        monkeypatch.setattr(simhash, "PART_BYTES", size)
        assert [simhash.fingerprint(t, 4) for t in texts] == whole


def test_one_of_each_group_survives(table):
    docs = table(cases(), "doc_id long, text string")
    kept = simhash.survivors(docs, 4, 4)
    assert kept.columns == docs.columns
    components = {c for _, _, c in expected(cases())}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(components, key=repr)


def test_empty(table):
    empty = table([], "doc_id long, text string")
    assert simhash.report(empty, 4, 4).collect() == []
    assert simhash.survivors(empty, 4, 4).collect() == []
