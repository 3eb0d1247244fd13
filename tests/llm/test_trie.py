"""The prefix trie against a dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from callops.llm import trie
from llm_samples import FOLDER, table  # noqa: F401

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, family=20, most=4):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.sha256((text or "").encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0, role or "", digest), (role or "", text or "")))
    turns = {c: [t for _, t in sorted(x)] for c, x in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % most
        rebuilt[c] = turns.get(c - int(np.fmod(c, family)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, x in rebuilt.items():
        for d in range(len(x) + 1):
            members[tuple(x[:d])].append(c)
    name = {k: (min(m), len(k)) for k, m in members.items()}
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        amount = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += amount
            leaves[k[:d]] += not children[k]
    return sorted((*name[k], name[k[:-1]][0] if k else -1, len(m), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(k)))).encode()).hexdigest())
                  for k, m in members.items())


def found(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.collect())


def sample(seed, n, long=0):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 6) if not (long and c == 7) else long):
            rows.append((c * rng.choice([1, 1, 3]) if t else c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "a  b c.", "", None, "x\n\ty"])))
    return rows


@pytest.mark.parametrize("task_nodes", [16, 1024])
def test_as_a_dictionary(table, task_nodes):  # noqa: F811
    rows = sample(3, 60, long=60) + [(None, 1, "user", "a"), (5, None, "user", "b"), (5, None, "user", "b"), (40, 0, "user", "a"), (-5, 1, "user", "x")]
    assert found(trie.report(table(rows, SCHEMA), 20, 4, task_nodes)) == brute(rows)


def test_one_conversation_over_many_tasks_and_one_common_turn(spark, table):  # noqa: F811
    rows = [(0, t, "user", f"{t % 7}") for t in range(400)] + [(c, t, "user", "same" if t < 2 else f"{c} {t}") for c in range(1, 120) for t in range(3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(trie.report(table(rows, SCHEMA).repartition(7), 20, 4, 32)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty(table):  # noqa: F811
    assert found(trie.report(table([], SCHEMA), 20, 4)) == []


def test_given_table(spark):
    df = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    assert found(trie.report(df, 20, 4)) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_decomposition_of_any_forest():
    rng = np.random.default_rng(5)
    for n, shape in ((1, 0), (2000, 0), (3000, 1), (3000, 50), (500, 10 ** 6)):
        parent = np.array([-1 if i == 0 or (shape and rng.random() < 0.002) else
                           i - 1 if not shape else int(rng.integers(max(0, i - shape), i)) for i in range(n)])
        top = np.arange(n)
        for i in range(n):
            if parent[i] >= 0:
                top[i] = top[parent[i]]
        own, values = rng.integers(1, 9, n), rng.integers(-50, 50, (n, 2))
        weight, want = own.copy(), values.copy()
        for i in range(n - 1, 0, -1):
            if parent[i] >= 0:
                weight[parent[i]] += weight[i]
                want[parent[i]] += want[i]
        assert np.array_equal(trie._decompose(top, parent, own, weight, values), want)
