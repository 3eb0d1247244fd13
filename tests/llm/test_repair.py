"""Repair of conversations against a shortest-path search over whole edit strings."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from callops.llm import repair
from llm_samples import FOLDER, table  # noqa: F401

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def harmed(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def cheapest(rows):
    """Dijkstra over (cost, edit string): the first whole way out of the queue is the answer."""
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, names, i, shape, lines = heapq.heappop(queue)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", shape):
            return cost, names, lines
        if (i, shape[-1:]) in seen:
            continue
        seen.add((i, shape[-1:]))
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}[shape[-1:]]
        for r in ("user", "assistant"):
            if r[0] in legal:
                heapq.heappush(queue, (cost + 3, names + "I", i, shape + r[0], (*lines, (r, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(queue, (cost + 4, names + "D", i + 1, shape, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] and role[0] in legal:
                    heapq.heappush(queue, (cost + more, names + "K", i + 1, shape + role[0], (*lines, (role, text))))
                for r in ("user", "assistant"):
                    if r[0] in legal:
                        heapq.heappush(queue, (cost + 3 + more, names + "R", i + 1, shape + r[0], (*lines, (r, text))))


def brute(rows, damage=True):
    convs = defaultdict(list)
    for conv, turn, role, text in harmed(rows) if damage else rows:
        role, text = " " if role is None else role, " " if text is None else text
        convs[conv].append(((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest()), turn, role, text))
    out = []
    for conv in {r[0] for r in rows}:
        told, seen = [], set()
        given = sorted(convs[conv], key=lambda x: x[0])
        for _, _, role, text in given:
            solid = WORD.findall(text)
            told.append((role, text, "blank" if not solid else "duplicate" if (role, text) in seen else
                         "truncated" if solid[-1] not in ".!?" else None))
            seen.add((role, text))
        turns = [t for _, t, _, _ in given if t is not None]
        cost, names, lines = cheapest(told)
        unfit = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *(sum(f == kind for *_, f in told) for kind in ("blank", "duplicate", "truncated")), unfit, cost, names,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sample(seed, sizes):
    rng = random.Random(seed)
    return [(conv, rng.choice([t, t, t, t + 1, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "x", None]),
             rng.choice(["Yes.", "no", "What? \n", "", None, " \t", f"{t}!", f"{t} and"]))
            for conv, n in enumerate(sizes) for t in range(n)]


@pytest.mark.parametrize("block_rows, fan", [(1024, 4096), (2, 3)])
def test_as_a_shortest_path(table, block_rows, fan):  # noqa: F811
    rng = random.Random(1)
    rows = sample(2, [rng.randint(1, 9) for _ in range(70)] + [70, 45]) + [(None, 1, "user", "a."), (-3, None, None, None)]
    df = table(rows, SCHEMA).repartition(3)
    assert found(repair.report(df, repair.damage(df), block_rows, fan)) == brute(rows)


def test_elements_of_any_cut_agree():
    rng = random.Random(4)
    for _ in range(200):
        letters = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(1, 30)))
        rows = [repair._ROWS[c] for c in letters]
        cuts = sorted(rng.sample(range(1, len(rows)), min(3, len(rows) - 1)))
        parts = [repair.summed(rows[a:b]) for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        assert repair.finish(parts) == repair.finish(rows)
        assert repair.summed(parts)[0] == repair.summed(rows)[0]
        cost, end = repair.finish(rows)
        names, _ = repair.edits(letters, 0, end)
        told = [({"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}[c.lower()], "t",
                 "blank" if c == "x" else "truncated" if c.isupper() else None) for c in letters]
        assert (cost, "".join(names) + repair.TAIL[end]) == cheapest(told)[:2]


def test_empty(table):  # noqa: F811
    df = table([], SCHEMA)
    assert found(repair.report(df, repair.damage(df))) == []


def test_given_table_and_repaired_rows(spark):
    df = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    assert found(repair.report(df, repair.damage(df))) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    rows = repair.ordered(repair.damage(df))
    fixed = repair.repaired(rows, repair.solve(repair.blocks(repair.faults(rows), 1024)))
    shape = fixed.groupBy("conv_id").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: F.substring(x["role"], 1, 1))).alias("s"))
    assert shape.where(~F.col("s").rlike("^(s?(ua)+)?$")).count() == 0
