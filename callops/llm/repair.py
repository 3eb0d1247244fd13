"""Cheapest repair of damaged conversations by Hirschberg's divide and conquer.

A conversation is brought into the form (system? (user assistant)+)? with edits of its rows: keep (0),
give the role user or assistant (3), delete (4; a must for blank and repeated rows), insert an empty
row of user or assistant (3); a row with a truncated text costs 3 more unless it is deleted. Four
states tell where in the form a prefix ends: nothing yet, after system, after user, after assistant.
From a state only one of user and assistant can follow, so the initials of the edits determine them.

The edits that consume a row are inserts and then one letter, so no two edit strings of a prefix are
prefixes of each other, and strings can be compared through ranks: a forward vector holds the least
cost to each of the four states and the order of the least strings that get there. A backward vector
holds the least cost from each state to the end. They meet in the middle; of the states with the least
sum the one with the least string is crossed, and both halves are solved in the same way.

Rows get their order from a global sort, and every ``BLOCK_ROWS`` places of it that belong to one
conversation are a block, an array of one letter per row. Blocks are summed up as 4 x 4 costs and
ranks, the conversation is solved over its blocks (over groups of blocks first, where they are more
than ``FAN``), then each block between its two states. So a conversation may fill many tasks.

Defined results: null roles and texts are one space; rows without ``conv_id`` form one conversation
without id; rows that share a turn (or have none: first) are ordered by role, then by text's digest,
so repeated rows are neighbours; a role without first letter cannot be kept; an empty table gives no
rows; only the four named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from callops.llm.common import WHITE, map_arrow, written

#: Rows of one conversation that one array may hold, and blocks of one conversation.
BLOCK_ROWS, FAN = 1024, 4096
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INF = 1 << 40

START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)  # the state after the one role that may be inserted or given
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_FITS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Inserts that end a conversation from a state.
TAIL = ("", "II", "I", "")

# a row's letter: its role's initial (o: any other), upper case if truncated; x: it must be deleted
_LETTERS = "suaoSUAOx"


def _tokens(letter: str) -> list[list[tuple[int, str]]]:
    """[from][to]: the cheapest edits that consume a row, least string first."""
    best = [[(INF, "")] * 4 for _ in range(4)]
    extra = TRUNCATED if letter in "SUAO" else 0
    for s in range(4):
        at = s
        for inserts in range(3):  # two inserts lead wherever more would
            options = [(at, DELETE, "D")]
            if letter != "x":
                options.append((_NEXT[at], REROLE + extra, "R"))
                if (at, letter.lower()) in _FITS:
                    options.append((_FITS[at, letter.lower()], extra, "K"))
            for to, cost, name in options:
                best[s][to] = min(best[s][to], (cost + INSERT * inserts, "I" * inserts + name))
            at = _NEXT[at]
    return best


TOKENS = {letter: _tokens(letter) for letter in _LETTERS}


def _ranks(keys: list) -> list[int]:
    order = sorted(range(4), key=keys.__getitem__)
    return [order.index(t) for t in range(4)]


#: An element is what happens between two places: costs [from][to] and ranks [from][to] of the least strings.
Element = tuple[list[list[int]], list[list[int]]]
_ROWS: dict[str, Element] = {k: ([[c for c, _ in row] for row in v], [_ranks([(c >= INF, name) for c, name in row]) for row in v])
                             for k, v in TOKENS.items()}


def forward(elements: list[Element], start: int) -> tuple[list[int], list[int]]:
    """Least cost to each state and the order of the least strings that reach them with it."""
    cost, rank = [0 if t == start else INF for t in range(4)], [int(t != start) for t in range(4)]
    for costs, ranks in elements:
        new, came = [INF] * 4, [(1, 0, 0)] * 4
        for t in range(4):
            least, by, last = min((cost[s] + costs[s][t], rank[s], s) for s in range(4))
            if least < INF:
                new[t], came[t] = least, (0, by, ranks[last][t])
        cost, rank = new, _ranks(came)
    return cost, rank


def backward(elements: list[Element], end: list[int]) -> list[int]:
    """Least cost from each state over the elements and on with the costs ``end``."""
    for costs, _ in reversed(elements):
        end = [min(costs[s][t] + end[t] for t in range(4)) for s in range(4)]
    return end


def crossings(elements: list[Element], start: int, end: int) -> list[int]:
    """The state after each element on the cheapest way from ``start`` to ``end``, of equal ones the least string."""
    if len(elements) == 1:
        return [end]
    half = len(elements) // 2
    there, rank = forward(elements[:half], start)
    back = backward(elements[half:], [0 if t == end else INF for t in range(4)])
    _, _, middle = min((there[s] + back[s], rank[s], s) for s in range(4))
    return crossings(elements[:half], start, middle) + crossings(elements[half:], middle, end)


def summed(elements: list[Element]) -> Element:
    """Several elements as one."""
    ways = [forward(elements, s) for s in range(4)]
    return [cost for cost, _ in ways], [rank for _, rank in ways]


def finish(elements: list[Element]) -> tuple[int, int]:
    """(cost of the whole conversation, state after its last element)."""
    cost, rank = forward(elements, START)
    total, _, last = min((cost[s] + INSERT * len(TAIL[s]), rank[s], s) for s in range(4))
    return total, last


@lru_cache(1 << 14)
def _block(letters: str) -> list[int]:
    costs, ranks = summed([_ROWS[c] for c in letters])
    return [x for row in costs for x in row] + [x for row in ranks for x in row]


@lru_cache(1 << 14)
def edits(letters: str, start: int, end: int) -> tuple[list[str], list[int]]:
    """The edits of each row, and the state before it."""
    states = [start, *crossings([_ROWS[c] for c in letters], start, end)]
    return [TOKENS[c][s][t][1] for c, s, t in zip(letters, states, states[1:])], states[:-1]


def _element(flat: list[int]) -> Element:
    return [flat[k:k + 4] for k in range(0, 16, 4)], [flat[k:k + 4] for k in range(16, 32, 4)]


# ------------------------------------------------------------------ rows


def _key(conv_id: str | Column = "conv_id") -> Column:
    return F.coalesce(F.col(conv_id).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by a hash of conversation and turn: a twentieth of the rows
    each is dropped, emptied, loses its sentence ends, is repeated, or is given to the user."""
    key = F.concat(_key(), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def ordered(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, digest, and ``at``, which follows conversation and turn over all tasks; written."""
    rows = conversations.select(_key().alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text")).withColumn("digest", F.sha2("text", 256))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "digest"]
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """conv, at, turn, initial and fault (blank, duplicate, truncated or none) of ordered rows."""
    end = F.rtrim("text", F.lit(WHITE))
    narrow = rows.select("conv", "at", "turn", "role", "digest", F.substring(end, -1, 1).alias("last"))
    blank = F.col("last") == ""
    again = narrow.where(~blank).groupBy("conv", "role", "digest").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    found = narrow.join(again.where("n > 1").drop("n"), ["conv", "role", "digest"], "left")
    initial = F.substring("role", 1, 1)
    return found.select(
        "conv", "at", "turn", F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        F.when(blank, "blank").when(F.col("at") > F.col("first"), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated").alias("fault"))


def blocks(found: DataFrame, block_rows: int) -> DataFrame:
    """conv, slot, letters (one per row), counts of faults and of unfit neighbours."""
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    row = F.struct("at", letter.alias("letter"), "initial")
    together = found.groupBy("conv", F.expr(f"at div {block_rows}").alias("slot")).agg(  # block_rows entries at most
        F.array_sort(F.collect_list(row)).alias("rows"),
        *(F.count(F.when(F.col("fault") == kind, 1)).alias(kind) for kind in ("blank", "duplicate", "truncated")))
    initials = F.concat_ws("", "rows.initial")
    before = F.lag("last").over(Window.partitionBy("conv").orderBy("slot"))  # one row per block
    pairs = F.length("neighbours") - 1 - F.regexp_count("neighbours", F.lit("s(?=u)|u(?=a)|a(?=u)"))
    return (together.select("conv", "slot", F.concat_ws("", "rows.letter").alias("letters"), initials.alias("initials"),
                            F.substring(initials, -1, 1).alias("last"), "blank", "duplicate", "truncated")
            .withColumn("neighbours", F.concat(F.coalesce(before, F.lit("")), "initials"))
            .withColumn("illegal", pairs.cast("long")).drop("initials", "last", "neighbours"))


_WAY = "conv string, slot long, before int, after int, cost long"


def _solve(blocks: DataFrame, fan: int) -> DataFrame:
    """conv, slot, the states before and after each block; ``cost`` of the conversation with its last block."""

    def sums(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                [_block(x) for x in batch.column(2).to_pylist()], pa.list_(pa.int64()))], ["conv", "slot", "element"])

    def grouped(batches):
        for batch in batches:
            groups = [summed([_element(x["element"]) for x in group]) for group in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                [[x for m in g for row in m for x in row] for g in groups], pa.list_(pa.int64()))], ["conv", "slot", "element"])

    def ways(batches):
        for batch in batches:
            out = []
            for conv, before, after, group in zip(*(c.to_pylist() for c in batch.columns)):
                elements, cost = [_element(x["element"]) for x in group], None
                if after is None:
                    cost, after = finish(elements)
                states = [before, *crossings(elements, before, after)]
                out += [(conv, x["slot"], s, t, cost if k == len(group) - 1 else None)
                        for k, (x, s, t) in enumerate(zip(group, states, states[1:]))]
            yield pa.RecordBatch.from_pylist([dict(zip(("conv", "slot", "before", "after", "cost"), r)) for r in out], schema=arrow)

    arrow = pa.schema([("conv", pa.string()), ("slot", pa.int64()), ("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64())])

    def gathered(level: DataFrame, *by):
        return level.groupBy("conv", *by).agg(F.array_sort(F.collect_list(F.struct("slot", "element"))).alias("group"))

    element = "conv string, slot long, element array<bigint>"
    levels = [written(map_arrow(blocks.select("conv", "slot", "letters"), sums, element), "sums")]
    up = F.expr(f"slot div {fan}")
    while (levels[-1].groupBy("conv").count().agg(F.max("count")).first()[0] or 0) > fan:
        levels.append(written(map_arrow(gathered(levels[-1], up.alias("up")), grouped, element), "sums"))
    top = gathered(levels.pop()).select("conv", F.lit(START).alias("before"), F.lit(None).cast("int").alias("after"), "group")
    found = written(map_arrow(top, ways, _WAY), "ways")
    while levels:
        known = found.select("conv", F.col("slot").alias("up"), "before", "after", F.col("cost").alias("total"))
        groups = gathered(levels.pop(), up.alias("up")).join(known, ["conv", "up"])
        inner = written(map_arrow(groups.select("conv", "before", "after", "group"), ways, _WAY), "ways")
        # the cost goes with the last block of its group
        last = inner.groupBy("conv", up.alias("up")).agg(F.max("slot").alias("slot")).join(known.where("total is not null"), ["conv", "up"])
        found = written(inner.drop("cost").join(last.select("conv", "slot", F.col("total").alias("cost")), ["conv", "slot"], "left"), "ways")
    return found


def solve(blocks: DataFrame, fan: int = FAN) -> DataFrame:
    """The blocks with ``edits`` (one string per row), ``states`` before each row, ``tail`` and ``cost`` (last block only)."""

    def run(batches):
        for batch in batches:
            names, states = [], []
            for letters, before, after in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                name, state = edits(letters, before, after)
                names.append(name)
                states.append(state)
            tails = [None if cost is None else TAIL[t] for t, cost in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.list_(pa.string())),
                                              pa.array(states, pa.list_(pa.int8())), pa.array(tails, pa.string()), batch.column(5)],
                                             ["conv", "slot", "edits", "states", "tail", "cost"])

    given = blocks.select("conv", "slot", "letters").join(_solve(blocks, fan), ["conv", "slot"])
    return map_arrow(given.select("conv", "slot", "letters", "before", "after", "cost"), run,
                     "conv string, slot long, edits array<string>, states array<tinyint>, tail string, cost long")


# ------------------------------------------------------------------ repaired texts


def _lines(batches):
    """(conversation, role, text) of the repaired rows, and (conversation, None, None) at its end, from ``_merged`` rows."""
    now, edit, states, at, tail, known = None, [], [], 0, "", False

    def inserted(n, state):
        for _ in range(n):
            state = _NEXT[state]
            yield now, _ROLE[state], ""

    for batch in batches:
        columns = [batch.column(k) for k in range(batch.num_columns)]
        convs, kinds = columns[0].to_pylist(), columns[1].to_pylist()
        for i, conv in enumerate(convs):
            if conv != now or not known:
                if known:
                    yield now, None, None
                now, known = conv, True
            if kinds[i] == 0:
                edit, states, tail, at = columns[4][i].as_py(), columns[5][i].as_py(), columns[6][i].as_py(), 0
            else:
                name, state = edit[at], states[at]
                yield from inserted(len(name) - 1, state)
                for _ in name[:-1]:
                    state = _NEXT[state]
                if name[-1] != "D":
                    yield now, columns[2][i].as_py() if name[-1] == "K" else _ROLE[_NEXT[state]], columns[3][i].as_py()
                at += 1
                if at == len(edit) and tail:  # the last row of the conversation
                    yield from inserted(len(tail), SYSTEM if len(tail) == 2 else USER)
    if known:
        yield now, None, None


def _merged(rows: DataFrame, solved: DataFrame, block_rows: int) -> DataFrame:
    """Rows behind the edits of their block, in order, a conversation in one stream."""
    texts = rows.select("conv", F.lit(1).alias("kind"), "role", "text", F.lit(None).cast("array<string>").alias("edits"),
                        F.lit(None).cast("array<tinyint>").alias("states"), F.lit(None).cast("string").alias("tail"),
                        F.expr(f"at div {block_rows}").alias("slot"), "at")
    plans = solved.select("conv", F.lit(0).alias("kind"), F.lit("").alias("role"), F.lit("").alias("text"), "edits", "states", "tail",
                          "slot", F.lit(0).cast("long").alias("at"))
    return texts.union(plans).repartition("conv").sortWithinPartitions("conv", "slot", "kind", "at").drop("slot", "at")


def repaired(rows: DataFrame, solved: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """conv_id, turn (from 0), role and text of the repaired conversations."""

    def run(batches):
        out, n, now = [], 0, None
        for conv, role, text in _lines(batches):
            if conv != now:
                now, n = conv, 0
            if role is not None:
                out.append({"conv": conv, "turn": n, "role": role, "text": text})
                n += 1
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("conv", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    found = map_arrow(_merged(rows, solved, block_rows), run, "conv string, turn long, role string, text string")
    return found.select(_conv_id(), "turn", "role", "text")


def digests(rows: DataFrame, solved: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """conv and the SHA-256 of its repaired ``role:text`` lines, newline-joined; taken line by line."""

    def run(batches):
        out, digest, first = [], hashlib.sha256(), True
        for conv, role, text in _lines(batches):
            if role is None:
                out.append({"conv": conv, "repaired_sha256": digest.hexdigest()})
                digest, first = hashlib.sha256(), True
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            else:
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])
    return map_arrow(_merged(rows, solved, block_rows), run, "conv string, repaired_sha256 string")


def _conv_id() -> Column:
    return F.when(F.col("conv") != " ", F.col("conv")).cast("long").alias("conv_id")


def report(conversations: DataFrame, damaged: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """Per conversation of ``conversations``: faults of its rows in ``damaged``, their cheapest repair and its digest."""
    rows = ordered(damaged)
    found = written(faults(rows), "faults")
    packed = written(blocks(found, block_rows), "blocks")
    solved = written(solve(packed, fan), "edits")
    turns = found.where("turn is not null").groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    counts = packed.groupBy("conv").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))
    audits = solved.groupBy("conv").agg(
        F.concat_ws("", F.array_sort(F.collect_list(F.struct("slot", F.concat(F.concat_ws("", "edits"), F.coalesce("tail", F.lit(""))).alias("piece"))))["piece"]).alias("audit"),
        F.max("cost").alias("cost"))
    out = conversations.select(_key().alias("conv")).distinct()
    for part in (turns, counts, audits, digests(rows, solved, block_rows)):
        out = out.join(part, "conv", "left")
    number = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(_conv_id(), *number, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
