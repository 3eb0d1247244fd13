"""Best-two-fit packing of tokenised documents into sequences of a fixed number of tokens.

A document is its token ids and an end id. One longer than a sequence is cut into whole sequences
behind a shorter first piece. Pieces are then packed as a sequential best-two-fit over all of them
would do it: fill a sequence greedily with the longest pieces that fit, then replace its smallest
piece by the two unpacked pieces that fill the gap it leaves best, if they fill it better.

Pieces of one length are interchangeable, so the decisions are taken on the number of pieces per
length, a table of at most ``capacity`` rows, and a filling is repeated as long as it stays the same.
A piece finds its place by its rank among the pieces of its length; ranks come from a count per task
and length and a running sum of those counts, so no task ever sees all pieces of a common length.

Defined results: a null or empty text is its end id alone; repeated rows are packed each; an empty
table gives no rows; a null ``doc_id`` is kept; equal lengths are taken in any order; columns
``sequence_id`` and ``offset`` of the input are replaced, other columns are carried as they are.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from callops.llm.common import map_arrow, text_of, written

#: What a worker tokenises and returns at a time: characters of text, tokens.
SLICE_CHARS, SLICE_TOKENS = 200_000, 1_000_000
#: White space as the tokenizers' pattern understands it.
_WHITE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: No token reaches from a character that is not white space into white space: texts may be cut there.
_CUT = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])")
_LONG_WHITE = re.compile(f"[{_WHITE}]{{10000}}")


def _byte_ranks(definition: str) -> tuple[dict[bytes, int], str] | None:
    """(token bytes to id) of a byte-level BPE whose ids are its merge ranks, else None."""
    told = json.loads(definition)
    if told["model"]["type"] != "BPE" or told.get("normalizer") or (told["pre_tokenizer"] or {}).get("type") != "ByteLevel":
        return None
    if told["pre_tokenizer"]["add_prefix_space"] or not told["pre_tokenizer"].get("use_regex", True):
        return None
    vocabulary = told["model"]["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"]]
    if [vocabulary.get(a + b) for a, b in merges] != list(range(256, 256 + len(merges))):
        return None
    # byte-level BPE writes bytes as printable characters: its own code where that is one, else from 256 up
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t["content"] for t in told["added_tokens"]}
    return {bytes(letters[c] for c in t): k for t, k in vocabulary.items() if t not in special}


class Encoder:
    """Texts to ids as the ``tokenizers`` library gives them; special tokens in a text are plain text.

    Where the ids are merge ranks, ``tiktoken`` gives the same ids in a third of the time (a test goes
    through all code points). It cannot take very long white space; such texts go to ``tokenizers``.
    """

    _last: tuple[str, Encoder] | None = None

    @classmethod
    def of(cls, definition: str) -> Encoder:
        if cls._last is None or cls._last[0] != definition:
            cls._last = definition, cls(definition)
        return cls._last[1]

    def __init__(self, definition: str):
        self.definition, self.slow, self.fast = definition, None, None
        if ranks := _byte_ranks(definition):
            import public_tokenizers
            import tiktoken

            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> list[int]:
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_str(self.definition)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None:  # a tokenizer of another kind may read more than a word at a time
            return np.array(self._plain(text), np.uint32)
        parts = []
        for part in _slices(text):
            if len(part) >= 10_000 and _LONG_WHITE.search(part):
                parts.append(np.array(self._plain(part), np.uint32))
            else:
                parts.append(np.array(self.fast.encode_ordinary(part), np.uint32))
        return np.concatenate(parts)


def _slices(text: str) -> Iterator[str]:
    """The text in slices that no token crosses, of about SLICE_CHARS where it has white space."""
    start = 0
    while len(text) - start > SLICE_CHARS and (cut := _CUT.search(text, start + SLICE_CHARS)):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def piece_starts(n: int, capacity: int) -> list[int]:
    """Where the pieces of ``n`` ids begin: whole ones of ``capacity``, behind a shorter first one."""
    if n <= capacity:
        return [0]
    rest = n % capacity
    return [0] * (rest > 0) + list(range(rest, n, capacity))


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keep: list[str] = ["doc_id"], text: str = "text") -> DataFrame:
    """``keep``, piece, start, length and ids (binary, little-endian unsigned 32-bit) of every piece.

    ``tokenizer`` is a file of the ``tokenizers`` library on the driver (2 MB); its text goes to the executors.
    """
    with open(tokenizer, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        encoder = Encoder.of(shared.value)
        for batch in batches:
            rows, held = [], 0
            texts = batch.column(batch.num_columns - 1)
            for i in range(len(texts)):
                ids = np.append(encoder.ids(texts[i].as_py()), np.uint32(end_id)).astype("<u4")
                starts = piece_starts(len(ids), capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append((i, k, a, b - a, ids[a:b].tobytes()))
                held += len(ids)
                if held >= SLICE_TOKENS:
                    yield record(batch, rows)
                    rows, held = [], 0
            if rows:
                yield record(batch, rows)

    def record(batch, rows):
        i, piece, start, length, ids = zip(*rows)
        kept = [c.take(pa.array(i, pa.int32())) for c in batch.columns[:-1]]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
            [*keep, "piece", "start", "length", "ids"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("piece", T.IntegerType(), False),
                           T.StructField("start", T.LongType(), False), T.StructField("length", T.LongType(), False),
                           T.StructField("ids", T.BinaryType(), False)])
    return map_arrow(docs.select(*keep, text_of(text).alias("_text")), run, schema)


def best_two_fit(counts: np.ndarray, capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """(length to pieces of it in a sequence, such sequences one after another); ``counts`` by length from 0 to capacity."""
    left, index = counts.astype(np.int64), np.arange(capacity + 1)
    while left.any():
        filling, gap = {}, capacity
        present = np.flatnonzero(left)
        while len(present) and (at := np.searchsorted(present, gap, "right")):
            size = int(present[at - 1])
            filling[size] = int(min(left[size], gap // size))
            gap -= filling[size] * size
            present = present[:at - 1]
        held, smallest = dict(filling), min(filling)
        if gap:
            free = left.copy()
            for size, n in filling.items():
                free[size] -= n
            nearest = np.maximum.accumulate(np.where(free > 0, index, 0))  # the longest free piece up to a length
            one = np.flatnonzero(free[:gap + smallest])
            two = nearest[gap + smallest - one]
            alone = (two == one) & (free[one] < 2)
            two[alone] = nearest[one[alone] - 1]
            both = np.where(two > 0, one + two, 0)
            if len(one) and both.max() > smallest:
                pair = int(one[both.argmax()]), int(two[both.argmax()])
                filling[smallest] -= 1
                for size in pair:
                    filling[size] = filling.get(size, 0) + 1
                    held[size] = held.get(size, 0) + 1
        filling = {size: n for size, n in filling.items() if n}
        # the same choice as long as all that was looked at is there
        times = min((int(left[size]) - held[size]) // n for size, n in filling.items()) + 1
        for size, n in filling.items():
            left[size] -= times * n
        yield filling, times


def _places(counts: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """By length and first rank: the sequence it begins, pieces of the length a sequence has, their offset."""
    found, sequence = [], 0
    used = np.zeros(capacity + 1, np.int64)
    for filling, times in best_two_fit(counts, capacity):
        offset = 0
        for size in sorted(filling, reverse=True):
            found.append((size, used[size], sequence, filling[size], offset))
            used[size] += times * filling[size]
            offset += size * filling[size]
        sequence += times
    table = np.array(sorted(found), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "together", "offset"), table.T))


def _numbered(pieces: DataFrame) -> DataFrame:
    """``row``, ``length``, the task, and the number of earlier pieces of that length in the task."""

    def run(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(0, np.int64)
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            if not len(lengths):
                continue
            seen = np.pad(seen, (0, max(0, int(lengths.max()) + 1 - len(seen))))
            order = np.argsort(lengths, kind="stable")
            ordered = lengths[order]
            nth = np.empty(len(lengths), np.int64)
            nth[order] = np.arange(len(ordered)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(lengths, minlength=len(seen))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(lengths), part, np.int32)), pa.array(nth)], ["row", "length", "part", "nth"])

    schema = T.StructType([*pieces.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType())])
    return map_arrow(pieces, run, schema)


def pack(pieces: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """The columns of ``pieces``, ``sequence_id`` and ``offset``; lengths lie between 1 and ``capacity``.

    Sequences are numbered from 0. The pieces are written once, then read for the places.
    """
    pieces = pieces.drop("sequence_id", "offset")
    given = pieces.select(F.struct("*").alias("row"), F.col(length).cast("int").alias("length"))
    numbered = written(_numbered(given), "pieces")
    per_task = written(numbered.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = np.zeros(capacity + 1, np.int64)
    for size, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # capacity rows at most
        if not 0 < size <= capacity:
            raise ValueError(f"a piece of {size} tokens")
        counts[size] = n
    shared = pieces.sparkSession.sparkContext.broadcast(_places(counts, capacity))

    def run(batches):
        plan = shared.value
        keys = plan["length"] << 40 | plan["rank"]
        for batch in batches:
            lengths, rank = batch.column(1).to_numpy().astype(np.int64), batch.column(2).to_numpy()
            at = np.searchsorted(keys, lengths << 40 | rank, "right") - 1
            ahead = rank - plan["rank"][at]
            together = plan["together"][at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(plan["sequence"][at] + ahead // together),
                 pa.array(plan["offset"][at] + ahead % together * lengths)], ["row", "sequence_id", "offset"])

    ranked = numbered.join(before, ["part", "length"]).select("row", "length", (F.col("nth") + F.col("before")).alias("rank"))
    schema = T.StructType([ranked.schema["row"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return map_arrow(ranked, run, schema).select("row.*", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids: the pieces of each sequence one after another, at most a sequence's tokens."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.aggregate(ordered, F.lit(b""), lambda ids, x: F.concat(ids, x["ids"])).alias("ids"))
