"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside Spark partitions.

Every distinct pre-token of a slice of texts becomes rows (word, position, token). A recursive query
joins neighbouring tokens with the merge table and contracts each word's leftmost pair of minimum
rank until no pair is left. An ordered aggregation over token positions decodes.

Defined results: a null or empty text has no tokens and decodes to no bytes; repeated rows are
encoded each; columns other than the named ones are not carried, so extra columns cannot clash.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from callops.llm.common import batches_of, freed, map_arrow, text_of

#: Bounds of what one Python worker holds at a time.
SLICE_WORDS = 300_000
SLICE_TOKENS = 100_000
MERGE_WORDS = 30_000
CACHE_WORDS = 200_000
#: Words beyond this many bytes keep one list of tokens instead of a row per token and step.
LONG_BYTES = 96  # below 1024, see the codes of pairs

# Rows are ordered by one key, word << 10 | position. A step turns each word that still has a pair
# into its tokens after one contraction; a pair's code orders by rank, then position. Steps are
# numbered; a word's result is its last step.
_SHORT = """
with recursive steps(place, id, step) as (
    select place, id, 0::integer from start
    union all (
        with pairs as materialized (
            select p.place, p.id, p.step, p.before, (m.id::bigint << 10) | (p.place & 1023) as code
            from (
                select *, lead(id) over in_order as following, lead(place) over in_order as after, lag(place) over in_order as before
                from steps window in_order as (order by place)
            ) p left join merges m on m.a = p.id and m.b = p.following and p.after >> 10 = p.place >> 10
        ), firsts as (
            select place >> 10 as word, min(code) as code from pairs where code is not null group by place >> 10
        )
        select p.place, (case when p.code = f.code then f.code >> 10 else p.id end)::integer, p.step + 1
        from pairs p join firsts f on f.word = p.place >> 10
        where p.before is distinct from ((f.word << 10) | (f.code & 1023))
    )
)
select s.place >> 10 as word, s.id from steps s
join (select place >> 10 as word, max(step) as step from steps group by place >> 10) l
on l.word = s.place >> 10 and l.step = s.step
order by s.place
"""

# The same for long words: one row per word, replaced in each step. All occurrences of the minimum
# pair are contracted from the left, as repeated leftmost contraction would, up to the first one
# that brings a new pair of lower rank about.
_LONG = """
with recursive words(word, ids, merging) using key (word) as (
    select word, list(id order by pos), true from start group by word
    union
    select word, list(case when hit then merged else id end order by pos), bool_or(hit) from (
        select word, pos, id, merged, hit, lag(hit, 1, false) over (partition by word order by pos) as consumed
        from (
            select h.word, h.pos, h.id, h.merged,
                   h.hit and h.pos <= coalesce(min(case when h.hit and (l.id < h.merged or r.id < h.merged)
                       then h.pos end) over (partition by h.word), h.pos) as hit
            from (
                select *, case when lag(hit, 2, false) over in_word then lag(merged, 2) over in_word
                               else lag(id, 1) over in_word end as before,
                       lead(id, 2) over in_word as after
                from (
                    select *, merged = least_rank
                        and row_number() over (partition by word, merged = least_rank, pos - place order by pos) % 2 = 1 as hit
                    from (
                        select *, row_number() over (partition by word, merged = least_rank order by pos) as place
                        from (
                            select p.word, p.pos, p.id, coalesce(m.id, -1) as merged,
                                   coalesce(min(m.id) over (partition by p.word), -2) as least_rank
                            from (
                                select word, pos, id, lead(id) over (partition by word order by pos) as following
                                from (select word, unnest(ids) as id, generate_subscripts(ids, 1) as pos
                                      from words where merging)
                            ) p left join merges m on m.a = p.id and m.b = p.following
                        )
                    )
                ) window in_word as (partition by word order by pos)
            ) h
            left join merges l on h.hit and l.a = h.before and l.b = h.merged
            left join merges r on h.hit and r.a = h.merged and r.b = h.after
        )
    ) where not consumed group by word
)
select word, ids from words order by word
"""

_DECODE = "select doc, list(id order by pos) as ids from tokens group by doc order by doc"


def _ranks(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}


class _Duck:
    """A worker's DuckDB for one vocabulary; it is kept for the next task."""

    _last: tuple[bytes, _Duck] | None = None

    @classmethod
    def of(cls, vocabulary: bytes, *given):
        if cls._last is None or cls._last[0] != vocabulary:
            cls._last = vocabulary, cls(vocabulary, *given)
        return cls._last[1]

    def __init__(self, duck=None):
        import duckdb

        self.duck = duck or duckdb.connect(config={"threads": 1, "memory_limit": "100MB"})

    def _query(self, sql: str, name: str, **columns) -> pa.Table:
        self.duck.register(name, pa.table(columns))
        result = self.duck.sql(sql).to_arrow_table()
        self.duck.unregister(name)
        return result


class Decoder(_Duck):
    """Token ids to bytes."""

    def __init__(self, vocabulary: bytes, duck=None):
        super().__init__(duck)
        tokens = {rank: token for token, rank in _ranks(vocabulary).items()}
        lengths = [len(tokens.get(k, b"")) for k in range(max(tokens) + 1)]
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.letters = np.frombuffer(b"".join(tokens.get(k, b"") for k in range(max(tokens) + 1)), np.uint8)

    def decode(self, doc: np.ndarray, ids: np.ndarray) -> dict[int, bytes]:
        """Document → the bytes of its tokens in order of position."""
        found = self._query(_DECODE, "tokens", doc=doc, pos=np.arange(len(ids), dtype=np.int32), id=ids)
        lists = found["ids"].combine_chunks()
        ordered, counts = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        lengths = self.ends[ordered] - self.starts[ordered]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ordered] - (ends - lengths), lengths)
        raw = self.letters[places].tobytes()
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *counts])].tolist()
        return {k: raw[a:b] for k, a, b in zip(found["doc"].to_pylist(), cuts, cuts[1:])}

    def texts(self, lists: pa.Array) -> pa.Array:
        """The bytes of each list of ids."""
        flat = lists.flatten().to_numpy()
        doc = np.repeat(np.arange(len(lists), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
        found: dict[int, list[bytes]] = {}
        for at in range(0, len(flat), SLICE_TOKENS):  # a very long text comes in pieces
            for k, piece in self.decode(doc[at:at + SLICE_TOKENS], flat[at:at + SLICE_TOKENS]).items():
                found.setdefault(k, []).append(piece)
        return pa.array([b"".join(found.get(k, [])) for k in range(len(lists))], pa.binary())


class Merger(_Duck):
    """Words to token ids: the merge table, and the words met lately."""

    def __init__(self, vocabulary: bytes):
        super().__init__()
        self.ranks = _ranks(vocabulary)
        merges = [(self.ranks[t[:i]], self.ranks[t[i:]], rank) for t, rank in self.ranks.items()
                  for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        a, b, merged = (pa.array(x, pa.int32()) for x in zip(*merges)) if merges else [pa.array([], pa.int32())] * 3
        self.duck.register("given", pa.table({"a": a, "b": b, "id": merged}))
        self.duck.execute("create table merges as from given")
        self.duck.unregister("given")
        self.bytes_to_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        # word → its ids as bytes; the words met lately, and those before them
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _rows(self, words: list[bytes]) -> dict:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
        return {"word": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
                "pos": (np.arange(lengths.sum()) - starts).astype(np.int32),
                "id": self.bytes_to_id[np.frombuffer(b"".join(words), np.uint8)]}

    def _merge(self, words: list[str]) -> None:
        """Tokens of new words go to ``known``; a word that is a token itself is that token."""
        short, long = [], []
        for word in words:
            raw = word.encode()
            if raw in self.ranks:
                self.known[word] = np.int32(self.ranks[raw]).tobytes()
            else:
                (short if len(raw) <= LONG_BYTES else long).append((word, raw))
        for at in range(0, len(short), MERGE_WORDS):
            part = short[at:at + MERGE_WORDS]
            rows = self._rows([raw for _, raw in part])
            found = self._query(_SHORT, "start", place=rows["word"].astype(np.int64) << 10 | rows["pos"], id=rows["id"])
            ids = found["id"].to_numpy().astype(np.int32).tobytes()
            ends = 4 * np.searchsorted(found["word"].to_numpy(), np.arange(len(part) + 1))
            for (word, _), a, b in zip(part, ends[:-1].tolist(), ends[1:].tolist()):
                self.known[word] = ids[a:b]
        for word, raw in long:
            found = self._query(_LONG, "start", **self._rows([raw]))
            self.known[word] = found["ids"].combine_chunks()[0].values.to_numpy().astype(np.int32).tobytes()

    def learn(self, words: set[str]) -> None:
        """Have the tokens of these words at hand."""
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        missing = words.difference(self.known)
        again = missing.intersection(self.older)
        self.known.update((w, self.older[w]) for w in again)
        self._merge(list(missing - again))

    def ids(self, words: list[str]) -> bytes:
        """Token ids of learned words one after another, four bytes each."""
        return b"".join(map(self.known.__getitem__, words))


def _words(texts: list[str], pattern) -> Iterator[list[tuple[int, list[str]]]]:
    """Slices of (text number, its next pre-tokens) in order."""
    held, size = [], 0
    for k, text in enumerate(texts):
        if len(text) <= SLICE_WORDS:
            parts = [pattern.findall(text)]
        else:  # never all pre-tokens of a very long text at once
            matches = (m[0] for m in pattern.finditer(text))
            parts = iter(lambda: list(islice(matches, SLICE_WORDS)), [])
        for part in parts:
            held.append((k, part))
            size += len(part)
            if size >= SLICE_WORDS:
                yield held
                held, size = [], 0
    yield held


def _encode_texts(texts: list[str], pattern, merger: Merger) -> pa.Array:
    """A list of token ids per text."""
    found: list[list[bytes]] = [[] for _ in texts]
    for held in _words(texts, pattern):
        merger.learn(set().union(*(words for _, words in held)))
        for k, words in held:
            found[k].append(merger.ids(words))
    ids = [b"".join(parts) for parts in found]
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def _shared(df: DataFrame, vocabulary: str):
    """The bytes of a rank file on the driver, for the executors: about 1 MB."""
    with open(vocabulary, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _parts(batch: pa.RecordBatch):
    """Slices of a batch whose last column holds texts, with the texts."""
    sizes = pc.utf8_length(batch.column(batch.num_columns - 1)).to_pylist()
    for start, end in batches_of(sizes, 4 * SLICE_WORDS):
        part = batch.slice(start, end - start)
        yield part.columns[:-1], part.column(part.num_columns - 1).to_pylist()


_IDS = T.ArrayType(T.IntegerType(), False)


def encode(docs: DataFrame, vocabulary: str, pattern: str, keep: list[str] = ["doc_id"], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``ids``, the token ids of ``text``.

    ``vocabulary`` is a rank file on the driver (base64 token, rank); its bytes go to the executors.
    ``pattern`` splits a text into pre-tokens, which are merged separately.
    """
    shared = _shared(docs, vocabulary)

    def run(batches):
        import regex

        compiled, merger = regex.compile(pattern), Merger.of(shared.value)
        for batch in freed(batches):
            for kept, texts in _parts(batch):
                yield pa.RecordBatch.from_arrays([*kept, _encode_texts(texts, compiled, merger)], [*keep, "ids"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("ids", _IDS, False)])
    return map_arrow(docs.select(*keep, text_of(text).alias("_text")), run, schema)


def decode(tokens: DataFrame, vocabulary: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """The columns ``keep`` and ``decoded``, the bytes that the token ids stand for (null ids: no bytes)."""
    shared = _shared(tokens, vocabulary)

    def run(batches):
        decoder = Decoder.of(shared.value)
        for batch in freed(batches):
            sizes = pc.list_value_length(batch.column(batch.num_columns - 1)).to_pylist()
            for start, end in batches_of(sizes, SLICE_TOKENS):
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], decoder.texts(part.column(part.num_columns - 1))], [*keep, "decoded"])

    schema = T.StructType([*tokens.select(*keep).schema.fields, T.StructField("decoded", T.BinaryType(), False)])
    given = F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("_ids")
    return map_arrow(tokens.select(*keep, given), run, schema)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, keep: list[str] = ["doc_id"], text: str = "text") -> DataFrame:
    """The columns ``keep``, ``ids`` and ``decoded``: encoding, and decoding of its ids, in one pass and one worker."""
    shared = _shared(docs, vocabulary)

    def run(batches):
        import regex

        compiled, merger = regex.compile(pattern), Merger.of(shared.value)
        decoder = Decoder.of(shared.value, merger.duck)
        for batch in freed(batches):
            for kept, texts in _parts(batch):
                ids = _encode_texts(texts, compiled, merger)
                yield pa.RecordBatch.from_arrays([*kept, ids, decoder.texts(ids)], [*keep, "ids", "decoded"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("ids", _IDS, False), T.StructField("decoded", T.BinaryType(), False)])
    return map_arrow(docs.select(*keep, text_of(text).alias("_text")), run, schema)


def digests(tokens: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, n_tokens, and the SHA-256 of the ids (decimal, comma-joined) and of the decoded bytes."""
    return tokens.select(
        *keep, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
