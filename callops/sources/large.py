"""Envelopes of any size: one JSON file is read by as many tasks as its bytes ask for.

The file is read as text cut at ``}``, which lets Spark divide it anywhere. Where a range of the file
begins is not known to its task, so the structure is found in two passes, neither of which shuffles text:

1. Every range is scanned for each state that may hold at its start (outside strings, in a string, in
   a string behind a backslash) and gives a transition: state and change of depth at its end, and the
   arrays it opens by relative depth. Transitions are one row per range; a running composition over
   the ranges of a file tells the state, the depth and the open array at the start of each.
2. With its start known, every range cuts its row objects exactly. What crosses a border comes out as
   fragments, at most two per range, which are joined; the text around the rows gives the message.

A file holds one envelope. A broken one (unbalanced, cut off) has no rows, as with the one-task
reader. Elements of ``data`` that are no objects are no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from callops.session import work_dir

OUTSIDE, STRING, ESCAPE = range(3)
#: Depth inside the list of rows, and inside a row.
LIST, ROW = 2, 3
#: Pieces that are scanned together, at most.
RUN = 100

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_OPEN_STRING = re.compile(r'"(?:[^"\\]|\\.)*(\\?)\Z', re.S)
_PARTS = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|"', re.S)


def _entered(text: str, state: int) -> str:
    """The text as it reads from outside: an open string is opened again."""
    if state == OUTSIDE:
        return text
    return '"' + (text if state == STRING else text[1:])


def _pass(text: str, state: int) -> tuple[int, int]:
    """(state, change of depth) behind a piece of text."""
    if state == ESCAPE and not text:
        return ESCAPE, 0
    plain = _STRING.sub("", _entered(text, state))
    end = OUTSIDE
    if (at := plain.find('"')) >= 0:
        end = ESCAPE if _OPEN_STRING.match(plain, at)[1] else STRING
        plain = plain[:at]
    return end, plain.count("{") + plain.count("[") - plain.count("}") - plain.count("]")


def _events(text: str, state: int, depth: int) -> Iterator[tuple[int, str, int, str | None]]:
    """(place, bracket, depth before it, key before it) of the brackets outside strings; places count in the entered text."""
    key, last = None, None
    for found in _PARTS.finditer(_entered(text, state)):
        part = found[0]
        if part == '"':
            return
        if part == ":":
            key = last
        elif part in "{[":
            yield found.start(), part, depth, key
            depth, key = depth + 1, None
        elif part in "}]":
            yield found.start(), part, depth, None
            depth, key = depth - 1, None
        elif part == ",":
            key = None
        last = part[1:-1] if part[0] == '"' else None


def _slices(batches) -> Iterator[tuple[tuple, list[str], dict]]:
    """(range, its pieces with their closing braces, other columns) in file order; other columns are those of the range."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        start = batch.column("start").to_numpy(zero_copy_only=False)
        cuts = (np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1).tolist()
        for first, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            told = {name: batch.column(name)[first].as_py() for name in batch.schema.names if name != "value"}
            values = batch.column("value").slice(first, end - first).to_pylist()
            yield (told["file"], told["start"]), [value + "}" for value in values], told


def _pieces(batches) -> Iterator[tuple[tuple, str, dict]]:
    """The same, piece by piece."""
    for place, pieces, told in _slices(batches):
        for piece in pieces:
            yield place, piece, told


def _runs(batches) -> Iterator[tuple[tuple, str, dict]]:
    """The same, neighbours without ``[`` put together: what opens an array is only looked for in the others."""
    for place, pieces, told in _slices(batches):
        held = []
        for piece in pieces:
            if held and ("[" in piece or len(held) == RUN):
                yield place, "".join(held), told
                held = []
            if "[" in piece:
                yield place, piece, told
            else:
                held.append(piece)
        if held:
            yield place, "".join(held), told


def _transitions(batches):
    """One row per range: its bytes, and for each state at its start the transition."""
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()), ("state", pa.list_(pa.int32())),
                        ("change", pa.list_(pa.int32())), ("opened", pa.list_(pa.map_(pa.int32(), pa.string())))])
    now, size, held, ways = None, 0, 0, []

    def row():
        return pa.RecordBatch.from_pylist([{
            "file": now[0], "start": now[1], "size": size, "bytes": held, "state": [w[0] for w in ways],
            "change": [w[1] for w in ways], "opened": [list(w[2].items()) for w in ways]}], schema=schema)

    for place, piece, told in _runs(batches):
        if place != now:
            if now is not None:
                yield row()
            now, size, held, ways = place, told["size"], 0, [(state, 0, {}) for state in (OUTSIDE, STRING, ESCAPE)]
        held += len(piece.encode())
        steps = {}
        for state in {w[0] for w in ways}:
            lists = [x for x in _events(piece, state, 0) if x[1] == "["] if "[" in piece else []
            steps[state] = *_pass(piece, state), lists
        for i, (state, change, opened) in enumerate(ways):
            after, delta, lists = steps[state]
            ways[i] = after, change + delta, opened | {change + depth: key for _, _, depth, key in lists} if lists else opened
    if now is not None:
        yield row()


def _starts(batches):
    """Per range of a file: state, depth and open list at its start, and whether the file is whole."""
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("state", pa.int32()), ("depth", pa.int32()),
                        ("list", pa.string()), ("whole", pa.bool_())])
    for batch in batches:
        for file, size, ranges in zip(*(c.to_pylist() for c in batch.columns)):
            state, depth, name, out = OUTSIDE, 0, None, []
            for r in ranges:
                out.append({"file": file, "start": r["start"], "state": state, "depth": depth, "list": name})
                name = {x["key"]: x["value"] for x in r["opened"][state]}.get(LIST - 1 - depth, name)
                state, depth = r["state"][state], depth + r["change"][state]
            # behind the last piece there may have been no brace: then one more was counted than there is
            whole = state == OUTSIDE and depth == (0 if sum(r["bytes"] for r in ranges) == size else -1)
            yield pa.RecordBatch.from_pylist([x | {"whole": whole} for x in out], schema=schema)


class _Cutter:
    """Cuts one range, piece by piece, into (kind, text).

    ``row``: a whole row. ``begin``: a row that goes on in the next range. ``more``: the rest of an earlier
    range's row, or a range inside it. ``around``: text outside the rows that tells something.
    """

    def __init__(self, state: int, depth: int, name: str | None, rows_of: str):
        self.state, self.depth, self.name, self.rows_of = state, depth, name, rows_of
        # inside a row, or inside a string of it
        self.row: list[str] | None = [] if depth >= ROW and name == rows_of else None
        self.kind = "more"

    def _row_starts(self, piece: str) -> int | None:
        for place, bracket, depth, key in _events(piece, self.state, self.depth):
            if bracket == "[" and depth == LIST - 1:
                self.name = key
            if bracket == "{" and depth == LIST and self.name == self.rows_of:
                return place - (self.state == STRING)
        return None

    def take(self, piece: str) -> Iterator[tuple[str, str]]:
        if self.row is None:
            among = self.depth == LIST and self.state == OUTSIDE and self.name == self.rows_of
            start = self._row_starts(piece)
            outer = piece if start is None else piece[:start].rstrip(" \t\r\n,")
            if among:
                outer = "" if start is not None and "]" not in outer else outer.lstrip(" \t\r\n,")
            if outer and (self.depth > 0 or outer.strip() != "}"):
                yield "around", outer
            if start is not None:
                self.row, self.kind = [piece[start:]], "row"
        else:
            self.row.append(piece)
        self.state, change = _pass(piece, self.state)
        self.depth += change
        if self.row is not None and self.state == OUTSIDE and self.depth <= LIST:
            yield self.kind, "".join(self.row)
            self.row, self.kind = None, "row"

    def end(self) -> Iterator[tuple[str, str]]:
        if self.row:
            yield ("begin" if self.kind == "row" else "more"), "".join(self.row)


def _cut(rows_of: str, names: list[str]):
    def run(batches):
        now, cutter, carried, out, n = None, None, {}, [], 0

        def put(found):
            nonlocal n
            for kind, text in found:
                out.append((*carried, *now, kind, n, text))
                n += 1

        def full():
            columns = list(zip(*out)) or [[]] * (len(names) + 5)
            types = [*schema, pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*names, "file", "start", "kind", "n", "text"])
            out.clear()
            return batch

        schema = None
        for batch in batches:
            schema = [batch.schema.field(name).type for name in names]
            for place, piece, told in _pieces([batch]):
                if place != now:
                    if now is not None:
                        put(cutter.end())
                    now, n, carried = place, 0, [told[name] for name in names]
                    cutter = _Cutter(told["state"], told["depth"], told["list"], rows_of)
                put(cutter.take(piece))
            yield full()
        if now is not None:
            put(cutter.end())
            yield full()

    return run


def read_large(spark: SparkSession, path: str, rows_of: str = "data", dates: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, messages) of the envelope files under ``path``: ``raw`` per row object, ``message`` per envelope.

    Folder columns (``date=...``) are carried; ``dates`` (one row per date) names the folders to read. The table of range starts, one row per range, goes to all
    tasks: some 200 bytes per ``spark.sql.files.maxPartitionBytes`` of input. What is cut is written to
    the work folder once.
    """
    text = spark.read.option("basePath", path).option("lineSep", "}").text(path)
    names = [c for c in text.columns if c != "value"]
    text = text.select(*names, "value", F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"))
    if "date" in names:
        text = text.withColumn("date", F.col("date").cast("date"))
    if dates is not None:  # sent to all tasks, so that the pieces of a file stay in order
        text = text.join(F.broadcast(dates.select("date")), "date", "left_semi")
    ways = text.select("file", "start", "size", "value").mapInArrow(
        _transitions, "file string, start long, size long, bytes long, state array<int>, change array<int>, opened array<map<int,string>>")
    by_file = ways.groupBy("file").agg(F.max("size").alias("size"), F.array_sort(F.collect_list(
        F.struct("start", "bytes", "state", "change", F.transform("opened", F.map_entries).alias("opened")))).alias("ranges"))
    starts = by_file.mapInArrow(_starts, "file string, start long, state int, depth int, list string, whole boolean")
    starts = _written(starts, "ranges").where("whole").drop("whole")

    placed = text.drop("size").join(F.broadcast(starts), ["file", "start"])
    columns = [placed.schema[name] for name in names]
    schema = T.StructType([*columns, *T._parse_datatype_string("file string, start long, kind string, n long, text string").fields])
    cut = _written(placed.mapInArrow(_cut(rows_of, names), schema), "cut")

    # a row over several ranges begins in one and goes on in the next ones
    parts = cut.where("kind in ('begin', 'more')")
    begun = F.sum(F.when(F.col("kind") == "begin", 1).otherwise(0)).over(Window.partitionBy("file").orderBy("start", "n"))
    joined = parts.withColumn("row", begun).groupBy("file", "row", *names).agg(_in_order().alias("raw"))
    rows = cut.where("kind = 'row'").select(*names, F.col("text").alias("raw")).unionByName(joined.select(*names, "raw"))
    around = cut.where("kind = 'around'").groupBy("file", *names).agg(_in_order().alias("text"))
    return rows, around.select(*names, F.from_json("text", "message string")["message"].alias("message"))


def _in_order():
    return F.concat_ws("", F.array_sort(F.collect_list(F.struct("start", "n", "text")))["text"])


def _written(df: DataFrame, purpose: str) -> DataFrame:
    folder = work_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
