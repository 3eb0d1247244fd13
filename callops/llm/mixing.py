"""Mixing sources to target weights by weighted fair queueing.

Each source serves its documents in a shuffled order, as often as ``repeats`` allows. A copy's
virtual finish time is the words its source has served up to and including it, divided by the
source's target. All copies are put in order of finish time and cut where the total budget is used
up, so every source ends near its target. What a source sends is then a prefix of its own order, and
the last copy it sends (one row per source) decides for every document.

Prefix sums are taken over ranges of the order: one sum per range, the running total of the ranges,
and a window inside each range. A source has as many ranges as its rows ask for, so they are even
also where one source holds a third of all rows, and they grow in number with the data.

Defined results: null text has no words; a null source is a source of its own, ordered last; rows
that repeat a document (id and text) are numbered and each has a place of its own, so reruns agree on
how many of them are taken, not on which; documents without words take nothing; an empty table gives
an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from callops.llm.common import WORD, text_of, written
from callops.llm.exact import may_repeat

#: Rows of a range of the shuffled order, and copies between two steps of finish time.
RANGE_ROWS = 5_000


def words(text: str) -> Column:
    """Number of words of a text; null has none."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def place(doc_id: str, text: str) -> Column:
    """The document's place in its source's shuffled order; the same in every run."""
    return F.md5(F.concat_ws("\x1f", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), text_of(text)).cast("binary"))


def source_key(source: str) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def targets(totals: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """Target words of each source (one row per source: ``key``, ``source_size``, ``docs``).

    Weights repeat over the sources in code point order, null last. No target exceeds ``repeats``
    times the source; the excess goes to the others by weight. Filled like connected vessels: sources
    fill up in order of capacity over weight, the rest share one level.
    """
    by_name = W.orderBy(F.col("key") == "", "key")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    given = totals.withColumn("weight", weight.cast("double")).withColumn("capacity", F.col("source_size") * float(repeats))
    everything = W.partitionBy()
    filling = W.orderBy(F.col("capacity") / F.col("weight"), F.col("key") == "", "key").rowsBetween(W.unboundedPreceding, -1)
    room = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0))
    budget = F.sum("source_size").over(everything) * F.lit(share)
    left = budget - F.coalesce(F.sum("capacity").over(filling), F.lit(0.0))
    full = given.withColumn("budget", budget).withColumn("full", F.col("capacity") * room <= F.col("weight") * left)
    kept = F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    level = (F.col("budget") - kept) / F.when(open_weight > 0, open_weight)
    return full.select("key", "source_size", "docs", "budget",
                       F.when(F.col("full"), F.col("capacity")).otherwise(F.col("weight") * level).alias("target"))


def cuts(sized: DataFrame, weights: tuple[int, ...], share: float, repeats: int,
         range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per source: ``key``, ``source_size``, ``target``, and the last copy it sends.

    ``sized`` is a written table of ``key``, ``size`` and ``place``. ``last`` is (epoch, place), null
    where nothing is sent.
    """
    totals = sized.groupBy("key").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("docs"))
    goals = written(targets(totals, weights, share, repeats), "targets")
    steps_a_unit = max(1, -(-(goals.agg(F.sum("docs")).first()[0] or 0) // range_rows))

    # words served by a source up to each document: totals of ranges, then a window inside each range
    number = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    ranges = goals.select("key", F.ceil(F.col("docs") / range_rows).cast("long").alias("ranges"))
    queue = (sized.where(F.col("size") > 0).join(ranges, "key")
             .withColumn("range", F.floor(number * F.col("ranges") / F.lit(float(1 << 32)))).drop("ranges"))
    before = (queue.groupBy("key", "range").agg(F.sum("size").alias("served")).select(
        "key", "range", F.coalesce(F.sum("served").over(
            W.partitionBy("key").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    inside = W.partitionBy("key", "range").orderBy("place").rangeBetween(W.unboundedPreceding, W.currentRow)
    served = (queue.join(before, ["key", "range"])
              .select("key", "place", "size", (F.col("before") + F.sum("size").over(inside)).alias("served")))

    finish = (F.col("epoch") * F.col("source_size") + F.col("served")) / F.col("target")
    copies = (served.join(goals, "key")
              .select("key", "place", "size", "served", "source_size", "target", "budget",
                      F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("epoch"))
              .select("key", "place", "size", "epoch", "budget", finish.alias("finish"))
              .withColumn("step", F.floor(F.col("finish") * steps_a_unit)))
    copies = written(copies, "copies")

    # steps of finish time before the one in which the budget runs out are sent whole
    steps = copies.groupBy("step").agg(F.sum("size").alias("words"), F.max("budget").alias("budget"))
    running = steps.select("step", "budget", F.sum("words").over(W.orderBy("step")).alias("after"), "words")
    short = running.where(F.col("after") > F.col("budget")).agg(
        F.min("step").alias("step"), F.min(F.col("after") - F.col("words")).alias("before")).first()
    if short is None or short["step"] is None:
        sent = copies
    else:
        order = W.partitionBy("step").orderBy("finish", "key", "place", "epoch").rangeBetween(
            W.unboundedPreceding, W.currentRow)
        last = (copies.where(F.col("step") == short["step"])
                .withColumn("used", F.lit(short["before"]) + F.sum("size").over(order))
                .where(F.col("used") <= F.col("budget")).drop("used"))
        sent = copies.where(F.col("step") < short["step"]).union(last)
    ends = sent.groupBy("key").agg(F.max(F.struct("epoch", "place")).alias("last"))
    return written(goals.join(ends, "key", "left").select("key", "source_size", "target", "last"), "cuts")


def copies_of(place_: Column) -> Column:
    """How often a document is sent, given its source's ``last``."""
    this_time = F.when(place_ <= F.col("last.place"), 1).otherwise(0)
    return F.coalesce(F.col("last.epoch") + this_time, F.lit(0)).cast("int")


def _repeated(rows: DataFrame) -> DataFrame:
    """Places of a source that several rows share, as ``digest``; written."""
    return written(rows.groupBy("key", "place").count().where("count > 1").select(F.concat("key", "place").alias("digest")), "repeated")


def _told_apart(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with a place of its own for every row: the n-th of equal rows stands at a hash of place and n.

    Rows are numbered inside the task that reads them, behind a running sum of the tasks' counts, so no
    task sees all rows that are equal.
    """
    if repeated.isEmpty():
        return rows
    flagged = may_repeat(rows.withColumn("digest", F.concat("key", "place")), repeated).drop("digest")
    some = written(flagged.where("may_repeat").withColumn("task", F.spark_partition_id())
                   .withColumn("at", F.monotonically_increasing_id()), "equal")
    per_task = some.groupBy("key", "place", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("key", "place").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    before = per_task.select("key", "place", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    nth = F.col("before") + F.row_number().over(W.partitionBy("key", "place", "task").orderBy("at"))
    own = F.when(F.col("nth") == 1, F.col("place")).otherwise(F.md5(F.concat("place", F.lit(":"), F.col("nth").cast("string")).cast("binary")))
    numbered = some.join(before, ["key", "place", "task"]).withColumn("nth", nth).withColumn("place", own)
    return flagged.where("not may_repeat").select(rows.columns).union(numbered.select(rows.columns))


def schedule(docs: DataFrame, weights: tuple[int, ...], share: float, repeats: int,
             doc_id: str = "doc_id", text: str = "text", source: str = "source",
             range_rows: int = RANGE_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with ``key``, ``size``, ``place``; the sources with target and last copy; places of equal rows)."""
    sized = written(docs.select(F.col(doc_id).alias("doc_id"), source_key(source).alias("key"), words(text).alias("size"),
                                place(doc_id, text).alias("place")), "sized")
    repeated = _repeated(sized)
    if not repeated.isEmpty():
        sized = written(_told_apart(sized, repeated), "sized")
    return sized, cuts(sized, weights, share, repeats, range_rows), repeated


def report(docs: DataFrame, weights: tuple[int, ...], share: float, repeats: int, **columns) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's), taken (words, repeats counted)."""
    sized, sources, _ = schedule(docs, weights, share, repeats, **columns)
    return sized.join(sources, "key").select(
        "doc_id", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
        (F.col("size") * copies_of(F.col("place"))).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...], share: float, repeats: int,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed documents, all columns: a document sent twice is there twice, one not sent is gone."""
    _, sources, repeated = schedule(docs, weights, share, repeats, doc_id, text, source)
    keyed = _told_apart(docs.select(F.struct(*docs.columns).alias("doc"), source_key(source).alias("key"),
                                    place(doc_id, text).alias("place")), repeated)
    sent = keyed.join(sources, "key").select("doc", copies_of(F.col("place")).alias("copies"))
    return (sent.where(F.col("copies") > 0)
            .select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*"))
