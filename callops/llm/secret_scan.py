"""Secret scan: fixed patterns, and a battery of randomness tests for other long tokens.

Base spans are the matches of three patterns. Tokens beyond them are runs of 20 and more characters of
``[A-Za-z0-9+/_-]``, and the pieces of that length into which a run falls when it is cut at some of
``+/_-``: a key may have these characters, or a path or a prefix before it. Those in one of the inferred
encodings, but for letters of one case alone, are tested for what a generated key must look like: chi-squared
uniformity over the encoding's alphabet, runs above and below its middle, and serial correlation of
neighbours. The three p-values are combined by Bonferroni; within each class of lengths the
Benjamini-Hochberg rule at level ``rate`` over all tokens of the corpus tells which are not random.
The others are added as spans of kind ``random``, unless they touch a base span or lie in one of their kind.

All of it is built-in functions: the tokens of a document are rows, with one expression for every
encoding's statistics. Ranks of p-values come from a histogram per length class with at
most ``BINS`` bins, p-values rounded up to a bin's edge, of which the
driver receives one number.

Defined results: null and empty texts have no spans; rows repeated are scanned each; positions count
code points; columns other than the named ones are not carried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from callops.llm.common import text_of, written

#: Fixed values of the contract: kind, pattern, the group that is measured, its least length.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so shorter ones need not be matched and dropped
)
#: A token starts where no such character stands before it.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: What a run is cut at, one way after the other: the rest of ``+/_-`` stays in the pieces.
CUTS = ("/", "/_", "/-", "_-", "+/_-")
NAMES = [kind for kind, *_ in KINDS] + ["random"]
#: Alphabets in order of value, and the pattern by which one is inferred; the first that fits counts.
#: Dashes that are not in the alphabet part groups and have no value.
UPPER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (
    (r"^(?=.*[a-f])[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^(?=.*[A-F])[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^(?=.*[A-Z])[A-Z2-7]+$", UPPER + "234567"),
    (r"^(?=.*[a-z])[a-z0-9]+$", DIGITS + UPPER.lower()),
    (r"^(?=.*[A-Z])[A-Z0-9]+$", DIGITS + UPPER),
    (r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", UPPER + UPPER.lower() + DIGITS),
    (r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$", UPPER + UPPER.lower() + DIGITS + "+/"),
    (r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$", UPPER + UPPER.lower() + DIGITS + "-_"),
    (r"^(?=.*[a-f])(?=.*-)(?!-)(?!.*--)(?!.*-$)[0-9a-f-]+$", DIGITS + "abcdef"),
    (r"^(?=.*[A-F])(?=.*-)(?!-)(?!.*--)(?!.*-$)[0-9A-F-]+$", DIGITS + "ABCDEF"),
    (r"^(?=.*[a-z])[a-z0-9_-]+$", DIGITS + UPPER.lower() + "-_"),
    (r"^(?=.*[A-Z])[A-Z0-9_-]+$", DIGITS + UPPER + "-_"),
)
#: A hundredth of a decimal power of the p-value a bin.
BINS = 3000
RATE = 0.05
_BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _sum(numbers: Column, kind: str = "long") -> Column:
    return F.aggregate(numbers, F.lit(0).cast(kind), lambda a, x: a + x)


def _starts(steps: Column) -> Column:
    """Running sums of an array: sums of blocks, then sums inside a block, so long arrays stay cheap."""

    def inside(bases: Column) -> Column:
        return F.transform(steps, lambda _, i: bases[F.floor(i / _BLOCK).cast("int")] + _sum(
            F.slice(steps, (F.floor(i / _BLOCK) * _BLOCK + 1).cast("int"), (i % _BLOCK + 1).cast("int"))))

    def bases(blocks: Column) -> Column:
        return F.transform(blocks, lambda _, b: _sum(F.slice(blocks, F.lit(1), b)))

    number = F.floor((F.size(steps) - 1) / _BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), number), lambda b: _sum(F.slice(steps, (b * _BLOCK + 1).cast("int"), F.lit(_BLOCK))))
    return _let(_let(blocks, bases), inside)


def _matches(text: Column, pattern: str, group: int) -> Column:
    """(start, end, found, measured) of each leftmost non-overlapping match, in code points.

    What lies between the matches and the matches themselves add up to the positions.
    """
    regex = F.lit(pattern)

    def located(found: Column) -> Column:
        def of(gaps: Column) -> Column:
            steps = F.transform(found, lambda _, i: (F.length(gaps[i]) + F.when(i > 0, F.length(found[i - 1])).otherwise(0)).cast("long"))
            return _let(_let(steps, _starts), lambda starts: F.transform(found, lambda m, i: F.struct(
                starts[i].alias("start"), (starts[i] + F.length(m)).alias("end"), m.alias("found"))))

        return _let(F.split(text, pattern, -1), of)

    spans = _let(F.regexp_extract_all(text, regex, F.lit(0)), located)
    if group:
        spans = F.zip_with(spans, F.regexp_extract_all(text, regex, F.lit(group)), lambda s, g: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"), g.alias("measured")))
    else:
        spans = F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"), s["found"].alias("measured")))
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,found:string,measured:string>>")
    return F.when(text.rlike(pattern), spans).otherwise(nothing)


def base_spans(text: Column) -> Column:
    """Matches of the fixed patterns as (start, kind, end), in order; kind is the place in KINDS."""
    kinds = []
    for number, (_, pattern, group, least) in enumerate(KINDS):
        long_enough = F.filter(_matches(text, pattern, group), lambda s: F.length(s["measured"]) >= least)
        kinds.append(F.transform(long_enough, lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"))))
    return F.sort_array(F.concat(*kinds))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by a rational approximation (error below 2e-7, cut at 0)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + 0.3275911 * x)
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = 0.5 * series * F.exp(-x * x)
    return F.when(z >= 0, tail).otherwise(1.0 - tail)


def p_values(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``p``, the combined p-value of the battery for the characters of ``found``; others in no encoding go."""
    alphabet = F.lit(None).cast("string")
    for pattern, letters in reversed(ENCODINGS):
        alphabet = F.when(F.col("found").rlike(pattern), letters).otherwise(alphabet)
    valued = F.when(F.contains("alphabet", F.lit("-")), F.col("found")).otherwise(F.translate("found", "-", ""))
    values = F.transform(F.filter(F.split(valued, ""), lambda c: c != ""), lambda c: F.call_function("instr", F.col("alphabet"), c) - 1)
    v, n, k, mean = F.col("values"), F.col("n"), F.col("k"), F.col("mean")
    told = (tokens.withColumn("alphabet", alphabet).where("alphabet is not null").withColumn("values", values)
            .withColumn("n", F.size("values").cast("double")).withColumn("k", F.length("alphabet").cast("double"))
            .withColumn("mean", (k - 1) / 2))

    # one value's share of the alphabet: the Wilson-Hilferty approximation of chi-squared
    counts = F.transform(F.array_distinct(v), lambda c: F.size(F.filter(v, lambda x: x == c)).cast("double"))
    chi, df = _sum(F.transform(counts, lambda c: c * c), "double") * k / n - n, k - 1
    uniform = _upper_tail((F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
    # neighbours: products of distances from the mean, changes between the halves of the alphabet
    pairs = F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda a, b: F.struct(
        ((a - mean) * (b - mean)).alias("product"), ((a < k / 2) != (b < k / 2)).alias("turn")))
    told = told.withColumn("uniform", uniform).withColumn("pairs", pairs)
    correlation = _sum(F.col("pairs.product"), "double") / (F.sqrt(n - 1) * ((k * k - 1) / 12))
    told = (told.withColumn("serial", 2 * _upper_tail(F.abs(correlation)))
            .withColumn("runs", F.size(F.filter(F.col("pairs.turn"), lambda x: x)) + 1.0)
            .withColumn("high", F.size(F.filter(v, lambda x: x >= k / 2)).cast("double"))
            .withColumn("expected", 2 * F.col("high") * (n - F.col("high")) / n + 1))
    expected = F.col("expected")
    told = told.withColumn("spread", F.sqrt((expected - 1) * (expected - 2) / (n - 1)))
    # all on one side: as unlikely as so many equal throws of a coin
    runs = F.when(F.col("spread") > 0, 2 * _upper_tail(F.abs(F.col("runs") - expected) / F.when(F.col("spread") > 0, F.col("spread")))).otherwise(
        F.pow(F.lit(2.0), 1 - n))
    p = F.least(F.lit(1.0), 3 * F.least("uniform", "serial", runs))
    return told.select(*tokens.columns, p.alias("p"))


def _bin(p: Column) -> Column:
    return F.least(F.lit(BINS), F.floor(-100 * F.log10(F.greatest(p, F.lit(1e-300))))).cast("int")


def _tokens(text: Column) -> Column:
    """(start, end, found) of the runs and of their pieces, each once, in order."""

    def pieces(run: Column) -> Column:
        def after(cut: Column) -> Column:
            def located(parts: Column) -> Column:
                steps = F.transform(parts, lambda _, i: F.when(i > 0, F.length(parts[i - 1]) + 1).otherwise(0).cast("long"))
                return _let(_let(steps, _starts), lambda starts: F.transform(parts, lambda m, i: F.struct(
                    (run["start"] + starts[i]).alias("start"), (run["start"] + starts[i] + F.length(m)).alias("end"), m.alias("found"))))

            # a run has no blanks, so they may stand for what it is cut at
            parts = F.split(F.call_function("translate", run["found"], cut, F.lit(" " * 4)), " ", -1)
            return F.filter(_let(parts, located), lambda s: F.length(s["found"]) >= 20)

        cuts = F.array(*map(F.lit, ("", *CUTS)))
        return F.flatten(F.transform(F.when(run["found"].rlike("[+/_-]"), cuts).otherwise(F.array(F.lit(""))), after))

    return F.sort_array(F.array_distinct(F.flatten(F.transform(_matches(text, TOKEN, 0), pieces))))


def _mixed(token: Column) -> Column:
    """Not letters of one case alone, which are not tested: words would pass too often."""
    return token.rlike("[0-9]") | (token.rlike("[a-z]") & token.rlike("[A-Z]"))


def not_random(tokens: DataFrame, rate: float) -> dict[int, int]:
    """Length class → least bin whose tokens are not random, by the Benjamini-Hochberg rule per class.

    ``tokens``: one row per token, class and bin. Classes are powers of two of a length, at most 31.
    """
    counted = tokens.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n"))
    by_class = W.partitionBy("class")
    smaller = F.sum("n").over(by_class.orderBy(F.desc("bin")))  # tokens with this p-value or a smaller one
    edge = F.pow(F.lit(10.0), -F.col("bin") / 100)
    rejected = (counted.select("class", "bin", smaller.alias("smaller"), F.sum("n").over(by_class).alias("all"))
                .where(edge <= rate * F.col("smaller") / F.col("all")))
    return {row["class"]: row["bin"] for row in rejected.groupBy("class").agg(F.min("bin").alias("bin")).collect()}


def _outermost(spans: Column) -> Column:
    """The spans (start, kind, end) that lie in no other of them; each is there once."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s.alias("span"))))
    nothing = F.struct(F.lit(0).cast("long").alias("top"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>").alias("kept"))

    def add(a: Column, x: Column) -> Column:
        return F.when(x["span"]["end"] <= a["top"], a).otherwise(F.struct(
            x["span"]["end"].alias("top"), F.concat(a["kept"], F.array(x["span"])).alias("kept")))

    return F.when(F.size(spans) < 2, spans).otherwise(F.aggregate(ordered, nothing, add, lambda a: a["kept"]))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    whole = text_of(text)
    found = written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), base_spans(whole).alias("base"),
                                F.filter(_tokens(whole), lambda s: _mixed(s["found"])).alias("tokens")), "spans")
    length = (F.col("end") - F.col("start")).cast("double")
    tested = written(p_values(found.select("row", F.inline("tokens"))).select(
        "row", "start", "end", F.floor(F.log2(length)).cast("int").alias("class"), _bin(F.col("p")).alias("bin")), "tested")
    limits = not_random(tested.select("class", "bin"), rate)
    table = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]) if limits else F.lit(None).cast("map<int,int>")
    random = tested.where(F.col("bin") < F.coalesce(table[F.col("class")], F.lit(BINS + 1))).groupBy("row").agg(
        F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")).alias("random"))  # of one document

    def apart(s: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    told = found.select("row", "doc_id", "base").join(random, "row", "left").withColumn(
        "added", F.filter(F.coalesce("random", nothing), apart))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")
              for number, (kind, *_) in enumerate(KINDS)]
    return told.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                       _joined(F.sort_array(F.concat("base", _outermost(F.col("added"))))).alias("spans"))
