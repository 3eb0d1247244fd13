"""URL filters: rules by host and path, and link-graph propagation of trust for everything else.

Pages that a rule allows make their host a trusted seed, pages that a rule blocks a blocked seed,
each with as much mass as it has such pages. Personalised PageRank carries trust along the links
between hosts; distrust flows against them, from a blocked host to those that link to it. A host is
blocked where distrust exceeds trust by more than ``threshold`` of its pages, and its pages without
a rule get its verdict.

All of it is built-in functions. Links are counted per pair of hosts before any shuffle, so a host
with a third of all pages has one row per linked host. Every few rounds the scores are written to the
shared folder, and the walk ends when all that later rounds could add to any host, the mass on its way
times damping / (1 - damping), is less than ``TOLERANCE``.

Defined results: a null url, or one without ``://``, has an empty host and path; pages without a rule
and with an empty or unlinked, unseeded host are allowed; null html has no links; rows repeated are
judged each and count as pages each; columns other than the named ones are not carried.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from callops.llm.common import text_of, written

#: ``ROUNDS`` is how far the SQL beside the query walks; ``judge`` goes on until nothing is missing.
DAMPING, ROUNDS, ROUNDS_A_WRITE, THRESHOLD = 0.85, 12, 4, 0.5
#: Pages' worth of trust or distrust that no host misses more of; a host is blocked from half a page on.
TOLERANCE = 1e-6
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Absolute and scheme-relative targets of links.
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""

Rule = tuple[str, str, str]  # host, path, verdict


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, _URL, 1), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule as host + path, verdict) of the longest rule that fits, null without one.

    Rules are a list of the configuration; of two equally long ones the longer host wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for at, under, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        rule, verdict = F.when(fits, at + under).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, links): how often pages of one host link to another."""
    found = pages.select(F.col("host").alias("source"), F.explode(
        F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("target"))
    found = found.withColumn("target", F.translate("target", UPPER, UPPER.lower()))
    return (found.where((F.col("source") != "") & (F.col("target") != F.col("source")))
            .groupBy("source", "target").agg(F.count(F.lit(1)).alias("links")))


def propagate(seeds: DataFrame, links: DataFrame, damping: float, rounds: int | None) -> DataFrame:
    """(kind, host, score): the seeds' mass summed over all paths of up to ``rounds`` links, damped per link.

    ``links`` has source, target and links; kind ``trust`` follows them, ``distrust`` goes back. Without
    ``rounds`` paths of any length count, until what is missing of either kind is under ``TOLERANCE``.
    """
    if rounds is None and not 0 <= damping < 1:
        raise ValueError("without a damping below 1 the walk does not end")
    onward = links.select(F.lit("trust").alias("kind"), "source", "target", "links")
    back = links.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "links")
    steps = onward.union(back)
    out = steps.groupBy("kind", "source").agg(F.sum("links").alias("out"))
    steps = written(steps.join(out, ["kind", "source"]).select(
        "kind", F.col("source").alias("host"), "target", (F.col("links") / F.col("out")).alias("share")), "steps")
    terms = [written(seeds, "seeds")]
    wave, number = terms[0], 0
    while rounds is None or number < rounds:
        number += 1
        wave = (wave.join(steps, ["kind", "host"])
                .groupBy("kind", F.col("target").alias("host"))
                .agg((F.lit(damping) * F.sum(F.col("score") * F.col("share"))).alias("score")))
        if number % ROUNDS_A_WRITE == 0:
            wave = written(wave, "wave")
        terms.append(wave)
        if number % ROUNDS_A_WRITE == 0 and rounds is None:
            mass = wave.groupBy("kind").agg(F.sum("score").alias("mass")).agg(F.max("mass")).first()[0] or 0.0
            if mass * damping / (1 - damping) < TOLERANCE:
                break
            terms = [written(_summed(terms), "scores")]  # so that the plan does not grow with the rounds
    return _summed(terms)


def _summed(terms: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, terms).groupBy("kind", "host").agg(F.sum("score").alias("score"))


def judge(pages: DataFrame, rules: list[Rule], damping: float = DAMPING, rounds: int | None = None, threshold: float = THRESHOLD,
          page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict."""
    address = text_of(url)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    told = (pages.select(F.col(page_id).alias("page_id"), host_of(address).alias("host"), path_of(address).alias("path"),
                         text_of(html).alias("html"))
            .withColumns({"rule": rule, "by_rule": verdict}))
    links = written(host_links(told), "links")
    sums = written(told.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count(F.when(F.col("by_rule") == "allow", 1)).alias("trust"),
        F.count(F.when(F.col("by_rule") == "block", 1)).alias("distrust")), "hosts")
    seeds = (sums.where(F.col("host") != "")
             .select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "score"))
             .where(F.col("score") > 0).select("kind", "host", F.col("score").cast("double").alias("score")))
    scores = propagate(seeds, links, damping, rounds)
    surplus = F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(-F.col("score")))
    blocked = (scores.groupBy("host").agg(surplus.alias("surplus")).join(sums, "host")
               .where(F.col("surplus") > threshold * F.col("pages")).select("host", F.lit(True).alias("blocked")))
    judged = told.drop("html").join(written(blocked, "blocked"), "host", "left")
    by_host = F.when(F.col("blocked"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict"))
