"""URL verdicts: fixed rules first, then a path-template tree per host.

A url's path is cut into segments. Each segment is generalised: digits become
``{n}``, also inside a file name, and under one parent template more than
``wide`` different segments become ``{*}``. Templates are built level by level,
one level per pass over (host, template, segment) counts; below ``depth``
levels the rest of the path is one ``{**}``. Sibling branches of a host whose
labelled shares a two-proportion test cannot tell apart are merged with their
counts; a branch without labels cannot be told apart from its siblings.

The urls that a rule decides are the labels. A template's purity is its share of
allowed ones, smoothed along the tree: the share of all urls draws the share of the
same template over all hosts, this one the share of the host, this one the share of the
merged siblings, and this one the template's own, each by ``weight`` labels. So a
template without labels of its own is judged by what stands above it. It is
rejected where its purity falls below ``purity`` times the share of all urls.

Defined results: a null url or one without ``://`` has an empty host and path;
an empty host meets no rule; of equally long rules that fit, the blocking one
wins; repeated rows are judged each; without any labelled url everything is
allowed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import materialise

# Verdict, host, path of each rule.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    rest = F.when(F.col("url").contains("://"),
                  F.expr("substring(url, position('://', url) + 3)")).otherwise("")
    return (pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
            .select("page_id", rest.alias("rest"))
            .select("page_id", "rest", F.regexp_extract("rest", r"(?s)^([^/?#]*)", 1).alias("raw"))
            .select("page_id", F.translate("raw", _UPPER, _LOWER).alias("host"),
                    F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"),
                                     r"(?s)^([^?#]*)", 1).alias("path")))


def rule_of(host: Column, path: Column) -> Column:
    """(length, blocks, rule, verdict) of the longest rule that fits, else null."""
    def case(verdict: str, over: str, start: str) -> Column:
        fits = ((host == over) | host.endswith(f".{over}")) & path.startswith(start)
        name = over + start
        return F.when(fits, F.struct(
            F.lit(len(name)).alias("length"), F.lit(verdict == "block").alias("blocks"),
            F.lit(name).alias("rule"), F.lit(verdict).alias("verdict")))

    return F.greatest(*(case(*r) for r in RULES))


def _general(segment: Column) -> Column:
    return F.regexp_replace(segment, "[0-9]+", "{n}")


def _label_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("urls", "good", "bad")]


def templates(parted: DataFrame, depth: int = 6, wide: int = 50) -> DataFrame:
    """``parted`` (host, path, urls, good, bad) with ``template``, level by level."""
    segments = F.split(F.regexp_replace("path", "^/", ""), "/", -1)
    now = materialise(parted.withColumn("segments", segments).withColumn("template", F.lit("")))
    deepest = now.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(min(depth, deepest)):
        cut = now.withColumn("segment", _general(F.get("segments", F.lit(level))))
        many = (cut.where("segment is not null").select("host", "template", "segment").distinct()
                .groupBy("host", "template").agg(F.count("*").alias("fan"))
                .where(F.col("fan") > wide).select("host", "template", F.lit(True).alias("many")))
        step = F.when(F.col("many"), F.lit("{*}")).otherwise(F.col("segment"))
        now = materialise(cut.join(many, ["host", "template"], "left").withColumn(
            "template", F.when(F.col("segment").isNull(), F.col("template"))
            .otherwise(F.concat("template", F.lit("/"), step))).drop("many", "segment"))
    return now.withColumn("template", F.when(F.size("segments") > depth, F.concat(
        "template", F.lit("/{**}"))).otherwise(F.col("template"))).drop("segments")


def _branch() -> Column:
    """A template with its variable leaves taken out of sight: what siblings share."""
    return F.regexp_replace("template", r"^/[^/]*", "/{+}")


def merged(counts: DataFrame, z: float = 1.96) -> DataFrame:
    """(host, template, good, bad, pool_good, pool_bad): own labels, and those of the
    similar sibling branches.

    Siblings of a host differ only in their first segment. Each is compared
    with the pool of all of them: a two-proportion test below ``z`` merges it
    into the pool of those that look alike. One that does not look alike is its own pool.
    """
    sides = counts.withColumn("branch", _branch())
    pool = sides.groupBy("host", "branch").agg(
        F.sum("good").alias("pool_good"), F.sum("bad").alias("pool_bad"))
    held = sides.join(pool, ["host", "branch"])
    n, m = F.col("good") + F.col("bad"), F.col("pool_good") + F.col("pool_bad")
    share = F.col("pool_good") / F.greatest(m, F.lit(1))
    gap = F.abs(F.col("good") / F.greatest(n, F.lit(1)) - share)
    error = F.sqrt(share * (1 - share) / F.greatest(n, F.lit(1)))
    held = held.withColumn("alike", (n == 0) | (gap <= z * error))
    group = held.where("alike").groupBy("host", "branch").agg(
        F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
    return (held.join(group, ["host", "branch"], "left")
            .select("host", "template", "good", "bad",
                    F.when(F.col("alike"), F.col("all_good")).otherwise(F.col("good")).alias("pool_good"),
                    F.when(F.col("alike"), F.col("all_bad")).otherwise(F.col("bad")).alias("pool_bad")))


def _drawn(good: Column | str, bad: Column | str, towards: Column, weight: float) -> Column:
    """Share of good labels, drawn towards another share by ``weight`` labels."""
    good, bad = F.coalesce(good, F.lit(0)), F.coalesce(bad, F.lit(0))
    return (good + weight * towards) / (good + bad + weight)


def purities(placed: DataFrame, prior: float, weight: float) -> DataFrame:
    """(host, template, purity) of every template of ``placed``, which is written."""
    tallies = merged(placed.groupBy("host", "template").agg(*_label_sums()))
    everywhere = placed.groupBy("template").agg(
        F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
    hosts = placed.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("bad").alias("host_bad"))
    over = _drawn("all_good", "all_bad", F.lit(prior), weight)
    return (tallies.join(everywhere, "template").join(hosts, "host")
            .withColumn("over", over)
            .withColumn("host_share", _drawn("host_good", "host_bad", F.col("over"), weight))
            .withColumn("pool_share", _drawn("pool_good", "pool_bad", F.col("host_share"), weight))
            .select("host", "template", _drawn("good", "bad", F.col("pool_share"), weight).alias("purity")))


def judged(pages: DataFrame, depth: int = 6, wide: int = 50, weight: float = 20.0,
           purity: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, template and its purity."""
    parted = with_parts(pages).withColumn("fit", rule_of(F.col("host"), F.col("path")))
    # The tree is built on distinct paths with counts, not on every page.
    counted = materialise(parted.groupBy("host", "path", F.col("fit.verdict").alias("label")).agg(
        F.count("*").alias("urls")).select(
        "host", "path", "urls",
        F.when(F.col("label") == "allow", F.col("urls")).otherwise(0).alias("good"),
        F.when(F.col("label") == "block", F.col("urls")).otherwise(0).alias("bad")))
    placed = materialise(templates(counted, depth, wide))
    overall = placed.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).select(
        (F.coalesce("g", F.lit(0)) + 1.0).alias("g"), (F.coalesce("b", F.lit(0)) + 1.0).alias("b")).first()
    prior = overall.g / (overall.g + overall.b)
    marks = placed.select("host", "path", "template").join(
        purities(placed, prior, weight), ["host", "template"])
    return (parted.join(marks, ["host", "path"])
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce(F.col("fit.verdict"), F.when(F.col("purity") < purity * prior, F.lit("block"))
                               .otherwise(F.lit("allow"))).alias("verdict"), "template", "purity"))
