"""Repeated runs of lines, found by winnowing over line hashes.

Lines that hold a word are numbered within their document. Of every ``run``
consecutive ones the first of the least line hashes is the window's minimum, and the
minima of a document are its fingerprints: two equal runs always share one. A line of
more than ``long_line`` words is a fingerprint of its own, which guarantees itself.
Positions are joined on recurring fingerprints, and a recurring one is extended both
ways, line by line, over the windows it is the minimum of; longer matches are made of
neighbouring ones. A run stays where it occurs first, by doc_id, then place; the lines
of every later one are deleted. Runs are judged on the input, not on what is left.

Nothing is paired: each distinct run is reduced to its first place before the
shuffle, and later places are compared with that one row. Runs of a very common
line are spread by their digests, and the join splits skewed keys. Texts are read
twice, once for the fingerprints, which are written, and once to cut the lines out.

Defined results: null text has no lines; lines without a word are kept and
never match; documents with fewer such lines than ``run`` keep everything but repeated
long lines; a
null doc_id comes before all others; rows that share a doc_id come in the order
of a digest of their texts, and rows that are equal in both are one document,
each keeping the same lines; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import SPACE
from marquee.session import materialise

RUN = 2
LONG_LINE = 20
_HAS_WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(text.cast("string"), "\n", -1)


def _digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, run: int = RUN, long_line: int | None = LONG_LINE) -> DataFrame:
    """(fingerprint, doc_id, digest, at, windows): window minima, each with the runs it stands for.

    A run is (start, lines, run_digest): its first line's number, the indexes of its
    lines in the text, and a digest of the lines themselves.
    """
    worded = F.filter(F.transform(_lines(F.col("text")), lambda l, i: F.struct(
        i.alias("at"), l.alias("line"), F.xxhash64(l).alias("h"))),
        lambda x: x["line"].rlike(_HAS_WORD))
    rows = docs.select("doc_id", _digest(F.col("text")).alias("digest"), worded.alias("worded"))

    def window(start: Column, size: int) -> Column:
        some = F.slice("worded", start, size)
        return F.struct(start.alias("start"), some["at"].alias("lines"),
                        F.unhex(F.md5(F.array_join(some["line"], "\n"))).alias("run_digest"))

    def least(start: Column) -> Column:
        some = F.slice("worded", start, run)["h"]
        return (start + F.array_position(some, F.array_min(some)) - 1).cast("int")

    # Too few lines give no window; a filter would work the lines out a second time.
    size = F.size("worded")
    starts = F.when(size >= run, F.sequence(F.lit(1), size - run + 1)).otherwise(F.array().cast("array<int>"))
    rows = rows.select("*", F.transform(starts, least).alias("minima"))

    def of_minimum(at: Column) -> Column:
        around = F.sequence(F.greatest(F.lit(1), at - run + 1), F.least(at, size - run + 1))
        mine = F.filter(around, lambda s: F.get("minima", s - 1) == at)
        return F.struct(at.alias("at"), F.transform(mine, lambda s: window(s, run)).alias("windows"))

    found = F.transform(F.array_distinct("minima"), of_minimum)
    if long_line is not None:
        words = lambda l: F.size(F.filter(F.split(l, SPACE), lambda w: w != ""))
        places = F.filter(F.transform("worded", lambda x, i: F.when(
            words(x["line"]) > long_line, i + 1)), lambda at: at.isNotNull())
        found = F.concat(found, F.transform(places, lambda at: F.struct(
            at.alias("at"), F.array(window(at, 1)).alias("windows"))))
    return rows.select("doc_id", "digest", "worded", F.explode(found).alias("f")).select(
        F.get("worded", F.col("f.at") - 1)["h"].alias("fingerprint"), "doc_id", "digest", "f.at", "f.windows")


def repeated_lines(docs: DataFrame, run: int = RUN, long_line: int | None = LONG_LINE) -> DataFrame:
    """(doc_id, digest, lines, starts): the line indexes to delete of each document that has any."""
    places = materialise(fingerprints(docs, run, long_line))
    place = F.struct("doc_id", "digest", "at")
    # Written, so that the join below is one of two plain shuffles, whose skewed
    # partitions can be split.
    recurring = materialise(
        places.groupBy("fingerprint").agg(F.min(place).alias("a"), F.max(place).alias("b"))
        .where("a != b").select("fingerprint"))
    runs = materialise(
        places.join(recurring, "fingerprint", "left_semi")
        .select("doc_id", "digest", F.inline("windows"))
        .select("run_digest", F.struct("doc_id", "digest", "start").alias("place"), "lines"))
    # Written as well, so that the runs of a very common line can be split in this join too.
    first = materialise(
        runs.groupBy("run_digest").agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .where("first != last").select("run_digest", "first"))
    later = (runs.join(first, "run_digest").where(F.col("place") > F.col("first"))
             .select("place.doc_id", "place.digest", "place.start", "lines"))
    return later.groupBy("doc_id", "digest").agg(
        F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"),
        F.sort_array(F.collect_set("start")).alias("starts"))


def deduplicated(docs: DataFrame, run: int = RUN, long_line: int | None = LONG_LINE) -> DataFrame:
    """``docs`` with repeated runs deleted from text; n_lines and removed_lines put behind.

    Input columns of those two names are replaced.
    """
    marks = repeated_lines(docs, run, long_line).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"),
        F.col("lines").alias("__lines"))
    joined = docs.withColumn("__own", _digest(F.col("text"))).join(
        marks, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__digest")),
        "left")
    lines = _lines(F.col("text"))
    # Hash-based difference of indexes, then the lines kept: linear in a text's lines.
    kept = F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__lines")),
        lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col("__lines").isNull(), F.col("text")).otherwise(kept)
    return joined.select(
        *(text.alias("text") if c == "text" else F.col(c) for c in docs.columns
          if c not in ("n_lines", "removed_lines")),
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("__lines"), F.lit(0)).alias("removed_lines"))
