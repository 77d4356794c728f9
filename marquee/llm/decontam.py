"""Benchmark decontamination by a prefix-filtered containment join.

Items are cut into item-sized windows of ``width`` words. Words are ordered by
rarity, counted over all documents. Containment has to be whole, so the
necessary prefix of a window is its rarest word alone: only documents' words
that are the rarest one of some window are joined. The place of that word in
the window fixes where an occurrence would begin (positional bound), the
document has to hold as many words from there on (length bound), and the words
are compared exactly.

The windows are sent to every task, in blocks of at most ``block_windows``
windows each; a larger benchmark means more blocks, each against all documents.

Defined results: null and word-free texts have no words and no hits; an item
without words has no window; items with equal item_id are one item, items with
a null item_id are left out; equal windows of different items count for each of
them; repeated rows and rows that share a doc_id are judged by their own text;
an empty benchmark leaves everything clean; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import materialise

WIDTH = 10
BLOCK_WINDOWS = 50_000
# Fixed value: what parts words once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text, in order; null has none."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def windows_of(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(words, item_id): the distinct windows of every item."""
    items = (benchmark.where("item_id is not null")
             .select("item_id", words_of(F.col("text")).alias("all")).where("size(`all`) > 0"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - width + 1, F.lit(1)))
    return (items.select("item_id", "all", F.explode(starts).alias("at"))
            .select("item_id", F.slice("all", F.col("at"), width).alias("words")).distinct())


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, a digest that tells texts of the same id apart, and the words."""
    return docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
                       .alias("digest"), words_of(F.col("text")).alias("words"))


def _anchored(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """(token, at, words, items): each distinct window under its rarest word."""
    distinct = windows.groupBy("words").agg(F.collect_set("item_id").alias("items"))
    vocabulary = distinct.select(F.explode("words").alias("token")).distinct()
    spread = (_identified(docs).select(F.explode(F.array_distinct("words")).alias("token"))
              .join(F.broadcast(vocabulary), "token").groupBy("token").agg(F.count("*").alias("df")))
    placed = distinct.select("words", "items", F.posexplode("words").alias("at", "token"))
    counted = placed.join(F.broadcast(spread), "token", "left")
    rarest = F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token", "at"))
    return (counted.groupBy("words").agg(rarest.alias("rare"), F.first("items").alias("items"))
            .select("rare.token", "rare.at", "words", "items"))


def occurrences(docs: DataFrame, anchored: DataFrame) -> DataFrame:
    """(doc_id, digest, start, end, items) of every window occurrence."""
    probes = anchored.groupBy("token").agg(
        F.collect_list(F.struct("at", F.size("words").alias("n"), "words", "items")).alias("cases"))
    found = (_identified(docs)
             .select("doc_id", "digest", "words", F.posexplode("words").alias("pos", "token"))
             .join(F.broadcast(probes), "token")
             .select("doc_id", "digest", "words", "pos", F.explode("cases").alias("case")))
    start = F.col("pos") - F.col("case.at")
    return (found.where((start >= 0) & (start + F.col("case.n") <= F.size("words")))
            .where(F.slice("words", F.greatest(start + 1, F.lit(1)), F.col("case.n"))
                   == F.col("case.words"))
            .select("doc_id", "digest", start.alias("start"),
                    (start + F.col("case.n")).alias("end"), F.col("case.items").alias("items")))


def _covered(spans: Column) -> Column:
    """Number of places inside the union of sorted (start, end) spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        spans, zero,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["end"] - F.greatest(x["start"], s["upto"]), F.lit(0))).alias("n"),
            F.greatest(s["upto"], x["end"]).alias("upto")),
        lambda s: s["n"])


def hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
         block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, digest, n_hit, items) of the documents with an occurrence."""
    windows = materialise(windows_of(benchmark, width))
    blocks = max(1, -(-windows.count() // block_windows))
    found = None
    for block in range(blocks):
        mine = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block)
        anchored = materialise(_anchored(mine, docs))
        some = occurrences(docs, anchored)
        found = some if found is None else found.union(some)
    distinct = found.distinct()
    return distinct.groupBy("doc_id", "digest").agg(
        _covered(F.sort_array(F.collect_set(F.struct("start", "end")))).cast("long").alias("n_hit"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def judged(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (ids sorted as strings)."""
    marks = hits(docs, benchmark, width).select(
        F.col("doc_id").alias("id"), F.col("digest").alias("mark"), "n_hit",
        F.array_sort(F.transform("items", lambda i: i.cast("string"))).alias("items"))
    all_docs = _identified(docs).select("doc_id", "digest", F.size("words").alias("n_words"))
    return (all_docs.join(marks, F.col("doc_id").eqNullSafe(F.col("id"))
                          & (F.col("digest") == F.col("mark")), "left")
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows of ``docs`` without any benchmark window, columns as they were."""
    marks = hits(docs, benchmark, width).select(F.col("doc_id").alias("__id"),
                                                F.col("digest").alias("__mark"))
    digest = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(marks, docs["doc_id"].eqNullSafe(F.col("__id")) & (digest == F.col("__mark")),
                     "left_anti")
