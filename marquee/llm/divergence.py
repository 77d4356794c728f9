"""How far the word use of sources lies apart, within each language.

A CountVectorizer with a least document frequency and no limit on its size counts
the terms of every language: a term carries its language, so that one model holds
the vocabularies of all of them, each judged by its own documents. Terms are dealt
by hash to slices, and a model is fitted per slice, so that the vocabulary on the
driver stays near ``slice_terms`` however many terms there are; the number of
slices comes from a sample of the documents and never changes a result.

The model reads folded documents: those of a task are counted first, and every count is
written as few documents. Its fit asks whether a term is in ``min_docs`` documents, so a
term goes to as many documents as it has in the task, ``min_docs`` at most: sums of counts
cut there reach ``min_docs`` just where those of the whole counts do. Its transform gets
a document per binary digit of the occurrences in a (language, source), with the digit's
weight, and the exact sparse vectors times their weights are summed.

Shares are whole billionths: p = 1 + floor(10^9 (n + 2) / (N + 2 V)), in decimal
arithmetic. The distance of two shares is floor((p - q)^2 / (p + q)). Pairs of
sources are evaluated on the sparse sums: terms that neither source has differ by
one constant, so only a term's own entries count, in blocks of terms and, where a
language has many sources, tiles of sources. No two rows of a term are joined.

Defined results: null text, lang and source count as empty; repeated rows are
documents of their own; a language whose terms are all rarer than ``min_docs`` has
no term rows and pair values of 0; a source that stands alone in its language has
no pair rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import materialise, small_batches, texts_of
from marquee.session import scratch_path

MIN_DOCS = 10
TOP_TERMS = 10
SLICE_TERMS = 2_000_000
BLOCK_ROWS = 400_000
TILE_SOURCES = 256
# Vector entries, and bytes of terms, that a task holds before it sums them up.
HELD_ENTRIES = 1_000_000
HELD_BYTES = 32 * 1024 * 1024
# Terms in a row of a folded document.
ROW_TERMS = 8_000
# Rows of sparse vectors or blocks that travel together, and rows of single sums.
VECTOR_ROWS = 128
SUM_ROWS = 65_536
# The vocabulary's size is estimated on one document in so many, by a hash of the text.
LOOK_AT_ONE_IN = 16
# Bytes of text that are cut side by side.
CUT_BYTES = 16 * 1024 * 1024
LARGEST_INT = 2**31 - 1
BILLION = 1_000_000_000
# A-Z as a-z, and the ASCII characters that are no letters, which part terms, as spaces.
_PLAIN = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalpha() else 32 if c < 128 else c for c in range(256))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of every text, each with the mark of its language behind it.

    Texts of one language are cut side by side, from the places of the spaces in them.
    """
    def rows(lang: str, mark: bytes, sources: list[str], texts: list[bytes]) -> pa.RecordBatch:
        words = b" ".join(t for t in texts if t)
        words += b" " if words else b""
        # A term's end: its space, and the marks up to it where there was one byte each.
        ends = np.flatnonzero(np.frombuffer(words, np.uint8) == 32) + 1
        ends += np.arange(1, len(ends) + 1) * (len(mark) - 1)
        terms = pa.StringArray.from_buffers(
            len(ends), pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(words.replace(b" ", mark)))
        sizes = [t.count(b" ") + 1 if t else 0 for t in texts]
        docs = pa.ListArray.from_arrays(np.cumsum([0] + sizes).astype(np.int32), terms)
        new = [k for k in range(len(texts)) if not k or sources[k] != sources[k - 1]]
        held = pa.ListArray.from_arrays(np.array(new + [len(texts)], np.int32), docs)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(new)), pa.array([sources[k] for k in new]), held], names=["lang", "source", "docs"])

    for part in parts:
        lang, source, mark = (c.to_pylist() for c in part.columns[:3])
        texts = [b" ".join(t.translate(_PLAIN).split()) for t in texts_of(part.column(3))]
        order = sorted(range(len(texts)), key=lambda k: (lang[k], source[k]))
        first = size = 0
        for n, k in enumerate(order, 1):
            size += len(texts[k])
            if n == len(order) or size >= CUT_BYTES or lang[order[n]] != lang[k]:
                own = order[first:n]
                yield rows(lang[k], mark[k].encode(), [source[i] for i in own], [texts[i] for i in own])
                first, size = n, 0


def _marked(docs: DataFrame) -> DataFrame:
    """lang, source, mark, text, ready for Python tasks.

    A mark is a space and the language itself where that is short and plain, else its bytes in hex.
    """
    small_batches(docs.sparkSession)
    mark = F.concat(F.lit(" "), F.when(F.col("lang").rlike("^[A-Za-z0-9]{1,8}$"), F.col("lang")).otherwise(
        F.concat(F.lit("#"), F.hex("lang"))))
    return (docs.select(_text("lang").alias("lang"), _text("source").alias("source"), _text("text").alias("text"))
            .select("lang", "source", mark.alias("mark"), "text"))


def with_terms(docs: DataFrame) -> DataFrame:
    """lang, source, docs: the terms of some documents, an array each, as often as they occur.

    A term is followed by the mark of its language.
    """
    return _marked(docs).mapInArrow(_cut, "lang string, source string, docs array<array<string>>")


def slices_for(docs: DataFrame, min_docs: int, slice_terms: int) -> int:
    """Number of slices that keep a vocabulary below about ``slice_terms`` terms.

    A term of ``min_docs`` documents is in a sample of one in n with a probability of
    1 - (1 - 1/n)^min_docs at least, so the sample's terms over that bound the kept ones.
    """
    sample = with_terms(docs.where(F.pmod(F.xxhash64(_text("text")), F.lit(LOOK_AT_ONE_IN)) == 0))
    seen = sample.select(F.explode(F.flatten("docs")).alias("term")).agg(F.approx_count_distinct("term")).first()[0]
    share = 1 - (1 - 1 / LOOK_AT_ONE_IN) ** min_docs
    return max(1, math.ceil(seen / share / slice_terms))


_FOLDED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("slice", pa.int32()), ("fit", pa.bool_()),
                     ("weight", pa.int64()), ("terms", pa.list_(pa.string()))])


def _narrow(values: np.ndarray) -> np.ndarray:
    """Integers from 0, in 32 bits where they fit."""
    return values.astype(np.uint32) if values.max(initial=0) < 2**32 else values


def _once(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and the sums of their counts; empties both lists."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    keys.clear()
    counts.clear()
    order = np.argsort(key)
    key, count = key[order], count[order]
    del order
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    return key[new], np.add.reduceat(count, new) if len(new) else count


def _folded(n_slices: int, min_docs: int):
    """Documents for the fit and the transform that count as a task's documents do."""
    def layer(terms: pa.Array, slices: np.ndarray, names: list[tuple[str, str]], group: np.ndarray,
              at: np.ndarray, weight: int | None) -> pa.RecordBatch:
        """Rows of one document per group and slice; without a weight, for the fit."""
        label = slices[at] * len(names) + group
        order = np.argsort(label, kind="stable")
        label = label[order]
        new = np.append(True, label[1:] != label[:-1])
        new[::ROW_TERMS] = True
        new = np.flatnonzero(new)
        own = [names[i] for i in label[new] % len(names)]
        rows = pa.ListArray.from_arrays(np.append(new, len(at)).astype(np.int32), terms.take(pa.array(at[order])))
        return pa.RecordBatch.from_arrays([
            pa.array([n[0] for n in own], pa.string()), pa.array([n[1] for n in own], pa.string()),
            pa.array((label[new] // len(names)).astype(np.int32)), pa.array([weight is None] * len(new)),
            pa.array([weight or 1] * len(new), pa.int64()), rows], schema=_FOLDED)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[tuple[str, str], int] = {}
        # Terms, of each the documents that have it, and occurrences by group and term.
        terms: list[pa.Array] = []
        seen: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        first = 0

        def settle() -> None:
            """Every term and key once, held as the first of the lists."""
            nonlocal first
            coded = pa.concat_arrays(terms).dictionary_encode()
            at = coded.indices.to_numpy().astype(np.int64)
            docs = np.bincount(at, np.concatenate(seen), len(coded.dictionary)).astype(np.int64)
            for key in keys:
                key += at[key & LARGEST_INT] - (key & LARGEST_INT)
            key, total = _once(keys, counts)
            terms[:], seen[:], keys[:], counts[:] = [coded.dictionary], [docs], [key], [total]
            first = len(coded.dictionary)

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal first
            own, docs, key, total = terms[0], np.minimum(seen[0], min_docs), keys[0], counts[0]
            slices = np.zeros(len(own), np.int64) if n_slices == 1 else np.array(
                [xxhash.xxh64_intdigest(t) % n_slices for t in own.to_pylist()], np.int64)
            for k in range(int(docs.max(initial=0))):
                at = np.flatnonzero(docs > k)
                yield layer(own, slices, [("", "")], np.zeros(len(at), np.int64), at, None)
            names = list(number)
            for digit in range(int(total.max(initial=0)).bit_length()):
                some = key[total >> digit & 1 > 0]
                if len(some):
                    yield layer(own, slices, names, some >> 31, some & LARGEST_INT, 1 << digit)
            for held in (terms, seen, keys, counts):
                held.clear()
            first = 0

        for part in _cut(parts):
            held = part.column(2)
            docs = held.flatten()
            coded = docs.flatten().dictionary_encode()
            size, at = len(coded.dictionary), coded.indices.to_numpy().astype(np.int64)
            if not size:
                continue
            some = np.array([number.setdefault(g, len(number)) for g in zip(
                part.column(0).to_pylist(), part.column(1).to_pylist())], np.int64)
            lengths = np.diff(docs.offsets.to_numpy())
            row = np.repeat(np.repeat(np.arange(len(some)), np.diff(held.offsets.to_numpy())), lengths)
            doc = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
            key, count = np.unique(_narrow(row * size + at), return_counts=True)
            key = key.astype(np.int64)
            terms.append(coded.dictionary)
            seen.append(np.bincount(np.unique(_narrow(doc * size + at)) % size, minlength=size))
            keys.append((some[key // size] << 31) + key % size + first)
            counts.append(count)
            first += size
            if sum(map(len, keys)) >= HELD_ENTRIES or sum(t.nbytes for t in terms) >= HELD_BYTES:
                settle()
                if len(keys[0]) >= HELD_ENTRIES // 2 or terms[0].nbytes >= HELD_BYTES // 2:
                    yield from rows()
        if terms:
            settle()
            yield from rows()

    return run


# Sums travel in blocks, so many neighbouring indices of a source in a row.
_BLOCK_BITS = 12
_BLOCKS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("block", pa.int32()),
                     ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])
_SUMS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("at", pa.int32()), ("n", pa.int64())])


class Sums:
    """Counts per (lang, source, index) that a task holds."""

    def __init__(self) -> None:
        self.number: dict[tuple[str, str], int] = {}
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.waiting = 0

    def add(self, lang: pa.Array, source: pa.Array, sizes: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        """Entries of some rows, ``sizes`` of each."""
        group = [self.number.setdefault(g, len(self.number)) for g in zip(lang.to_pylist(), source.to_pylist())]
        self.keys.append((np.repeat(np.array(group, np.int64), sizes) << 31) + at)
        self.counts.append(n)
        self.waiting += len(at)

    def settle(self) -> np.ndarray:
        """One entry per key, held as the first of the lists; the keys."""
        key, total = _once(self.keys, self.counts)
        self.keys, self.counts, self.waiting = [key], [total], 0
        return key

    def taken(self, some: slice | np.ndarray = slice(None)) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
        """Keys and counts of settled entries, no longer held, and the texts of all groups."""
        out = self.keys[0][some], self.counts[0][some]
        rest = np.ones(len(self.keys[0]), bool)
        rest[some] = False
        self.keys, self.counts = [self.keys[0][rest]], [self.counts[0][rest]]
        return *out, [pa.array([n[i] for n in self.number], pa.string()) for i in (0, 1)]


def _pieces(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def _summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted sums of a task's sparse vectors in blocks, a bounded number held at a time."""
    sums = Sums()

    def rows() -> pa.RecordBatch:
        key, total, names = sums.taken()
        new = np.flatnonzero(np.append(True, np.diff(key >> _BLOCK_BITS) != 0)[:len(key)])
        edges, own = np.append(new, len(key)).astype(np.int32), pa.array(key[new] >> 31)
        at = (key & LARGEST_INT).astype(np.int32)
        return pa.RecordBatch.from_arrays([n.take(own) for n in names] + [
            pa.array(at[new] >> _BLOCK_BITS), pa.ListArray.from_arrays(edges, pa.array(at)),
            pa.ListArray.from_arrays(edges, pa.array(total))], schema=_BLOCKS)

    for part in parts:
        if not part.num_rows:
            continue
        vectors = part.column(3)
        indices, values = vectors.field("indices"), vectors.field("values")
        sizes = np.diff(indices.offsets.to_numpy())
        sums.add(part.column(0), part.column(1), sizes, indices.flatten().to_numpy(zero_copy_only=False),
                 values.flatten().to_numpy(zero_copy_only=False).astype(np.int64) * np.repeat(part.column(2).to_numpy(), sizes))
        if sums.waiting >= HELD_ENTRIES and len(sums.settle()) >= HELD_ENTRIES:
            yield from _pieces(rows(), VECTOR_ROWS)
    if sums.keys:
        sums.settle()
        yield from _pieces(rows(), VECTOR_ROWS)


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of blocks that come in order, each with all its rows; held are whole blocks and one more."""
    sums = Sums()

    def rows(key: np.ndarray, total: np.ndarray, names: list[pa.Array]) -> pa.RecordBatch:
        own = pa.array(key >> 31)
        return pa.RecordBatch.from_arrays([n.take(own) for n in names] + [
            pa.array((key & LARGEST_INT).astype(np.int32)), pa.array(total)], schema=_SUMS)

    for part in parts:
        if not part.num_rows:
            continue
        lists = part.column(3)
        sums.add(part.column(0), part.column(1), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(),
                 part.column(4).flatten().to_numpy())
        if sums.waiting >= HELD_ENTRIES:
            last = sums.keys[-1][-1] >> _BLOCK_BITS
            # Numbers of groups stay, so that the last block's rows that come meet those held.
            done = sums.settle() >> _BLOCK_BITS != last
            yield from _pieces(rows(*sums.taken(done)), SUM_ROWS)
    if sums.keys:
        sums.settle()
        yield from _pieces(rows(*sums.taken()), SUM_ROWS)


def term_sums(docs: DataFrame, min_docs: int = MIN_DOCS, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """lang, source, term, n: occurrences of every kept term in every source that has it."""
    spark = docs.sparkSession
    n_slices = slices_for(docs, min_docs, slice_terms)
    # Written once, a folder per slice: each model reads its own terms only.
    path = scratch_path(spark)
    columns = "lang string, source string, slice int, fit boolean, weight long, terms array<string>"
    _marked(docs).mapInArrow(_folded(n_slices, min_docs), columns).write.partitionBy("slice", "fit").parquet(path)
    # An empty term in as many rows as a term must have keeps every vocabulary from being empty.
    held = spark.range(min_docs).select(F.array(F.lit("")).alias("terms"))
    found = []
    small_batches(spark, VECTOR_ROWS)
    for k in range(n_slices):
        part = spark.read.schema(columns).parquet(path).where(F.col("slice") == k)
        model = CountVectorizer(inputCol="terms", outputCol="counts", minDF=float(min_docs),
                                vocabSize=LARGEST_INT).fit(part.where("fit").select("terms").unionByName(held))
        sums = (model.transform(part.where("not fit").select("lang", "source", "weight", "terms"))
                .select("lang", "source", "weight", "counts")
                .mapInArrow(_summed, "lang string, source string, block int, at array<int>, n array<long>")
                .repartition("lang", "source", "block").sortWithinPartitions("lang", "source", "block")
                .mapInArrow(_merged, "lang string, source string, at int, n long"))
        words = model.vocabulary
        names = spark.createDataFrame(
            pd.DataFrame({"at": np.arange(len(words), dtype=np.int32), "name": words}), "at int, name string")
        term = F.substring_index("name", " ", 1)
        found.append(materialise(sums.join(names, "at").select(
            "lang", "source", term.alias("term"), "n").where("term != ''")))
    small_batches(spark)
    return reduce(DataFrame.unionByName, found)


def share(n: Column, total: Column, terms: Column) -> Column:
    """Smoothed share in billionths, exact."""
    wide = (F.lit(BILLION).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")).cast("decimal(38,0)")
    return F.call_function("div", wide, (total + 2 * terms).cast("decimal(38,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // (p + q)


def tile_pairs(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums of distances over a block's terms for every pair of two tiles' sources.

    For sources a and b: a's entries against b's share of an absent term, b's against
    a's, and for the terms of both the difference to what these two have counted. A row
    without a term stands for its source alone, which may have no entry in the block.
    """
    lang, lo, hi = frame["lang"].iloc[0], frame["lo"].iloc[0], frame["hi"].iloc[0]
    term = pd.factorize(frame["term"])[0]
    tile, absent, p = (frame[c].to_numpy() for c in ("tile", "absent", "p"))
    entries = {}
    for source, rows in frame.groupby("source", sort=False).indices.items():
        own = rows[term[rows] >= 0]
        entries[source] = (tile[rows[0]], term[own], p[own], absent[rows[0]])
    out = []
    place = np.full(term.max() + 1, -1, np.int64)
    for a, (tile_a, at_a, p_a, none_a) in entries.items():
        if tile_a != lo:
            continue
        place[at_a] = np.arange(len(at_a))
        for b, (tile_b, at_b, p_b, none_b) in entries.items():
            if tile_b != hi or a == b or lo == hi and a > b:
                continue
            seen = place[at_b]
            both = seen >= 0
            common_a, common_b = p_a[seen[both]], p_b[both]
            total = (_apart(p_a, none_b).sum() + _apart(p_b, none_a).sum()
                     + (_apart(common_a, common_b) - _apart(common_a, none_b)
                        - _apart(common_b, none_a)).sum())
            out.append((lang, min(a, b), max(a, b), int(total), len(at_a) + len(at_b) - int(both.sum())))
        place[at_a] = -1
    return pd.DataFrame(out, columns=["lang", "one", "other", "value", "terms"])


def pair_sums(entries: DataFrame, groups: DataFrame, block_rows: int = BLOCK_ROWS,
              tile_sources: int = TILE_SOURCES) -> DataFrame:
    """lang, one, other, value, terms: over the terms that either source has, one < other.

    ``entries`` (lang, source, term, p, absent) are the sparse shares, ``groups`` (lang,
    source, absent) the sources of languages that have terms, both written.
    """
    size = entries.agg(F.count("*").alias("rows")).first().rows
    blocks = max(1, math.ceil(size / block_rows))
    most = groups.groupBy("lang").agg(F.approx_count_distinct("source").alias("n")).agg(F.max("n")).first()[0]
    tiles = max(1, math.ceil((most or 0) / tile_sources))
    alone = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"),
                          "absent", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"))
    dealt = entries.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks))).unionByName(alone).withColumn(
        "tile", F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).withColumn(
        "lo", F.least("tile", "with")).withColumn("hi", F.greatest("tile", "with")).drop("with")
    found = dealt.groupBy("lang", "block", "lo", "hi").applyInPandas(
        tile_pairs, "lang string, one string, other string, value long, terms long")
    return found.groupBy("lang", "one", "other").agg(
        F.sum("value").alias("value"), F.sum("terms").alias("terms"))


def audited(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
            slice_terms: int = SLICE_TERMS, block_rows: int = BLOCK_ROWS,
            tile_sources: int = TILE_SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank: the sources that differ most from each one and
    the terms that a source uses more than its language does."""
    sums = materialise(term_sums(docs, min_docs, slice_terms))
    by_lang = materialise(sums.groupBy("lang", "term").agg(F.sum("n").alias("n_lang")))
    totals = by_lang.groupBy("lang").agg(F.sum("n_lang").alias("lang_total"), F.count("*").alias("terms"))
    own = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = materialise(
        docs.select(_text("lang").alias("lang"), _text("source").alias("source")).distinct()
        .join(own, ["lang", "source"], "left").join(totals, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
                F.coalesce("terms", F.lit(0)).alias("terms"), "lang_total")
        .withColumn("absent", F.when(F.col("terms") > 0, share(
            F.lit(0).cast("long"), F.col("total"), F.col("terms")))))
    entries = materialise(sums.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "absent", "lang_total", "terms",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p")))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    q = share(F.col("n_lang"), F.col("lang_total"), F.col("terms"))
    more = (entries.join(by_lang, ["lang", "term"]).withColumn("q", q).where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    distance(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))

    each = pair_sums(entries.select("lang", "source", "term", "p", "absent"),
                     groups.where("terms > 0").select("lang", "source", "absent"), block_rows, tile_sources)
    left = groups.select("lang", "source", "terms", "absent")
    right = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("absent_there"))
    rest = ((F.col("left.terms") - F.coalesce("each.terms", F.lit(0)))
            * distance(F.col("absent"), F.col("absent_there")))
    pairs = (left.join(right, "lang").where("source != item")
             .withColumn("one", F.least("source", "item")).withColumn("other", F.greatest("source", "item"))
             .alias("left").join(each.alias("each"), ["lang", "one", "other"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.coalesce(F.coalesce("each.value", F.lit(0)) + rest, F.lit(0)).alias("value"))
             .withColumn("rank", F.row_number().over(order)))
    return pairs.unionByName(more).select(
        "lang", "source", "part", "item", F.col("value").cast("long").alias("value"),
        F.col("rank").cast("int").alias("rank"))
