"""Common ground of the repeat finders: anchors, the recurrence filter, segments, spans.

A document is a row of units (bytes or words); a window is ``width`` of them.
Each window has an anchor: of its ``width - grain + 1`` stretches of ``grain``
units the one of the least hash (the last of equal ones). Equal windows have
their anchor at the same place, so a window can only recur where its anchor
does. The windows of one anchor lie side by side and form a segment.

1. Anchor hashes are counted, packed by hash range. Each range gives the bits
   of the hashes that recur; the bitmap has 2**29 bits (64 MB) at most, however
   large the corpus is. Hash collisions only let more segments through.
2. Documents are read again; segments of recurring anchors go, packed by
   anchor, to shards of bounded size. Of equal segments in one flush only the
   first is sent, the others are known to be repeats.
3. A shard decides exactly, on the text itself (see the finders).

An anchor that occurs more than ``total / HOT_ANCHORS`` times (so there are at
most HOT_ANCHORS of them) would fill its shard: its windows travel one by one,
each under a 128-bit digest of its text, and spread over all shards.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import mixed, small_batches

HOT_ANCHORS = 50_000
LEAST_HOT = 20_000
SHARD_SEGMENTS = 60_000
MOST_BITS = 29
FLUSH_ANCHORS = 600_000
FLUSH_SEGMENTS = 200_000
NO_ID = -(1 << 63)


@dataclass
class Batch:
    """Documents of one Arrow batch, their units laid end to end."""

    ids: np.ndarray
    digests: np.ndarray
    hashes: np.ndarray  # of the stretch of ``grain`` units that begins at each unit
    starts: np.ndarray  # first unit of each document, and the end of the last
    cut: Callable[[int, int], bytes]  # text of a range of units


@dataclass(frozen=True)
class Kind:
    """What the units are, and which of two places counts as earlier."""

    width: int
    grain: int
    read: Callable[[pa.RecordBatch, int], Batch]
    same_document_counts: bool
    units_per_byte: float


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (or greatest) of every ``width`` neighbours, by doubling."""
    pick = np.minimum if least else np.maximum
    out, reach = values, 1
    while 2 * reach <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    return pick(out[: len(out) - (width - reach)], out[width - reach:]) if reach < width else out


def anchors(batch: Batch, width: int, grain: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, first window, last window) of every anchor of the batch."""
    n, reach = len(batch.hashes), width - grain + 1
    none = np.empty(0, np.int64)
    lengths = np.diff(batch.starts)
    if n < width or not (lengths >= width).any():
        return none, none, none, none
    ends = batch.starts[1:]
    usable = np.zeros(n + 1, np.int64)  # window starts
    long = lengths >= width
    np.add.at(usable, batch.starts[:-1][long], 1)
    np.add.at(usable, ends[long] - width + 1, -1)
    usable = np.cumsum(usable[:-1]) > 0
    least = sliding(batch.hashes[: n - grain + 1], reach, True)
    least = np.where(usable[: len(least)], least, np.uint64(0))
    # A stretch is an anchor if it equals the least of some window that holds it.
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), least, np.zeros(reach - 1, np.uint64)])
    best = sliding(padded, reach, False)
    place = np.flatnonzero((best == batch.hashes[: len(best)]) & (best > 0))
    if not len(place):
        return none, none, none, none
    doc = np.searchsorted(batch.starts, place, side="right") - 1
    h = batch.hashes[place]
    first = batch.starts[doc].copy()
    again = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    first[again] = np.where(h[again] <= h[again - 1], place[again] - reach + 1, place[again - 1] + 1)
    # Anchors only move on: one that ties may not reach back before its forerunner.
    first = np.maximum.accumulate(np.maximum(first, batch.starts[doc]))
    last = ends[doc] - width
    last[again - 1] = first[again] - 1
    last = np.minimum(last, ends[doc] - width)
    keep = first <= last
    return doc[keep], place[keep], first[keep], last[keep]


def _input(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.xxhash64(text).alias("digest"), text.alias("text"))


def _ranges(sorted_values: np.ndarray, count: int, bits: int) -> np.ndarray:
    """Bounds of ``count`` (a power of two) equal ranges of 64-bit values."""
    edges = (np.arange(1, count, dtype=np.uint64) << np.uint64(64 - bits))
    return np.concatenate([[0], np.searchsorted(sorted_values, edges), [len(sorted_values)]])


@dataclass(frozen=True)
class Recurring:
    """Bitmap of recurring anchor hashes, and the hot ones sorted."""

    bits: int
    bitmap: np.ndarray
    hot: np.ndarray
    segments: int

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = h >> np.uint64(64 - self.bits)
        return (self.bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def is_hot(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
        return self.hot[at] == h


def recurring(docs: DataFrame, kind: Kind, least_hot: int = LEAST_HOT) -> Recurring:
    """Count all anchors of ``docs``; keep what recurs."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    total = max(1, int(2 * size * kind.units_per_byte / (kind.width - kind.grain + 2)))
    bits = min(MOST_BITS, max(16, math.ceil(math.log2(2 * total))))
    part_bits = min(bits - 3, max(0, math.ceil(math.log2(max(1, total / 2_000_000)))) + 3)
    parts = 1 << part_bits
    hot_from = max(least_hot, total // HOT_ANCHORS)
    width, grain, read = kind.width, kind.grain, kind.read

    def count(some: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            at = _ranges(h, parts, part_bits)
            n = n.astype("<u4")
            used = [i for i in range(parts) if at[i] < at[i + 1]]
            return pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()),
                 pa.array([h[at[i]:at[i + 1]].tobytes() for i in used], pa.binary()),
                 pa.array([n[at[i]:at[i + 1]].tobytes() for i in used], pa.binary())],
                names=["part", "h", "n"])

        for part in some:
            batch = read(part, grain)
            _, place, _, _ = anchors(batch, width, grain)
            if len(place):
                held.append(batch.hashes[place])
            if sum(map(len, held)) >= FLUSH_ANCHORS:
                yield flush()
        if held:
            yield flush()

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        h = np.frombuffer(b"".join(frame["h"]), "<u8")
        n = np.frombuffer(b"".join(frame["n"]), "<u4").astype(np.int64)
        part = int(frame["part"].iloc[0])
        order = np.argsort(h)
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        n = np.add.reduceat(n, first)
        h = h[first]
        again = n > 1
        slots = (h[again] >> np.uint64(64 - bits)) - (np.uint64(part) << np.uint64(bits - part_bits))
        flags = np.zeros(1 << (bits - part_bits), bool)
        flags[slots.astype(np.int64)] = True
        return pd.DataFrame({"part": [part], "bitmap": [np.packbits(flags, bitorder="little").tobytes()],
                             "hot": [h[n >= hot_from].tobytes()], "segments": [int(n[again].sum())]})

    small_batches(docs.sparkSession, 512)
    settled = (_input(docs).mapInArrow(count, "part int, h binary, n binary").groupBy("part")
               .applyInPandas(settle, "part int, bitmap binary, hot binary, segments long"))
    bitmap = np.zeros(1 << max(0, bits - 3), np.uint8)
    hot, segments = [], 0
    span = 1 << (bits - part_bits - 3)
    for row in settled.collect():
        bitmap[row.part * span:(row.part + 1) * span] = np.frombuffer(row.bitmap, np.uint8)
        hot.append(np.frombuffer(row.hot, "<u8"))
        segments += row.segments
    return Recurring(bits, bitmap, np.sort(np.concatenate([np.empty(0, np.uint64), *hot])), segments)


def pack_rows(rows: list[tuple[int, int, int, int]]) -> list[np.ndarray]:
    """(doc, digest, start, end) rows as columns; documents are listed once.

    ``end`` follows from the segment and is left out.
    """
    known: dict[tuple[int, int], int] = {}
    at = [known.setdefault(r[:2], len(known)) for r in rows]
    names = np.array(list(known), np.int64).reshape(-1, 2)
    return [names[:, 0].copy(), names[:, 1].copy(), np.array(at, np.uint32),
            np.array([r[2] for r in rows], np.uint32)]


ROW_KINDS = ("<i8", "<i8", "<u4", "<u4")


def unpack_rows(docs: np.ndarray, digests: np.ndarray, at: np.ndarray,
                start: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Columns doc, digest and start of packed rows."""
    return docs[at].tolist(), digests[at].tolist(), start.tolist()


def pack(arrays: list[np.ndarray], rest: bytes, level: int = 6) -> bytes:
    """Arrays and bytes as one compressed blob."""
    head = np.array([len(a) for a in arrays], "<i8")
    return zstandard.compress(head.tobytes() + b"".join(a.tobytes() for a in arrays) + rest, level)


def unpack(blob: bytes, kinds: tuple[str, ...]) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.decompress(blob)
    at, out = 8 * len(kinds), []
    for kind, size in zip(kinds, np.frombuffer(raw, "<i8", len(kinds)).tolist()):
        out.append(np.frombuffer(raw, kind, size, at))
        at += out[-1].nbytes
    return out, raw[at:]


class Flush:
    """Segments held until they are sent; of equal ones only the earliest stay."""

    def __init__(self, same_document_counts: bool):
        self.places = same_document_counts
        self.held: dict[bytes, list] = {}
        self.removed: list[tuple[int, int, int, int]] = []

    def add(self, key: bytes, shard: int, size: int, doc: int, digest: int, start: int, end: int,
            extra: int) -> None:
        """``extra`` travels with the key: equal keys have equal ones."""
        row = (doc, digest, start, end)
        known = self.held.get(key)
        if known is None:
            self.held[key] = [shard, size, extra, {row: None}]
            return
        rows = known[3]
        some = next(iter(rows))
        order = row[:3] if self.places else row[:1]
        least = some[:3] if self.places else some[:1]
        if order > least:
            self.removed.append(row)
        elif order < least:
            self.removed.extend(rows)
            known[3] = {row: None}
        else:
            rows[row] = None


def segment_rows(docs: DataFrame, kind: Kind, found: Recurring,
                 key_of: Callable[[Batch, int, int, int], tuple[bytes, int]],
                 pack: Callable[[list], bytes]) -> DataFrame:
    """(shard, blob, spans): packed segments by shard; spans already known to repeat.

    ``key_of`` turns (batch, anchor, start, end) into a key and a number that
    travels with it; ``pack`` packs a shard's (key, size, extra, rows) entries.
    Rows of negative shard carry only spans.
    """
    shards = max(1, math.ceil(found.segments / SHARD_SEGMENTS))
    spark = docs.sparkSession
    small_batches(spark, 512)
    shared = spark.sparkContext.broadcast(found)
    width, grain, read, places = kind.width, kind.grain, kind.read, kind.same_document_counts

    def run(some: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        flush = Flush(places)
        number = 0

        def send() -> pa.RecordBatch:
            nonlocal flush, number
            by: dict[int, list] = {}
            for key, (shard, size, extra, rows) in flush.held.items():
                by.setdefault(shard, []).append((key, size, extra, rows))
            number += 1
            out = [(shard, pack(entries), None) for shard, entries in by.items()]
            if flush.removed:
                out.append((-1 - hash((number, flush.removed[0])) % 4096, None,
                            np.array(flush.removed, np.int64).tobytes()))
            flush = Flush(places)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary()))],
                names=["shard", "blob", "spans"])

        for part in some:
            batch = read(part, grain)
            docs_, place, first, last = anchors(batch, width, grain)
            h = batch.hashes[place]
            keep = np.flatnonzero(known.has(h)) if len(h) else np.empty(0, np.int64)
            hot = known.is_hot(h[keep])
            shard = (mixed(h[keep]) % np.uint64(shards)).astype(np.int64)
            for i, d, p, s, e, is_hot, to in zip(
                    keep.tolist(), docs_[keep].tolist(), place[keep].tolist(), first[keep].tolist(),
                    last[keep].tolist(), hot.tolist(), shard.tolist()):
                doc, digest, zero = int(batch.ids[d]), int(batch.digests[d]), int(batch.starts[d])
                if is_hot:
                    for at in range(s, e + 1):
                        key = xxhash.xxh3_128_digest(batch.cut(at, at + width))
                        flush.add(key, int.from_bytes(key[:8], "little") % shards, 0,
                                  doc, digest, at - zero, at - zero + width, 0)
                else:
                    key, extra = key_of(batch, p, s, e + width)
                    flush.add(key, to, e - s + 1, doc, digest, s - zero, e + width - zero, extra)
            if len(flush.held) + len(flush.removed) >= FLUSH_SEGMENTS:
                yield send()
        if flush.held or flush.removed:
            yield send()

    return _input(docs).mapInArrow(run, "shard int, blob binary, spans binary")


SPAN_ROWS = "doc_id long, digest long, spans binary"


def spans_by_document(rows: np.ndarray) -> pd.DataFrame:
    """(doc, digest, start, end) rows as one packed row per document."""
    if not len(rows):
        return pd.DataFrame({"doc_id": np.empty(0, np.int64), "digest": np.empty(0, np.int64),
                             "spans": np.empty(0, object)})
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
    at = np.append(np.flatnonzero(new), len(rows))
    packed = rows[:, 2:].astype("<i4")
    return pd.DataFrame({
        "doc_id": rows[at[:-1], 0], "digest": rows[at[:-1], 1],
        "spans": [union(packed[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]})


def union(spans: np.ndarray) -> np.ndarray:
    """Sorted disjoint spans that cover the same units; touching ones become one."""
    if len(spans) < 2:
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    upto = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > upto[:-1]])
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], np.append(upto[at[1:] - 1], upto[-1])], axis=1).astype("<i4")


def decided(rows: DataFrame, decide: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """Spans to remove, packed per document: those of the shards and those known before."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        before = [np.frombuffer(s, np.int64).reshape(-1, 4) for s in frame["spans"] if s is not None]
        blobs = [b for b in frame["blob"] if b is not None]
        if blobs:
            before.append(decide(blobs).reshape(-1, 4))
        return spans_by_document(np.concatenate(before))

    return rows.groupBy("shard").applyInPandas(run, SPAN_ROWS)


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, text, spans (array of packed spans or null) of every row of ``docs``."""
    per = (spans.groupBy("doc_id", "digest").agg(F.collect_list("spans").alias("spans"))
           .select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "spans"))
    # Whole texts are joined on one key pair; null texts count as empty.
    return (_input(docs).join(per, (F.col("doc_id") == F.col("__id"))
                              & (F.col("digest") == F.col("__digest")), "left")
            .select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "text", "spans"))


def merged_spans(packed: list[bytes] | None) -> np.ndarray:
    if not packed:
        return np.empty((0, 2), np.int64)
    return union(np.frombuffer(b"".join(packed), "<i4").reshape(-1, 2)).astype(np.int64)


__all__ = ["Batch", "Flush", "Kind", "Recurring", "anchors", "decided", "merged_spans",
           "recurring", "segment_rows", "union", "with_spans"]
