"""Repeated phrases located by sharded Aho-Corasick automata.

Segments of recurring anchors (see ``repeats``) are dealt to shards. A shard
confirms recurring passages: the windows of ``width`` words whose hashes begin in
more than one document. It compiles them into an automaton over word numbers and
streams its segments through it once, which locates every occurrence; the least
doc_id among a passage's occurrences keeps it, and those of later documents go. Every document is
streamed, by the segments of all its recurring anchors; equal segments of a
flush are streamed once.

Defined results: null text has no words; texts of fewer than ``width`` words
keep all; a null doc_id comes before all others; rows that share a doc_id never
remove words of each other; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm import repeats
from marquee.llm.common import mixed, small_batches, texts_of

WIDTH = 13
GRAIN = 5
# Compression level of segments on their way: they are few beside their texts.
PACKING = 1
# Bytes of text whose words are hashed at once.
STRETCH = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, as far as asked for."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            self.up, self.down = (np.cumprod(np.concatenate([
                np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (self.base, self.inverse))
        return self.up[:size], self.down[:size]


_powers = Powers()


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every word of a text given as bytes, all words of a stretch at once.

    A word's hash is a polynomial in its bytes, the difference of two running sums
    over the text, moved back to the word's start.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, first + STRETCH, side="right")))
        size = int(ends[upto - 1] - first)
        up, down = _powers.upto(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((raw[first:first + size].astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        a, b = starts[at:upto] - first, ends[at:upto] - first
        out[at:upto] = (sums[b] - sums[a]) * down[a]
        at = upto
    return mixed(out)


def word_batch(part: pa.RecordBatch, grain: int) -> repeats.Batch:
    """Words of a record batch's texts end to end, with the hash of every ``grain`` words."""
    texts = [b" ".join(t.split()) for t in texts_of(part.column(2))]
    counts = [t.count(b" ") + 1 if t else 0 for t in texts]
    starts = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int64)
    held = b" ".join(t for t in texts if t)
    raw = np.frombuffer(held, np.uint8)
    spaces = np.flatnonzero(raw == 32)
    first, last = np.concatenate([[0], spaces + 1]), np.append(spaces, len(raw))
    own = word_hashes(raw, first, last) if held else np.zeros(0, np.uint64)
    n = max(0, len(own) - grain + 1)
    h = np.zeros(n, np.uint64)
    for i in range(grain if n else 0):
        h = h * _FACTOR + own[i:i + n]
    return repeats.Batch(
        part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False),
        np.concatenate([mixed(h), np.zeros(len(own) - n, np.uint64)]), starts,
        lambda a, b: held[first[a]:last[b - 1]])


KIND = repeats.Kind(WIDTH, GRAIN, word_batch, same_document_counts=False, units_per_byte=0.16)


_KINDS = ("<u4", "<u2", "<u4", *repeats.ROW_KINDS)


def pack_segments(entries: list) -> bytes:
    """(key, size, extra, rows) entries, compressed."""
    columns = [np.array(c, k) for c, k in (
        ([len(e[0]) for e in entries], np.uint32), ([e[1] for e in entries], np.uint16),
        ([len(e[3]) for e in entries], np.uint32))]
    rows = repeats.pack_rows([r for e in entries for r in e[3]])
    return repeats.pack([*columns, *rows], b"".join(e[0] for e in entries), PACKING)


def unpack_segments(blob: bytes, width: int) -> Iterator[tuple[bytes, int, list[tuple]]]:
    """(key, size, rows) entries; rows are (doc, digest, start, end)."""
    (lengths, sizes, counts, *packed), keys = repeats.unpack(blob, _KINDS)
    places = list(zip(*repeats.unpack_rows(*packed)))
    at = row = 0
    for length, size, n in zip(lengths.tolist(), sizes.tolist(), counts.tolist()):
        span = (size or 1) + width - 1
        yield keys[at:at + length], size, [(*p, p[2] + span) for p in places[row:row + n]]
        at, row = at + length, row + n


def confirmed(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, docs: np.ndarray,
              width: int) -> np.ndarray:
    """First words of one window of each passage that may begin in two documents.

    ``ids`` are the word numbers of all segments end to end. Windows are hashed side
    by side and sorted; a hash seen in two documents marks a passage. Windows that
    only share a hash become passages of their own: the automaton goes by the words.
    """
    h = np.zeros(max(0, len(ids) - width + 1), np.uint64)
    for i in range(width if len(h) else 0):
        h = h * _FACTOR + mixed(ids[i:i + len(h)].astype(np.uint64) + np.uint64(1))
    at = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    owner = np.repeat(docs, sizes)
    order = np.lexsort((owner, h[at]))
    sorted_h, sorted_doc = h[at][order], owner[order]
    new = np.concatenate([[True], sorted_h[1:] != sorted_h[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(new)) - 1
    placed = at[order]
    model = placed[first][np.cumsum(new) - 1]
    odd = np.zeros(len(placed), bool)
    for i in range(width):
        odd |= ids[placed + i] != ids[model + i]
    return np.concatenate([placed[first[sorted_doc[first] != sorted_doc[last]]], placed[odd]])


def located(blobs: list[bytes], width: int) -> np.ndarray:
    """(doc, digest, start, end) rows to remove, from the packed segments of a shard.

    The automaton's single pass over the segments says where each passage occurs
    and, by the documents of those places, which document has it first.
    """
    out: list[tuple] = []
    held: dict[bytes, tuple[int, list[tuple]]] = {}
    for blob in blobs:
        for key, size, rows in unpack_segments(blob, width):
            known = held.get(key)
            if known is None:
                held[key] = (size, rows)
            elif rows[0][0] < known[1][0][0]:
                out.extend(known[1])
                held[key] = (size, rows)
            elif rows[0][0] > known[1][0][0]:
                out.extend(rows)
            else:
                known[1].extend(rows)
    # A single window under its digest is settled above.
    streams = [(key.split(b" "), size, rows) for key, (size, rows) in held.items() if size]
    held.clear()
    done = np.array(out, np.int64).reshape(-1, 4)
    if not streams:
        return done
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for words, _, _ in streams for w in words), np.int64)
    lengths = np.array([len(words) for words, _, _ in streams])
    starts = np.cumsum(lengths) - lengths
    docs = np.array([rows[0][0] for _, _, rows in streams])
    passages = confirmed(ids, starts, np.array([size for _, size, _ in streams]), docs, width)
    if not len(passages):
        return done
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for which, window in enumerate(ids[passages[:, None] + np.arange(width)].tolist()):
        automaton.add_word(tuple(window), which)
    automaton.make_automaton()
    found, ends, counts = array("q"), array("q"), []
    for start, length in zip(starts.tolist(), lengths.tolist()):
        before = len(found)
        for end, which in automaton.iter(tuple(ids[start:start + length].tolist())):
            found.append(which)
            ends.append(end)
        counts.append(len(found) - before)
    which, end = np.array(found, np.int64), np.array(ends, np.int64)
    stream = np.repeat(np.arange(len(streams)), counts)
    first = np.full(len(passages), np.iinfo(np.int64).max)
    np.minimum.at(first, which, docs[stream])
    later = first[which] < docs[stream]
    stream, end = stream[later], end[later]
    if not len(end):
        return done
    # Covered words of a stream lie between runs of ends closer than a window.
    new = np.concatenate([[True], (stream[1:] != stream[:-1]) | (end[1:] > end[:-1] + width)])
    run = np.flatnonzero(new)
    upto = np.append(run[1:], len(end)) - 1
    spans = []
    for s, a, b in zip(stream[run].tolist(), (end[run] - width + 1).tolist(), (end[upto] + 1).tolist()):
        spans.extend((doc, digest, start + a, start + b) for doc, digest, start, _ in streams[s][2])
    return np.concatenate([done, np.array(spans, np.int64).reshape(-1, 4)])


def _segment(batch: repeats.Batch, place: int, start: int, end: int) -> tuple[bytes, int]:
    del place
    return batch.cut(start, end), 0


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Packed word spans to remove per document: doc_id, digest, spans."""
    found = repeats.recurring(docs, KIND)
    rows = repeats.segment_rows(docs, KIND, found, _segment, pack_segments)
    return repeats.decided(rows, lambda blobs: located(blobs, WIDTH))


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept", pa.binary())])


def deduplicated(docs: DataFrame, digest_only: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by a space, or their SHA-256)."""
    joined = repeats.with_spans(docs, repeated_spans(docs))
    small_batches(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for doc_id, text, packed in zip(part.column(0).to_pylist(), texts_of(part.column(1)),
                                            part.column(2).to_pylist()):
                words = text.split()
                at, kept = 0, []
                for start, end in repeats.merged_spans(packed).tolist():
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                left = b" ".join(kept)
                out.append((doc_id, len(words), len(words) - len(kept),
                            hashlib.sha256(left).digest() if digest_only else left))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], schema=_RESULT)

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")
