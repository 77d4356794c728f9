"""Repeated substrings by a common-prefix-aware merge sort of suffixes.

Suffixes are taken at the anchors of recurring windows (see ``repeats``) and
cut where the anchor's last window ends; what lies before the anchor, back to
the first window, is put behind. Each flush sorts its suffixes and sends them
to shards as front-coded runs: the length shared with the suffix before, then
the rest. A shard merges its runs with a loser tree whose players carry the
prefix they share with the last winner, so a known prefix is never compared
again, and the merged run comes with all its shared lengths.

Equal suffixes then lie side by side: all but the earliest are repeats as a
whole. Different ones of one anchor stand together as well; their windows are
compared byte by byte, the earliest of equal ones stays.

Defined results: null text is empty; texts shorter than ``width`` keep all
bytes; a null doc_id comes first; rows that share a doc_id come in the order of
a digest of their texts; rows equal in both count as one document; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm import repeats
from marquee.llm.common import mixed, small_batches

WIDTH = 100
GRAIN = 32
_STEPS = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def byte_batch(part: pa.RecordBatch, grain: int) -> repeats.Batch:
    """Texts of a record batch as one run of bytes, with the hash of every ``grain`` bytes."""
    column = part.column(2)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    h = whole.astype(np.uint64)
    reach, step = 1, 0
    while reach < grain and len(h) > reach:
        h = h[:-reach] * _STEPS[step] + h[reach:]
        reach, step = 2 * reach, step + 1
    h = np.maximum(mixed(h), np.uint64(1))  # 0 stands for no hash
    text = whole.tobytes()
    return repeats.Batch(
        part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False),
        np.concatenate([h, np.zeros(len(whole) - len(h), np.uint64)]), offsets - offsets[0],
        lambda a, b: text[a:b])


KIND = repeats.Kind(WIDTH, GRAIN, byte_batch, same_document_counts=True, units_per_byte=1.0)


def shared_length(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, the first ``known`` bytes taken as equal."""
    top = min(len(a), len(b))
    at, step = known, 16
    while at < top:
        upto = min(at + step, top)
        if a[at:upto] == b[at:upto]:
            at, step = upto, 2 * step
        elif step <= 4 or upto - at == 1:
            while a[at] == b[at]:
                at += 1
            return at
        else:
            step = max(1, (upto - at) // 2)
    return top


def shared_lengths(keys: list[bytes]) -> np.ndarray:
    """Length that each of the sorted keys shares with the one before."""
    if not keys:
        return np.empty(0, np.uint16)
    lengths = np.array([len(k) for k in keys])
    width = int(lengths.max()) + 1
    table = np.array(keys, f"S{width}").view(np.uint8).reshape(len(keys), width)
    apart = table[1:] != table[:-1]
    differ = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
    return np.concatenate([[0], np.minimum(differ, np.minimum(lengths[1:], lengths[:-1]))]).astype(np.uint16)


def front_code(keys: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Shared lengths and the rests of sorted keys."""
    shared = shared_lengths(keys)
    return shared, b"".join(k[n:] for k, n in zip(keys, shared.tolist()))


_KINDS = ("<u2", "<u2", "<u2", "<u2", "<u4", *repeats.ROW_KINDS)


def pack_run(entries: list) -> bytes:
    """(key, size, extra, rows) entries as one sorted, front-coded, compressed run."""
    entries.sort(key=lambda e: (e[0], e[2]))
    shared, rests = front_code([e[0] for e in entries])
    columns = [np.array(c, k) for c, k in (
        ([len(e[0]) for e in entries], np.uint16), ([e[1] for e in entries], np.uint16),
        ([e[2] for e in entries], np.uint16), ([len(e[3]) for e in entries], np.uint32))]
    rows = repeats.pack_rows([r for e in entries for r in e[3]])
    return repeats.pack([shared, *columns, *rows], rests)


class Run:
    """A packed run opened: keys, what each shares with the one before, and their places."""

    def __init__(self, blob: bytes):
        (shared, lengths, sizes, rights, counts, *rows), rests = repeats.unpack(blob, _KINDS)
        self.shared = shared.tolist()
        self.segments = list(zip(sizes.tolist(), rights.tolist()))
        self.ends = np.cumsum(counts).tolist()
        self.places = list(zip(*repeats.unpack_rows(*rows)))
        self.keys, at, last = [], 0, b""
        for n, length in zip(self.shared, lengths.tolist()):
            last = last[:n] + rests[at:at + length - n]
            at += length - n
            self.keys.append(last)


def merge(runs: list[list[bytes]], shared: list[list[int]]) -> Iterator[tuple[int, int, int]]:
    """(run, item, prefix shared with the item before) of all runs' items in order.

    ``shared`` has each item's common prefix with its forerunner in its run. Of
    two players the one that shares more with the last winner is the smaller;
    only equal ones are compared, from there on, and the loser keeps what it
    shares with the winner.
    """
    size = 1 << max(0, len(runs) - 1).bit_length()
    current: list[bytes | None] = [run[0] if run else None for run in runs]
    current += [None] * (size - len(runs))
    prefix, place, losers = [0] * size, [0] * size, [0] * size

    def play(a: int, b: int) -> bool:
        """Whether ``a`` wins where both share ``prefix[a]`` with the last winner."""
        x, y = current[a], current[b]
        n = shared_length(x, y, prefix[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            prefix[b] = n
            return True
        prefix[a] = n
        return False

    level = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        a, b = level[2 * node], level[2 * node + 1]
        if current[b] is None or (current[a] is not None and play(a, b)):
            level[node], losers[node] = a, b
        else:
            level[node], losers[node] = b, a
    winner = level[1] if size > 1 else 0
    while current[winner] is not None:
        at = place[winner]
        yield winner, at, prefix[winner]
        place[winner] = at = at + 1
        run = runs[winner]
        if at < len(run):
            current[winner], prefix[winner] = run[at], shared[winner][at]
            known = prefix[winner]
        else:
            current[winner], known = None, -1
        node = (winner + size) >> 1
        while node:
            other = losers[node]
            if current[other] is not None:
                n = prefix[other]
                if n > known or (n == known and not play(winner, other)):
                    losers[node], winner = winner, other
                    known = n
            node >>= 1


# Groups up to this size are compared two by two, larger ones by a table of windows.
PAIRED = 6
Place = tuple[int, int, int]


def _shared_end(a: bytes, b: bytes) -> int:
    """Length of the common ending."""
    return shared_length(a[::-1], b[::-1], 0)


def _paired(group: list[tuple[bytes, int, int, Place]], width: int, out: list) -> None:
    """Spans that a segment shares with an earlier one around their common anchor."""
    for at, (key, _, right, place) in enumerate(group):
        for other, _, other_right, other_place in group[:at]:
            after = shared_length(key[:right], other[:other_right], 0)
            before = _shared_end(key[right:], other[other_right:])
            if before + after >= width and place != other_place:
                (doc, digest, start), left = (
                    (place, len(key) - right) if other_place < place
                    else (other_place, len(other) - other_right))
                out.append((doc, digest, start + left - before, start + left + after))


def _tabled(group: list[tuple[bytes, int, int, Place]], width: int, out: list) -> None:
    """Spans of the windows that begin earlier in another segment of the same anchor."""
    first: dict[bytes, Place] = {}
    texts = []
    for key, size, right, (doc, digest, start) in group:
        text = key[right:] + key[:right]
        texts.append(text)
        for i in range(size):
            place = (doc, digest, start + i)
            known = first.setdefault(text[i:i + width], place)
            if place < known:
                first[text[i:i + width]] = place
    for text, (_, size, _, (doc, digest, start)) in zip(texts, group):
        out.extend((doc, digest, start + i, start + i + width) for i in range(size)
                   if first[text[i:i + width]] != (doc, digest, start + i))


def repeated(blobs: list[bytes], width: int, grain: int) -> np.ndarray:
    """(doc, digest, start, end) rows to remove, from the packed runs of a shard."""
    opened = [Run(b) for b in blobs]
    out: list[tuple[int, int, int, int]] = []
    group: list[tuple[bytes, int, int, Place]] = []
    last, segment = b"", (0, 0)
    places: list[Place] = []

    def close_segment() -> None:
        earliest = min(places)
        if len(places) > 1:
            span = (segment[0] or 1) + width - 1
            out.extend((*p, p[2] + span) for p in places if p > earliest)
        group.append((last, segment[0], segment[1], earliest))

    def close_group() -> None:
        if len(group) > PAIRED:
            _tabled(group, width, out)
        elif len(group) > 1:
            _paired(group, width, out)
        group.clear()

    for run, item, shared in merge([r.keys for r in opened], [r.shared for r in opened]):
        own = opened[run]
        key = own.keys[item]
        # The merge knows what adjoining suffixes share; only whole equality is left to see.
        if not (shared == len(key) == len(last) and segment == own.segments[item]):
            if places:
                close_segment()
                places = []
            if shared < grain or not own.segments[item][0]:
                close_group()
            last, segment = key, own.segments[item]
        places.extend(own.places[own.ends[item - 1] if item else 0:own.ends[item]])
    if places:
        close_segment()
    close_group()
    return np.array(out, np.int64).reshape(-1, 4)


def _suffix(batch: repeats.Batch, place: int, start: int, end: int) -> tuple[bytes, int]:
    return batch.cut(place, end) + batch.cut(start, place), end - place


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Packed byte spans to remove per document: doc_id, digest, spans."""
    found = repeats.recurring(docs, KIND)
    rows = repeats.segment_rows(docs, KIND, found, _suffix, pack_run)
    return repeats.decided(rows, lambda blobs: repeated(blobs, WIDTH, GRAIN))


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("n_spans", pa.int64()), ("kept", pa.binary())])


def deduplicated(docs: DataFrame, digest_only: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left, or their SHA-256)."""
    joined = repeats.with_spans(docs, repeated_spans(docs))
    small_batches(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for doc_id, text, packed in zip(part.column(0).to_pylist(), part.column(1),
                                            part.column(2).to_pylist()):
                raw = text.as_py().encode()
                spans = repeats.merged_spans(packed)
                at, kept = 0, []
                for start, end in spans.tolist():
                    kept.append(raw[at:start])
                    at = end
                left = b"".join([*kept, raw[at:]])
                out.append((doc_id, len(raw), len(raw) - len(left), len(spans),
                            hashlib.sha256(left).digest() if digest_only else left))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], schema=_RESULT)

    return joined.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
