"""Token sequences of whole documents, packed by minimum bin slack.

Documents become token ids (byte-level BPE) and one closing id. A document
longer than the capacity is cut so that only its first piece may be shorter.
Pieces are dealt by hash into shards of bounded size; a shard's pieces are
packed by length alone: a bin opens with the largest length left, and a bitset
subset-sum programme over the lengths still available finds the fullest
feasible combination for the rest. The combination is removed as often as the
remaining pieces allow, then the next one is sought.

Tokenizing goes piece of text by piece of text: white space bounds the
pre-tokenizer's pieces, so the ids of a text are those of its space-led words
in turn, and frequent words are remembered.

Defined results: null and empty texts become the closing id alone; a null
doc_id is packed like any other; repeated rows are packed each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import materialise, small_batches

CAPACITY = 2048
SHARD_PIECES = 40_000
# Fixed value: the code points that the pre-tokenizer counts as white space.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_UNIT = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_SPECIAL = "<|endoftext|>"
LONG_UNIT = 400
CACHED = 300_000
_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64())])


class ByteBpe(dict):
    """Little-endian unsigned 32-bit ids of texts under a tokenizers file.

    The dictionary remembers the ids of space-led words, a bounded number.
    """

    def __init__(self, name: str):
        super().__init__()
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(name))
        with open(public_tokenizers.path(name.replace(".json", ".tiktoken")), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        # The same vocabulary as merge ranks, several times faster on single words.
        self.ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                        mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, unit: str) -> bytes:
        if len(unit) > LONG_UNIT:
            return self._reference(unit)
        if len(self) >= CACHED:
            self.clear()
        ids = array("I", self.ranked.encode_ordinary(unit)).tobytes()
        self[unit] = ids
        return ids

    def _reference(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        if _SPECIAL in text:
            return self._reference(text)
        return b"".join(map(self.__getitem__, _UNIT.findall(text)))


_loaded: dict[str, ByteBpe] = {}


def tokenizer(name: str) -> ByteBpe:
    """One tokenizer per worker process."""
    if name not in _loaded:
        _loaded[name] = ByteBpe(name)
    return _loaded[name]


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be short."""
    first = n_ids % capacity or capacity
    out = [(0, first)]
    for start in range(first, n_ids, capacity):
        out.append((start, capacity))
    return out


def pieces(docs: DataFrame, name: str = "byte_bpe_50k.json", closing: int = 0,
           capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row."""
    small_batches(docs.sparkSession)
    end = np.array([closing], "<u4").tobytes()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(name)
        for part in parts:
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                ids = bpe.ids(text.as_py() or "") + end
                for at, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, at, start, length,
                                 zlib.crc32(ids[4 * start:4 * (start + length)])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(lengths: list[int], counts: list[int], room: int) -> list[int]:
    """Multiset of lengths (descending, with counts) of the largest sum up to ``room``.

    ``reach`` is a bitset: bit s is set where some choice among the lengths so
    far sums to s. It is kept per step to read the choice back.
    """
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length, count in zip(lengths, counts):
        if length > room:
            continue
        before = reach
        for _ in range(min(count, room // length)):
            grown = reach | (reach << length) & full
            if grown == reach:
                break
            reach = grown
        steps.append((length, before))
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    picks: list[int] = []
    for length, before in reversed(steps):
        while not before >> best & 1:
            picks.append(length)
            best -= length
    return picks


def pack(lengths: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of a bin, how many such bins) that use every length exactly once."""
    left = np.bincount(lengths, minlength=capacity + 1)
    out = []
    top = capacity
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return out
        left[top] -= 1
        have = np.flatnonzero(left)[::-1]
        rest = fullest(have.tolist(), left[have].tolist(), capacity - top)
        left[top] += 1
        combined = [top, *rest]
        size, need = np.unique(combined, return_counts=True)
        times = int((left[size] // need).min())
        left[size] -= need * times
        out.append((combined, times))


def _packed(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Give every row of a shard its bin and place."""
    lengths = frame["length"].to_numpy()
    order = np.argsort(lengths, kind="stable")
    starts = np.searchsorted(lengths[order], np.arange(capacity + 2))
    used = starts[:-1].copy()
    bins = np.empty(len(frame), np.int64)
    places = np.empty(len(frame), np.int64)
    number = 0
    for combined, times in pack(lengths, capacity):
        ids = number + np.arange(times)
        offset = 0
        for length in combined:
            rows = order[used[length]:used[length] + times]
            used[length] += times
            bins[rows], places[rows] = ids, offset
            offset += length
        number += times
    shard = int(frame["shard"].iloc[0])
    return frame.drop(columns="shard").assign(sequence_id=(shard << 32) + bins, offset=places)


def packed(docs: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES,
           name: str = "byte_bpe_50k.json", closing: int = 0) -> DataFrame:
    """One row per piece with its sequence_id and gapless offset.

    Shards hold about ``shard_pieces`` pieces, however many there are in all,
    and are packed side by side.
    """
    cutup = materialise(pieces(docs, name, closing, capacity))
    shards = max(1, math.ceil(cutup.count() / shard_pieces))
    # The running number spreads repeats of one row as well.
    shard = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()),
                   F.lit(shards)).cast("int")
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
              "sequence_id long, offset long")
    return cutup.withColumn("shard", shard).groupBy("shard").applyInPandas(
        lambda frame: _packed(frame, capacity), schema)
