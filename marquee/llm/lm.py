"""Language-model scores under a hierarchical Pitman-Yor model.

Every context, the word before, has a restaurant of its own. All share the word
restaurant as parent, and that one the uniform distribution over the known
words and one unknown. Chinese-restaurant seating is sampled by Gibbs sweeps: a
sweep takes a word's customers in a context away and seats them again one after
the other, each at a new table with the probability that the other tables'
state gives. (Beyond the 64th customer of the same word they come in groups of
a sixteenth, under one probability.) All pairs of word and context are seated
side by side from the state after the sweep before, whose tables are summed per
context and per word after every sweep; draws depend on word, context and sweep
alone. A text's score is the sum over its tokens of log10 of the predictive
probability, averaged over the states after the last sweeps.

Tokens travel once, packed, to shards by word, so that a shard sees all
contexts of its words. Frequent words, chosen on a bounded sample of documents,
are spread by (word, context) instead; the number of shards and that choice
move work, not results. Shards are known by keys that Spark's hash deals to one
task and bucket each. Contexts are owned by slices: shards send customers and
tables per context there and get the sums back. A pair of one customer always
has one table, so that a sweep sends pairs of several customers only. Sums per
document come back packed by the flush that sent its tokens.

Defined results: null and empty texts are their end token alone; a null doc_id
is learnt from (its remainder counts as that of empty text); repeated rows are
learnt and scored each; without training texts both scores are those of the
uniform distribution; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import WordHashes, bucketed, id_remainder, mixed, small_batches, texts_of
from marquee.session import materialise

FLUSH_TOKENS = 1_000_000
SHARD_TOKENS = 2_000_000
HOT_SAMPLE = 1_000
HOT_WORDS = 4_096
# Rows in which the shards' totals reach the driver.
TOTALS = 32
_END = np.uint64(xxhash.xxh64_intdigest(b" end", seed=5))
_START = np.uint64(xxhash.xxh64_intdigest(b" start", seed=5))
_words = WordHashes(seed=5, limit=150_000)


@dataclass(frozen=True)
class PitmanYor:
    """Discounts and strengths of the context and word restaurants; sweeps."""

    discount: float = 0.8
    strength: float = 2.0
    word_discount: float = 0.6
    word_strength: float = 10.0
    burn_in: int = 1
    samples: int = 3


def tokens_of(text: bytes) -> np.ndarray:
    """Hashes of a text's lower-cased words and its end."""
    return np.append(_words.of(text.lower().split()), _END)


def contexts_of(tokens: np.ndarray) -> np.ndarray:
    """Restaurant of each token: the whole hash of the token before it."""
    return np.concatenate([np.array([_START], np.uint64), tokens[:-1]])


def frequent(docs: DataFrame, sample: int, share: float) -> np.ndarray:
    """Sorted hashes of words that make up over ``share`` of the tokens of sampled texts."""
    some = (docs.select("doc_id", "text").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    count: dict[int, int] = {}
    total = 0

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            own = [tokens_of(t) for t in texts_of(part.column(1))]
            if own:
                h, n = np.unique(np.concatenate(own), return_counts=True)
                order = np.argsort(-n, kind="stable")[:HOT_WORDS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h[order].view(np.int64).tolist()], pa.list_(pa.int64())),
                     pa.array([n[order].tolist()], pa.list_(pa.int64())),
                     pa.array([int(n.sum())], pa.int64())], names=["h", "n", "total"])

    for row in some.mapInArrow(run, "h array<long>, n array<long>, total long").collect():
        total += row.total
        for h, n in zip(row.h, row.n):
            count[h] = count.get(h, 0) + n
    hot = [h for h, n in count.items() if n > share * total]
    return np.sort(np.array(hot, np.int64).view(np.uint64))


def even_keys(spark: SparkSession, shards: int) -> np.ndarray:
    """A key per shard, not negative, that a shuffle or a bucketed table of as many parts
    deals to a part of its own."""
    size = 32 * shards
    while True:
        parts = spark.range(0, size, 1, 1).select(
            F.pmod(F.hash(F.col("id").cast("int")), F.lit(shards)).alias("part")).toPandas()["part"]
        known, first = np.unique(parts, return_index=True)
        if len(known) == shards:
            return first
        size *= 2


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays by byte planes, so that high bytes of small values vanish."""
    head = np.array([len(a) for a in arrays], "<i8")
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    return zstandard.compress(head.tobytes() + b"".join(planes), 1)


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    at, out = 8 * len(kinds), []
    for kind, size in zip(kinds, np.frombuffer(raw, "<i8", len(kinds)).tolist()):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size * width
    return out


def dealt(docs: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """(shard, flush, blob): packed tokens by shard, named by its key; negative ones have the
    flushes' documents.

    ``docs`` has doc_id, text and train.
    """
    small_batches(docs.sparkSession, 512)
    shared = docs.sparkSession.sparkContext.broadcast((hot, even_keys(docs.sparkSession, shards)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, keys = shared.value
        flush = TaskContext.get().partitionId() << 24
        ids: list = []
        train: list = []
        held: list[np.ndarray] = []
        places: list[np.ndarray] = []
        waiting = 0

        def send() -> pa.RecordBatch:
            nonlocal flush, waiting
            w, k = np.concatenate(held), np.concatenate(places)
            lengths = np.array([len(t) for t in held], "<i8")
            learnt = np.array(train, np.uint32)
            doc = np.repeat(np.arange(len(held), dtype=np.uint32) * 2 + learnt, lengths)
            spread = w.copy()
            if len(often):
                at = np.minimum(np.searchsorted(often, w), len(often) - 1)
                is_hot = often[at] == w
                spread[is_hot] ^= mixed(k[is_hot] + np.uint64(1))
            shard = (mixed(spread) % np.uint64(shards)).astype(np.int32)
            order = np.lexsort((k, w, shard))
            w, k, doc, shard = w[order], k[order], doc[order], shard[order]
            edges = np.searchsorted(shard, np.arange(shards + 1))
            rows = []
            for s in range(shards):
                a, b = edges[s], edges[s + 1]
                if a < b:
                    new = np.flatnonzero(np.concatenate([[True], w[a + 1:b] != w[a:b - 1]]))
                    counts = np.diff(np.append(new, b - a)).astype("<u4")
                    before, place = np.unique(k[a:b], return_inverse=True)
                    rows.append((int(keys[s]), flush, _pack(w[a:b][new], counts, before,
                                                 place.astype("<u4"), doc[a:b])))
            known = np.array([i is not None for i in ids], np.uint8)
            listed = int(mixed(np.array([flush], np.uint64))[0] % np.uint64(shards))
            rows.append((-1 - listed, flush, _pack(np.array([i or 0 for i in ids], "<i8"), known,
                                          learnt.astype(np.uint8), lengths)))
            flush += 1
            waiting = 0
            for held_list in (ids, train, held, places):
                held_list.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))],
                names=["shard", "flush", "blob"])

        for part in parts:
            for doc_id, text, learn in zip(part.column(0).to_pylist(), texts_of(part.column(1)),
                                           part.column(2).to_pylist()):
                own = tokens_of(text)
                ids.append(doc_id)
                train.append(int(learn))
                held.append(own)
                places.append(contexts_of(own))
                waiting += len(own)
                if waiting >= FLUSH_TOKENS:
                    yield send()
        if held:
            yield send()

    return docs.select("doc_id", "text", "train").mapInArrow(
        run, "shard int, flush long, blob binary")


class Shard:
    """All tokens of a shard's words, reduced to (word, context) pairs.

    ``pair`` lists the pairs of one text's tokens after the other; ``flush``, ``doc`` and
    ``tokens`` are those texts and how many of the tokens each has.
    """

    KINDS = ("<u8", "<u8", "<u4", "<u4", "<u4", "<i8", "<u4", "<u4", "<u4", "<u4")

    def __init__(self, *fields: np.ndarray):
        (self.words, self.contexts, self.pairs, self.context, self.count,
         self.flushes, self.flush, self.doc, self.tokens, self.pair) = self.fields = fields
        self.word = np.repeat(np.arange(len(self.words), dtype=np.int32), self.pairs)
        self.count = self.count.astype(np.int64)
        self.total = np.bincount(self.word, self.count, len(self.words))

    def packed(self) -> bytes:
        return _pack(*(f.astype(k, copy=False) for f, k in zip(self.fields, self.KINDS)))

    @classmethod
    def unpacked(cls, blob: bytes) -> Shard:
        return cls(*_unpack(blob, *cls.KINDS))

    @classmethod
    def gathered(cls, frame: pd.DataFrame) -> Shard:
        """From what all flushes sent."""
        frame = frame.sort_values("flush")
        parts = [_unpack(b, "<u8", "<u4", "<u8", "<u4", "<u4") for b in frame["blob"]]
        sizes = np.array([len(p[4]) for p in parts])
        words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        word = np.repeat(at.astype(np.uint64), np.concatenate([p[1] for p in parts]))
        contexts, at = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
        at = at.astype(np.uint32)
        word <<= np.uint64(32)
        doc = np.concatenate([p[4] for p in parts])
        edges = np.append(0, np.cumsum(sizes))
        first = 0
        for k, n in enumerate(edges[:-1]):
            before, place = parts[k][2:4]
            parts[k] = None
            word[n:n + len(place)] |= at[first + place]
            first += len(before)
        del parts, at
        # As np.unique with its inverse, with fewer arrays of a value per token.
        order = np.argsort(word, kind="stable")
        word = word[order]
        new = np.concatenate([[True], word[1:] != word[:-1]])
        pair = word[new]
        del word
        place = np.empty(len(order), np.uint32)
        place[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
        del order
        count = np.bincount(place[(doc & 1).astype(bool)], minlength=len(pair)).astype(np.uint32)
        doc >>= 1
        new[:] = False
        for a, b in zip(edges[:-1], edges[1:]):
            # Stable: a text's pairs stay in their order.
            order = np.argsort(doc[a:b], kind="stable")
            doc[a:b], place[a:b] = doc[a:b][order], place[a:b][order]
            new[a] = True
            new[a + 1:b] = doc[a + 1:b] != doc[a:b - 1]
        new = np.flatnonzero(new)
        return cls(words, contexts, np.bincount((pair >> np.uint64(32)).astype(np.int64), minlength=len(words)),
                   (pair & np.uint64(0xFFFFFFFF)).astype(np.uint32), count, frame["flush"].to_numpy(),
                   (np.searchsorted(edges, new, side="right") - 1).astype(np.uint32), doc[new],
                   np.diff(np.append(new, len(doc))).astype(np.uint32), place)


class Dice:
    """Draws that depend on a key, the sweep and the customer alone."""

    def __init__(self, keys: np.ndarray, sweep: int):
        self.keys = mixed(keys ^ mixed(np.array([sweep + 1], np.uint64) * np.uint64(0xD6E8FEB86659FD93)))

    def binomial(self, which: np.ndarray, j: int, sizes: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """Successes among customers j, j + 1, ... of the ``which`` keys, ``sizes`` of each."""
        steps = np.arange(sizes.max(), dtype=np.uint64)
        draws = mixed(self.keys[which][:, None] + (steps + np.uint64(j)) * np.uint64(0x9E3779B97F4A7C15))
        hit = (draws >> np.uint64(11)) * 2.0 ** -53 < chance[:, None]
        return (hit & (steps < sizes[:, None])).sum(1)


def seat(count: np.ndarray, pull: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float,
         strength: float, rng: np.random.Generator | Dice) -> np.ndarray:
    """Tables of each dish after its ``count`` customers sat down one after the other.

    ``others`` tables of the restaurant serve other dishes; ``base`` is the
    parent's probability of the dish. ``pull`` selects dishes (indexes) to seat.
    """
    tables = np.minimum(count, 1)
    open_ = pull[count[pull] > 1]
    j = 1
    while len(open_):
        t = tables[open_]
        fresh = (strength + discount * (others[open_] + t)) * base[open_]
        chance = fresh / (fresh + np.maximum(j - discount * t, 1e-12))
        step = 1 if j < 64 else j // 16
        sizes = np.minimum(step, count[open_] - j)
        tables[open_] += (rng.binomial(open_, j, sizes, chance) if isinstance(rng, Dice)
                          else rng.binomial(sizes, chance))
        j += step
        open_ = open_[count[open_] > j]
    return tables


@dataclass
class State:
    """What all shards share of the seating after a sweep: the word restaurant."""

    hot_words: np.ndarray
    hot_counts: np.ndarray
    hot_served: np.ndarray
    hot_tables: np.ndarray
    tokens: int
    types: int
    word_customers: float
    word_tables: float


def word_base(served: np.ndarray, tables: np.ndarray, state: State, model: PitmanYor) -> np.ndarray:
    """Parent's predictive probability of words that ``served`` context tables ask for."""
    uniform = 1.0 / (state.types + 1)
    d, s = model.word_discount, model.word_strength
    return ((np.maximum(served - d * tables, 0.0) + (s + d * state.word_tables) * uniform)
            / (s + state.word_customers))


def word_tables(words: np.ndarray, served: np.ndarray, tables: np.ndarray, state: State,
                model: PitmanYor, sweep: int) -> np.ndarray:
    """Tables of the word restaurant, ``tables`` before; its customers are the contexts' tables."""
    uniform = np.full(len(served), 1.0 / (state.types + 1))
    others = np.maximum(state.word_tables - tables, 0.0)
    return seat(served.astype(np.int64), np.arange(len(served)), others, uniform,
                model.word_discount, model.word_strength, Dice(words, sweep))


def _hot_places(words: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(hot):
        return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
    at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
    return at, hot[at] == words


# Rows that shards and slices exchange; peer is the slice, the sweep of a seating or the flush of a list.
MAIL = "kind string, shard int, peer long, blob binary"
_DISHES = ("<u8", "<u4", "<u4", "<u4", "<u4", "<u8")


def _mail(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "shard", "peer", "blob"])


def _by_slice(contexts: np.ndarray, slices: int) -> list[tuple[int, np.ndarray]]:
    """(slice, indexes of its contexts), in the order of ``contexts``."""
    owner = (mixed(contexts) % np.uint64(slices)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(slices + 1))
    return [(s, order[a:b]) for s, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if a < b]


def _spread_back(news: pd.DataFrame, kind: str, contexts: np.ndarray, slices: int, peers: int = 1) -> np.ndarray:
    """Answers of all slices, ``peers`` arrays each, in the order of ``contexts``."""
    out = np.zeros((peers, len(contexts)), np.int64)
    mine = news[news["kind"] == kind]
    blobs = dict(zip(mine["peer"], mine["blob"]))
    for s, at in _by_slice(contexts, slices):
        out[:, at] = _unpack(blobs[s], *["<u4"] * peers)
    return out


def _totals(shard: int, values: list, hot: np.ndarray, hot_at: np.ndarray, served: np.ndarray,
            counts: np.ndarray) -> tuple:
    often = np.zeros((2, len(hot)))
    np.add.at(often[0], hot_at, counts)
    np.add.at(often[1], hot_at, served)
    return ("totals", shard, 0, np.concatenate([values, often.ravel()]).astype("<f8").tobytes())


def first_seats(frame: pd.DataFrame, slices: int, hot: np.ndarray) -> pd.DataFrame:
    """A shard's mail with one table per pair: its pairs of several customers, its
    contexts' customers and tables, and its totals. Beside it all its tokens, gathered
    once; the lists of a flush's documents go through as they are."""
    number = int(frame["shard"].iloc[0])
    if number < 0:
        return _mail([("listed", number, flush, blob) for flush, blob in zip(frame["flush"], frame["blob"])])
    shard = Shard.gathered(frame)
    learnt = np.minimum(shard.count, 1)
    served = np.bincount(shard.word, learnt, len(shard.words))
    many = np.flatnonzero(shard.count > 1)
    inner = np.zeros(len(shard.contexts), np.uint8)
    inner[shard.context[many]] = 1
    known = served > 0
    word_at, context_at = np.cumsum(known) - 1, np.cumsum(inner) - 1
    rows = [("tokens", number, 0, shard.packed()), ("dishes", number, 0, _pack(
        shard.words[known], served[known].astype("<u4"), word_at[shard.word[many]].astype("<u4"),
        context_at[shard.context[many]].astype("<u4"), shard.count[many].astype("<u4"),
        shard.contexts[inner > 0]))]
    customers = np.bincount(shard.context, shard.count, len(shard.contexts)).astype("<u4")
    tables = np.bincount(shard.context, learnt, len(shard.contexts)).astype("<u4")
    for s, at in _by_slice(shard.contexts, slices):
        rows.append(("room", number, s, _pack(shard.contexts[at], customers[at], tables[at], inner[at])))
    hot_at, is_hot = _hot_places(shard.words, hot)
    cold = known & ~is_hot
    rows.append(_totals(number, [shard.count.sum(), cold.sum(), served.sum(), cold.sum()], hot,
                        hot_at[is_hot], served[is_hot], shard.total[is_hot]))
    return _mail(rows)


def next_seats(dishes: pd.DataFrame, news: pd.DataFrame, slices: int, sweep: int, state: State,
               model: PitmanYor) -> pd.DataFrame:
    """One sweep over a shard, from the state after the sweep before."""
    if not len(dishes):
        return _mail([])
    number = int(dishes["shard"].iloc[0])
    words, fixed, word, context, count, contexts = _unpack(dishes["blob"].iloc[0], *_DISHES)
    count = count.astype(np.int64)
    room = _spread_back(news, "answer0", contexts, slices)[0]
    tables, own = np.ones(len(count), np.int64), np.ones(len(words), np.int64)
    if sweep:
        room = room + _spread_back(news, "answer", contexts, slices)[0]
        tables, own = _seating(news, sweep - 1)
    hot_at, is_hot = _hot_places(words, state.hot_words)
    served = _served(words, fixed, word, tables, hot_at, is_hot, state)
    base = word_base(served, _own(own, hot_at, is_hot, state), state, model)
    dice = Dice(words[word] ^ mixed(contexts[context] + np.uint64(1)), sweep)
    tables = seat(count, np.arange(len(count)), np.maximum(room[context] - tables, 0), base[word],
                  model.discount, model.strength, dice)
    mine = fixed + np.bincount(word, tables - 1, len(words))
    own = np.where(is_hot, 0, word_tables(words, np.where(is_hot, 0, mine), own, state, model, sweep))
    rows = [("seats", number, sweep, _pack(tables.astype("<u4"), own.astype("<u4")))]
    extra = np.bincount(context, tables - 1, len(contexts)).astype("<u4")
    for s, at in _by_slice(contexts, slices):
        rows.append(("extra", number, s, _pack(contexts[at], extra[at])))
    rows.append(_totals(number, [0, 0, mine.sum(), own.sum()], state.hot_words, hot_at[is_hot],
                        mine[is_hot], np.zeros(int(is_hot.sum()))))
    return _mail(rows)


def _seating(news: pd.DataFrame, sweep: int) -> list[np.ndarray]:
    held = news[(news["kind"] == "seats") & (news["peer"] == sweep)]["blob"].iloc[0]
    return [a.astype(np.int64) for a in _unpack(held, "<u4", "<u4")]


def _served(words: np.ndarray, fixed: np.ndarray, word: np.ndarray, tables: np.ndarray,
            hot_at: np.ndarray, is_hot: np.ndarray, state: State) -> np.ndarray:
    """Context tables per word of the shard; of a frequent word those of all shards."""
    served = fixed + np.bincount(word, tables - 1, len(words))
    if is_hot.any():
        served[is_hot] = state.hot_served[hot_at[is_hot]]
    return served


def _own(own: np.ndarray, hot_at: np.ndarray, is_hot: np.ndarray, state: State) -> np.ndarray:
    own = own.copy()
    if is_hot.any():
        own[is_hot] = state.hot_tables[hot_at[is_hot]]
    return own


def _sums(contexts: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Contexts, sorted, and the sums of their values."""
    if not contexts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    known, at = np.unique(np.concatenate(contexts), return_inverse=True)
    return known, np.bincount(at, np.concatenate(values), len(known)).astype(np.int64)


def _found(wanted: np.ndarray, known: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(wanted), "<u4")
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, values[at], 0).astype("<u4")


def answered(frame: pd.DataFrame) -> pd.DataFrame:
    """A slice's answers to the shards that sent it contexts of several customers:
    tables at first, or those that a sweep added."""
    number, rows = int(frame["peer"].iloc[0]), []
    if frame["kind"].iloc[0] == "room":
        mail = [_unpack(b, "<u8", "<u4", "<u4", "<u1") for b in frame["blob"]]
        sums = _sums([m[0] for m in mail], [m[2] for m in mail])
        mail = [(m[0][m[3] > 0],) for m in mail]
        kind = "answer0"
    else:
        mail = [_unpack(b, "<u8", "<u4") for b in frame["blob"]]
        sums = _sums([m[0] for m in mail], [m[1] for m in mail])
        kind = "answer"
    for shard, m in zip(frame["shard"], mail):
        if len(m[0]):
            rows.append((kind, shard, number, _pack(_found(m[0], *sums))))
    return _mail(rows)


def last_answers(rooms: pd.DataFrame, extras: pd.DataFrame, sweeps: list[int]) -> pd.DataFrame:
    """A slice's answers to all shards: customers, and tables after each of ``sweeps``."""
    if not len(rooms):
        return _mail([])
    mail = [_unpack(b, "<u8", "<u4", "<u4", "<u1") for b in rooms["blob"]]
    contexts, customers = _sums([m[0] for m in mail], [m[1] for m in mail])
    tables = _sums([m[0] for m in mail], [m[2] for m in mail])[1]
    values = [customers]
    for sweep in sweeps:
        more = [_unpack(b, "<u8", "<u4") for b in extras[extras["sweep"] == sweep]["blob"]]
        values.append(tables + _found(contexts, *_sums([m[0] for m in more], [m[1] for m in more])))
    number = int(rooms["peer"].iloc[0])
    return _mail([("last", shard, number, _pack(*(_found(m[0], contexts, v) for v in values)))
                  for shard, m in zip(rooms["shard"], mail)])


def probabilities(shard: Shard, news: pd.DataFrame, slices: int, states: dict[int, State],
                  model: PitmanYor) -> np.ndarray:
    """Predictive probability of each pair, averaged over the states after some sweeps."""
    customers, *rooms = _spread_back(news, "last", shard.contexts, slices, 1 + len(states))
    learnt = np.minimum(shard.count, 1)
    fixed = np.bincount(shard.word, learnt, len(shard.words))
    many, known = np.flatnonzero(shard.count > 1), fixed > 0
    mean = np.zeros(len(shard.count))
    for room, (sweep, state) in zip(rooms, states.items()):
        hot_at, is_hot = _hot_places(shard.words, state.hot_words)
        tables, own = learnt.copy(), np.zeros(len(shard.words), np.int64)
        tables[many], own[known] = _seating(news, sweep)
        served = _served(shard.words, fixed, shard.word[many], tables[many], hot_at, is_hot, state)
        base = word_base(served, _own(own, hot_at, is_hot, state), state, model)[shard.word]
        mean += ((shard.count - model.discount * tables
                  + (model.strength + model.discount * room[shard.context]) * base)
                 / (model.strength + customers[shard.context]))
    return mean / len(states)


def pair_rows(frame: pd.DataFrame, news: pd.DataFrame, slices: int, states: dict[int, State],
              model: PitmanYor) -> pd.DataFrame:
    """word, context, probability of a shard's pairs, held-out ones too."""
    shard = Shard.unpacked(frame["blob"].iloc[0])
    return pd.DataFrame({"word": shard.words.view(np.int64)[shard.word],
                         "context": shard.contexts.view(np.int64)[shard.context],
                         "probability": probabilities(shard, news, slices, states, model)})


def score_shard(frame: pd.DataFrame, news: pd.DataFrame, slices: int, states: dict[int, State],
                model: PitmanYor) -> pd.DataFrame:
    """Sums per flush and document over the tokens of a shard."""
    shard = Shard.unpacked(frame["blob"].iloc[0])
    state = next(iter(states.values()))
    hot_at, is_hot = _hot_places(shard.words, state.hot_words)
    total = shard.total.copy()
    total[is_hot] = state.hot_counts[hot_at[is_hot]]
    score = np.log10(probabilities(shard, news, slices, states, model))
    plain = np.log10((total + 1) / (state.tokens + state.types + 1))[shard.word]
    known = (total > 0)[shard.word]
    place = np.repeat(np.arange(len(shard.doc)), shard.tokens)
    # One value per token at a time: these arrays are a shard's largest.
    sums = [np.bincount(place, v[shard.pair], len(shard.doc)) for v in (known, plain, score)]
    edges = np.searchsorted(shard.flush, np.arange(len(shard.flushes) + 1))
    return pd.DataFrame({
        "flush": shard.flushes,
        "blob": [_pack(shard.doc[a:b], sums[0][a:b].astype("<u4"), *(s[a:b].astype("<f8") for s in sums[1:]))
                 for a, b in zip(edges[:-1], edges[1:])]})


def _added(frame: pd.DataFrame) -> pd.DataFrame:
    """Totals of many shards as one row."""
    total = sum(np.frombuffer(b, "<f8") for b in frame["blob"])
    return _mail([("totals", int(frame["shard"].iloc[0]), 0, total.astype("<f8").tobytes())])


def state_after(mail: DataFrame, sweep: int, before: State | None, hot: np.ndarray,
                model: PitmanYor) -> State:
    """The word restaurant summed over shards; frequent words are seated here."""
    # A fixed number of rows, however many shards there are.
    added = mail.where("kind = 'totals'").groupBy(F.pmod("shard", F.lit(TOTALS))).applyInPandas(_added, MAIL)
    parts = [np.frombuffer(r.blob, "<f8") for r in added.select("blob").collect()]
    sums = sum(parts, np.zeros(4 + 2 * len(hot)))
    counts, served = sums[4:4 + len(hot)], sums[4 + len(hot):]
    if before is None:
        own = (counts > 0).astype(np.int64)
        return State(hot, counts, served, own, int(sums[0]), int(sums[1]) + int(own.sum()), sums[2],
                     sums[3] + own.sum())
    own = word_tables(hot, served, before.hot_tables, before, model, sweep)
    return State(hot, before.hot_counts, served, own, before.tokens, before.types, sums[2],
                 sums[3] + own.sum())


def opened(blobs: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """The first mail of all shards and their tokens, from what was dealt.

    Bucketed by shard, so that all later passes over it need no shuffle.
    """
    own = blobs.repartition(shards, "shard").groupBy("shard").applyInPandas(
        lambda f: first_seats(f, shards, hot), MAIL)
    return bucketed(own, "shard", shards, "kind")


def swept(opening: DataFrame, shards: int, hot: np.ndarray,
          model: PitmanYor) -> tuple[DataFrame, dict[int, State]]:
    """(mail to the shards, states after the sampled sweeps); each sweep is one round."""
    def answers(mail: DataFrame) -> DataFrame:
        return materialise(mail.groupBy("peer").applyInPandas(answered, MAIL))

    def round_of(dishes: DataFrame, news: DataFrame, sweep: int, state: State) -> DataFrame:
        return materialise(dishes.groupBy("shard").cogroup(news.groupBy("shard")).applyInPandas(
            lambda d, n: next_seats(d, n, shards, sweep, state, model), MAIL))

    state = state_after(opening, -1, None, hot, model)
    dishes = opening.where("kind = 'dishes'")
    rooms = opening.where("kind = 'room'")
    first = news = answers(rooms)
    states, seats, extras = {}, [], []
    for sweep in range(model.burn_in + model.samples):
        mail = round_of(dishes, news, sweep, state)
        state = state_after(mail, sweep, state, hot, model)
        seated, extra = mail.where("kind = 'seats'"), mail.where("kind = 'extra'")
        if sweep >= model.burn_in:
            states[sweep] = state
            seats.append(seated)
            extras.append(extra.withColumn("sweep", F.lit(sweep)))
        if sweep + 1 < model.burn_in + model.samples:
            news = first.unionByName(seated).unionByName(answers(extra))
    every = extras[0]
    for extra in extras[1:]:
        every = every.unionByName(extra)
    sampled = list(states)
    news = rooms.groupBy("peer").cogroup(every.groupBy("peer")).applyInPandas(
        lambda r, e: last_answers(r, e, sampled), MAIL)
    for seated in seats:
        news = news.unionByName(seated)
    return news, states


def _summed(frame: pd.DataFrame, train_tokens: int) -> pd.DataFrame:
    """Rows of a flush's documents from its list and all shards' sums."""
    listed = frame["listed"].to_numpy(bool)
    ids, known, learnt, lengths = _unpack(frame["blob"][listed].iloc[0], "<i8", "<u1", "<u1", "<i8")
    sums = np.zeros((3, len(ids)))
    for blob in frame["blob"][~listed]:
        doc, *values = _unpack(blob, "<u4", "<u4", "<f8", "<f8")
        for total, value in zip(sums, values):
            total[doc] += value  # a document comes once in a blob
    return pd.DataFrame({
        "doc_id": pd.Series(ids, dtype="Int64").mask(known == 0),
        "held_out": learnt == 0, "n_tokens": lengths, "n_known": sums[0].astype(np.int64),
        "train_tokens": train_tokens, "base_score": sums[1], "score": sums[2]})


def _learnt(docs: DataFrame, modulus: int, held_out: int, model: PitmanYor,
            shard_tokens: int) -> tuple[DataFrame, DataFrame, int, dict[int, State]]:
    """(first mail and tokens by shard, last mail to the shards, shards, states)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       (id_remainder("doc_id", modulus) != held_out).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    shards = max(1, math.ceil(((size[0] or 0) / 6 + size[1]) / shard_tokens))
    hot = frequent(rows, HOT_SAMPLE, 1 / 1000)
    opening = opened(dealt(rows, shards, hot), shards, hot)
    news, states = swept(opening, shards, hot, model)
    return opening, news, shards, states


def pair_probabilities(docs: DataFrame, modulus: int = 7, held_out: int = 2, model: PitmanYor = PitmanYor(),
                       shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """word, context (their hashes), probability of every pair in ``docs``, held-out ones too."""
    opening, news, shards, states = _learnt(docs, modulus, held_out, model, shard_tokens)
    return opening.where("kind = 'tokens'").groupBy("shard").cogroup(news.groupBy("shard")).applyInPandas(
        lambda f, n: pair_rows(f, n, shards, states, model), "word long, context long, probability double")


def scored(docs: DataFrame, modulus: int = 7, held_out: int = 2, model: PitmanYor = PitmanYor(),
           shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs``.

    Rows whose id's crc32 leaves ``held_out`` are scored only, all others are
    learnt from as well.
    """
    opening, news, shards, states = _learnt(docs, modulus, held_out, model, shard_tokens)
    sums = opening.where("kind = 'tokens'").groupBy("shard").cogroup(news.groupBy("shard")).applyInPandas(
        lambda f, n: score_shard(f, n, shards, states, model), "flush long, blob binary")
    both = (sums.withColumn("listed", F.lit(False)).unionByName(
        opening.where("kind = 'listed'").select(F.col("peer").alias("flush"), "blob", F.lit(True).alias("listed"))))
    total = next(iter(states.values())).tokens
    return both.groupBy("flush").applyInPandas(
        lambda f: _summed(f, total),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
