"""Conversation structure repaired by the cheapest edits.

A conversation's rows, by turn, must become an optional system turn and then pairs of
user and assistant, or nothing at all. A row is kept, given the role user or
assistant, or deleted; blank rows and repeats have to go; empty turns of either role
can be inserted anywhere; a truncated row that stays costs extra. The edits span a
lattice: a node is a number of rows consumed and the role that came last. It is
searched by Dijkstra's method from both ends at once. When the two heaps' tops
together exceed the best path, every crossing of that cost is known, and the one
whose concatenated audit, a letter per edit, comes first in ASCII order is taken.
Equal costs into a node never leave one audit as the beginning of another, so the
least audit of a whole is made of least parts.

Conversations of up to ``LONG`` rows are solved where they lie, in tasks that
stream rows sorted by conversation. A longer one is never in one task's memory: its
rows are ordered by range, cut into pieces, every piece gives the cheapest audit
from each last role to each other one, and pieces are joined 64 at a time. What
remains per conversation is its audit, a byte per row, and the one pass that hands
out (or hashes) its repaired rows in order.

Defined results: a null id is a conversation of its own; null role and text count as
one space; rows without a turn come first; rows of one turn go by role, then by the
MD5 of their text; repeated rows are repeats of each other; an empty role, or one
that starts otherwise than with s, u or a, cannot be kept; ids without rows, and so
an empty table, give nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import materialise, small_batches

LONG = 512
JOINED = 64
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# What came last: nothing, the opening s, u, a. A conversation may end on nothing or on a.
_LAST = "-sua"
_STEP = {("-", "s"): "s", ("-", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
_ENDS = (0, 3)
_LEGAL = {"su", "ua", "au"}
_ROLE = {"u": "user", "a": "assistant"}
_SEEN = r"[^\x20\x09-\x0D]"


def _steps(letter: str, cost: int, initials: str) -> list[tuple[str, int, int, int]]:
    return [(letter, cost, a, _LAST.index(_STEP[last, i])) for a, last in enumerate(_LAST)
            for i in initials if (last, i) in _STEP]


_INSERTS = _steps("I", INSERT, "ua")


@cache
def _moves(symbol: str) -> list[tuple[str, int, int, int]]:
    """(letter, cost, last before, last after) for a row, an initial and its fault."""
    initial, fault = symbol
    out = [("D", DELETE, a, a) for a in range(len(_LAST))]
    if fault not in "bd":
        more = TRUNCATED if fault == "t" else 0
        out += _steps("K", more, initial) + _steps("R", REROLE + more, "ua")
    return out


def cheapest(symbols: list[str], start: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits of some rows between two last roles."""
    size = len(symbols)
    # At equal cost a move that costs nothing leads to a later entry of the heap, so
    # whatever reaches a node at its final cost has done so before it is settled.
    heaps: list[list] = [[(0, 0, "", start)], [(0, 0, "", g) for g in goals]]
    settled: list[dict] = [{}, {}]
    best: tuple[int, str] | None = None
    while heaps[0] or heaps[1]:
        tops = [h[0][0] if h else None for h in heaps]
        if best is not None and (None in tops or tops[0] + tops[1] > best[0]):
            break
        side = 0 if tops[1] is None or tops[0] is not None and tops[0] < tops[1] else 1
        cost, depth, audit, last = heapq.heappop(heaps[side])
        at = size - depth if side else depth
        if (at, last) in settled[side]:
            continue
        settled[side][at, last] = (cost, audit)
        here = settled[1 - side].get((at, last))
        if here:
            met = (cost + here[0], here[1] + audit if side else audit + here[1])
            best = met if best is None else min(best, met)
        steps = [(m, 0) for m in _INSERTS]
        if side and at:
            steps += [(m, -1) for m in _moves(symbols[at - 1])]
        elif not side and at < size:
            steps += [(m, 1) for m in _moves(symbols[at])]
        for (letter, price, a, b), by in steps:
            source, target = (b, a) if side else (a, b)
            if source != last:
                continue
            node = (at + by, target)
            path = letter + audit if side else audit + letter
            there = settled[1 - side].get(node)
            if there:
                met = (cost + price + there[0], there[1] + path if side else path + there[1])
                best = met if best is None else min(best, met)
            if node not in settled[side]:
                heapq.heappush(heaps[side], (cost + price, depth + abs(by), path, target))
    return best


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation."""
    kept = len(audit) - audit.count("D")
    place = -(kept % 2)  # an odd number starts with the system turn
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter in "IR":
            role = _ROLE["ua"[place % 2]]
        place += 1
        yield role, text


def _initial(role: str) -> str:
    return role[:1] if role[:1] in _LAST[1:] and role else "x"


def _fault(text: str, again: bool) -> str:
    shown = text.rstrip(" \t\n\x0b\x0c\r")
    if not shown:
        return "b"
    return "d" if again else "-" if shown[-1] in ".!?" else "t"


def _illegal(initials: str) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))


def solved(rows: list[tuple[int | None, str, str]]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit) of one conversation's rows."""
    seen: set[tuple[str, str]] = set()
    symbols = []
    for _, role, text in rows:
        symbols.append(_initial(role) + _fault(text, (role, text) in seen))
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults = [s[1] for s in symbols]
    cost, audit = cheapest(symbols, 0, _ENDS)
    return (gaps, *map(faults.count, "bdt"), _illegal("".join(s[0] for s in symbols)), cost, audit)


_FOUND = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, ")
_DIGEST = _FOUND + "repaired_sha256 string"
_TURNS = "conv string, place long, role string, text string"


def digest(audit: str, rows: Iterator[tuple[str, str]]) -> str:
    """SHA-256 of the repaired turns as lines of role and text, in a stream."""
    out = hashlib.sha256()
    for k, (role, text) in enumerate(edited(audit, rows)):
        out.update(f"{chr(10) * (k > 0)}{role}:{text}".encode())
    return out.hexdigest()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows_of(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for part in parts:
        yield from zip(*(part.column(i).to_pylist() for i in range(part.num_columns)))


def _grouped(rows: Iterator[tuple]) -> Iterator[tuple[str, Iterator[tuple]]]:
    """Runs of rows that share their first value; a run has to be used up before the next."""
    from itertools import groupby
    from operator import itemgetter

    return groupby(rows, key=itemgetter(0))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in ddl.split(", "))])


def _mapped(rows: DataFrame, ddl: str, each: Callable[[str, Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """``each`` over the conversations of rows that are sorted by conversation."""
    small_batches(rows.sparkSession)
    schema = _schema(ddl)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((out for conv, some in _grouped(_rows_of(parts)) for out in each(conv, some)), schema)

    return rows.mapInArrow(run, ddl)


def _short(digest_only: bool) -> Callable[[str, Iterator[tuple]], Iterator[tuple]]:
    def each(conv: str, some: Iterator[tuple]) -> Iterator[tuple]:
        rows = [r[1:] for r in some]
        found = solved(rows)
        turns = iter([r[1:] for r in rows])
        if digest_only:
            yield (conv, *found, digest(found[-1], turns))
        else:
            for place, (role, text) in enumerate(edited(found[-1], turns)):
                yield conv, place, role, text

    return each


# Long conversations: pieces between all last roles.
_PIECE = ("conv string, dated long, turn long, role string, md5 string, seq long, blank long, "
          "duplicate long, truncated long, illegal long, first string, final string, costs array<long>, "
          "audits array<string>")


def _piece(symbols: list[str]) -> tuple:
    """Counts, first and last initial, costs and audits of a piece for every two last roles."""
    costs, audits = [], []
    for a in range(len(_LAST)):
        for b in range(len(_LAST)):
            found = cheapest(symbols, a, (b,))
            costs.append(found[0] if found else None)
            audits.append(found[1] if found else None)
    faults = [s[1] for s in symbols]
    initials = "".join(s[0] for s in symbols)
    return (*map(faults.count, "bdt"), _illegal(initials), initials[0], initials[-1], costs, audits)


def _cut(size: int) -> Callable[[str, Iterator[tuple]], Iterator[tuple]]:
    """Pieces of ``size`` rows; a row comes with its number of equal copies."""
    def each(conv: str, some: Iterator[tuple]) -> Iterator[tuple]:
        symbols: list[str] = []
        key, seq = (), 0
        for _, dated, turn, role, md5, fault, copies in some:
            initial = _initial(role)
            for k in range(copies):
                if not symbols:
                    key = (dated, turn, role, md5, seq)
                symbols.append(initial + (fault if not k or fault == "b" else "d"))
                if len(symbols) == size:
                    yield (conv, *key, *_piece(symbols))
                    symbols, seq = [], seq + 1
        if symbols:
            yield (conv, *key, *_piece(symbols))

    return each


def _both(one: dict, two: dict) -> dict:
    """Two neighbouring pieces as one."""
    n = len(_LAST)
    costs: list = [None] * n * n
    audits: list = [None] * n * n
    for a in range(n):
        for b in range(n):
            ways = [(one["costs"][a * n + m] + two["costs"][m * n + b],
                     one["audits"][a * n + m] + two["audits"][m * n + b]) for m in range(n)
                    if one["audits"][a * n + m] is not None and two["audits"][m * n + b] is not None]
            if ways:
                costs[a * n + b], audits[a * n + b] = min(ways)
    sums = {c: one[c] + two[c] for c in ("blank", "duplicate", "truncated", "illegal")}
    sums["illegal"] += one["final"] + two["first"] not in _LEGAL
    return {**one, **sums, "final": two["final"], "costs": costs, "audits": audits}


_NUMBERED = ("conv string, no long, blank long, duplicate long, truncated long, illegal long, "
             "first string, final string, costs array<long>, audits array<string>")


def _join_pieces(frame: pd.DataFrame, joined: int) -> pd.DataFrame:
    """One piece from up to ``joined`` neighbours, two by two."""
    pieces = frame.sort_values("no").to_dict("records")
    for piece in pieces:
        piece["costs"] = [None if pd.isna(c) else int(c) for c in piece["costs"]]
    while len(pieces) > 1:
        pieces = [_both(*pieces[i:i + 2]) if i + 1 < len(pieces) else pieces[i]
                  for i in range(0, len(pieces), 2)]
    pieces[0]["no"] //= joined
    return pd.DataFrame(pieces)[[c.split(" ")[0] for c in _NUMBERED.split(", ")]]


_ORDER = ["conv", "dated", "turn", "role", "md5"]


def _ordered_key() -> list[Column]:
    return [F.col("turn").isNotNull().cast("long").alias("dated"), F.col("turn")]


def _long_found(rows: DataFrame, size: int, joined: int) -> tuple[DataFrame, DataFrame]:
    """(what was found per long conversation, its distinct rows in order keys, with copies)."""
    same = (rows.groupBy(*_ORDER, "text").agg(F.count("*").alias("copies")))
    kept = materialise(same)
    firsts = kept.groupBy("conv", "role", "md5").agg(F.min(F.struct("dated", "turn")).alias("earliest"))
    fault = (F.when(~F.col("text").rlike(_SEEN), "b")
             .when(F.struct("dated", "turn") != F.col("earliest"), "d")
             .when(F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1).isin(".", "!", "?"), "-")
             .otherwise("t"))
    marked = kept.join(firsts, ["conv", "role", "md5"]).select(*_ORDER, fault.alias("fault"), "copies")
    in_order = marked.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    pieces = materialise(_mapped(in_order, _PIECE, _cut(size)))
    by_key = Window.partitionBy("conv").orderBy("dated", "turn", "role", "md5", "seq")
    names = [c.split(" ")[0] for c in _NUMBERED.split(", ")]
    now = materialise(pieces.withColumn("no", (F.row_number().over(by_key) - 1).cast("long")).select(names))
    while now.agg(F.coalesce(F.max("no"), F.lit(0))).first()[0] > 0:
        now = materialise(now.groupBy("conv", F.floor(F.col("no") / joined)).applyInPandas(
            lambda frame: _join_pieces(frame, joined), _NUMBERED))
    turns = (kept.where("turn is not null").select("conv", "turn").distinct().groupBy("conv")
             .agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")))
    ways = F.array_min(F.transform(F.array(*(F.lit(e) for e in _ENDS)), lambda e: F.struct(
        F.get("costs", e).alias("cost"), F.get("audits", e).alias("audit"))))
    found = now.join(turns, "conv", "left").withColumn("way", ways).select(
        "conv", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        "way.cost", "way.audit")
    return materialise(found), kept


def _handed_out(digest_only: bool) -> Callable[[str, Iterator[tuple]], Iterator[tuple]]:
    """A conversation's first row holds its audit, the others its rows in order."""
    def each(conv: str, some: Iterator[tuple]) -> Iterator[tuple]:
        audit = next(some)[5]
        rows = ((role, text) for _, _, _, role, _, text, copies in some for _ in range(copies))
        if digest_only:
            yield conv, digest(audit, rows)
        else:
            for place, (role, text) in enumerate(edited(audit, rows)):
                yield conv, place, role, text

    return each


def _long_rows(found: DataFrame, kept: DataFrame, digest_only: bool) -> DataFrame:
    heads = found.select("conv", F.lit(-1).cast("long").alias("dated"), F.lit(None).cast("long").alias("turn"),
                         F.lit("").alias("role"), F.lit("").alias("md5"), F.col("audit").alias("text"),
                         F.lit(1).cast("long").alias("copies"))
    rows = heads.unionByName(kept).repartition("conv").sortWithinPartitions(*_ORDER).select(*_ORDER, "text", "copies")
    return _mapped(rows, "conv string, repaired_sha256 string" if digest_only else _TURNS,
                   _handed_out(digest_only))


def _keyed(conversations: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        text("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        text("role").alias("role"), text("text").alias("text"))
    return rows.select("conv", *_ordered_key(), "role", F.md5("text").alias("md5"), "text")


def _solved(conversations: DataFrame, digest_only: bool, long: int, joined: int) -> DataFrame:
    rows = _keyed(conversations)
    # At most one conversation in ``long`` rows; the optimiser broadcasts them by their size or not.
    large = materialise(rows.groupBy("conv").agg(F.count("*").alias("n")).where(F.col("n") > long).select("conv"))
    few = (rows.join(large, "conv", "left_anti").repartition("conv").sortWithinPartitions(*_ORDER)
           .select("conv", "turn", "role", "text"))
    short = _mapped(few, _DIGEST if digest_only else _TURNS, _short(digest_only))
    found, kept = _long_found(rows.join(large, "conv", "left_semi"), long, joined)
    rest = _long_rows(found, kept, digest_only)
    out = short.unionByName(found.join(rest, "conv") if digest_only else rest)
    kind = conversations.schema["conv_id"].dataType
    return out.select(F.when(F.col("conv") != " ", F.col("conv")).cast(kind).alias("conv_id"),
                      *[c for c in out.columns if c != "conv"])


def repaired(conversations: DataFrame, long: int = LONG, joined: int = JOINED) -> DataFrame:
    """conv_id, place, role, text: the turns of every repaired conversation."""
    return _solved(conversations, False, long, joined)


def audited(conversations: DataFrame, long: int = LONG, joined: int = JOINED) -> DataFrame:
    """conv_id, the counts of faults, cost, audit and the SHA-256 of the repaired turns."""
    return _solved(conversations, True, long, joined)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults put in, chosen by a checksum of id and turn."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                                code.alias("code")).where("code != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
