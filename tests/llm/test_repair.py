"""Repair of conversations against plain dynamic programming."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm import repair
from marquee.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(symbols):
    """(cost, audit) by trying every edit row by row, least audits kept."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def put(labels, last, cost, audit):
        if last not in labels or (cost, audit) < labels[last]:
            labels[last] = (cost, audit)

    def grown(labels):
        for _ in range(3):
            for last, (cost, audit) in list(labels.items()):
                for i in "ua":
                    if (last, i) in step:
                        put(labels, step[last, i], cost + 3, audit + "I")
        return labels

    labels = grown({"": (0, "")})
    for initial, fault in symbols:
        after = {}
        for last, (cost, audit) in labels.items():
            put(after, last, cost + 4, audit + "D")
            if fault in "bd":
                continue
            more = 3 * (fault == "t")
            if (last, initial) in step:
                put(after, step[last, initial], cost + more, audit + "K")
            for i in "ua":
                if (last, i) in step:
                    put(after, step[last, i], cost + 3 + more, audit + "R")
        labels = grown(after)
    return min(labels[e] for e in ("", "a") if e in labels)


def test_both_searches_meet_at_the_least_audit():
    rng = random.Random(3)
    for _ in range(1500):
        symbols = [rng.choice("suuaax") + rng.choice("---tbd") for _ in range(rng.randint(0, 9))]
        assert repair.cheapest(symbols, 0, (0, 3)) == brute(symbols), symbols


def test_pieces_join_to_the_whole():
    rng = random.Random(4)
    names = ("blank", "duplicate", "truncated", "illegal", "first", "final", "costs", "audits")
    for _ in range(60):
        symbols = [rng.choice("suuaax") + rng.choice("---tbd") for _ in range(rng.randint(2, 30))]
        cut = rng.randint(1, len(symbols) - 1)
        one, two = (dict(zip(names, repair._piece(s))) for s in (symbols[:cut], symbols[cut:]))
        assert repair._both(one, two) == dict(zip(names, repair._piece(symbols)))
        whole = repair._both(one, two)
        assert min((whole["costs"][e], whole["audits"][e]) for e in (0, 3)
                   if whole["audits"][e] is not None) == brute(symbols)


def test_fixed_cases():
    assert repair.cheapest([], 0, (0, 3)) == (0, "")
    assert repair.cheapest(["s-"], 0, (0, 3)) == (4, "D")
    assert repair.cheapest(["u-", "a-"], 0, (0, 3)) == (0, "KK")
    assert repair.cheapest(["a-", "u-"], 0, (0, 3)) == brute(["a-", "u-"])
    turns = iter([("system", "S."), ("user", "U."), ("user", "V."), ("assistant", "A.")])
    assert list(repair.edited("KDKK", turns)) == [("system", "S."), ("user", "V."), ("assistant", "A.")]
    assert list(repair.edited("KI", iter([("user", "U.")]))) == [("user", "U."), ("assistant", "")]
    assert list(repair.edited("KRI", iter([("system", "S."), ("tool", "T.")]))) == [
        ("system", "S."), ("user", "T."), ("assistant", "")]


def make_rows(rng, n_conv, most):
    rows = []
    for conv in range(n_conv):
        turn = 0
        for k in range(rng.randint(1, most)):
            turn += rng.choice([0, 1, 1, 1, 2])
            rows.append((conv, None if rng.random() < 0.05 else turn,
                         rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "sys"]),
                         rng.choice(["Yes.", "No", "", " \t", None, f"Text {k}!", f"More {k} \n", "é?", "x" * 300])))
    return rows + rows[:3] + [(None, 1, "user", "Q?"), (None, 2, "assistant", "A."), (None, None, None, None)]


def expected(rows):
    """Per id, what the definition gives."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, symbols = set(), []
        for _, role, text in mine:
            shown = text.rstrip(" \t\n\x0b\x0c\r")
            fault = ("b" if not shown else "d" if (role, text) in seen
                     else "-" if shown[-1] in ".!?" else "t")
            symbols.append(((role[:1] or "x") if role[:1] in ("s", "u", "a") else "x", fault))
            seen.add((role, text))
        turns = {t for t, _, _ in mine if t is not None}
        cost, audit = brute(symbols)
        lines = [f"{r}:{x}" for r, x in repair.edited(audit, iter([m[1:] for m in mine]))]
        faults = [f for _, f in symbols]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *map(faults.count, "bdt"),
                     sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.mark.parametrize("long", [3, 512])
def test_short_and_long_conversations_alike(spark, long):
    rows = make_rows(random.Random(8), 30, 25)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("conv", "audit", "md5", "dated", "code", "copies"):
        df = df.withColumn(name, F.lit("clash"))
    got = {r.conv_id: tuple(r)[1:] for r in repair.audited(df, long=long).collect()}
    assert got == expected(rows)
    turns = {}
    for r in repair.repaired(df, long=long).collect():
        turns.setdefault(r.conv_id, []).append((r.place, f"{r.role}:{r.text}"))
    for conv, found in got.items():
        text = "\n".join(line for _, line in sorted(turns.get(conv, [])))
        assert hashlib.sha256(text.encode()).hexdigest() == found[-1]


def test_many_pieces(spark):
    rows = [(1, k, ("user", "assistant")[(k // 7 + k) % 2], f"T{k % 90}{'.' * (k % 3)}") for k in range(400)]
    got = repair.audited(spark.createDataFrame(rows, SCHEMA), long=10, joined=3).collect()
    assert [tuple(r)[1:] for r in got] == [expected(rows)[1]]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.audited(repair.damaged(empty)).collect() == []
    assert repair.repaired(empty).collect() == []


def test_ids_whose_rows_are_all_dropped(spark, tmp_path):
    rows = [(k, 0, "user", "Only.") for k in range(200)] + [(None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()
    assert len(got) == 201
    gone = [r for r in got if not r.audit]
    assert gone and all(r.repaired_sha256 == hashlib.sha256(b"").hexdigest() and r.cost == 0 for r in gone)
