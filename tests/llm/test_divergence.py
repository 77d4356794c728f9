"""Source divergence against exact integers in plain Python."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from marquee.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"


def make_rows():
    rng = random.Random(2)
    words = ["Alpha", "beta", "Ünï", "ÜNÏ", "的", "x", "gamma1delta", "don't"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 40))), rng.choice(["en", "de", None]),
             rng.choice(["s0", "s0", "s1", "S1", "é", None])) for k in range(150)]
    rows += [(900, None, "en", "only"), (901, "", "xx", "alone"), (902, "rare words", "yy", "a"),
             (903, "rare words", "yy", "b"), (None, "alpha", None, None)]
    return rows + rows[:4]


def expected(rows, min_docs, top=10):
    docs = [(lang or "", source or "", [
        "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = collections.Counter(t for _, _, terms in mine for t in set(terms))
        kept = sorted(t for t, n in seen.items() if n >= min_docs)
        sources = sorted({d[1] for d in mine})
        counts = {s: collections.Counter(t for _, o, terms in mine if o == s for t in terms if t in set(kept))
                  for s in sources}
        whole = sum(counts.values(), collections.Counter())

        def p(count):
            total = sum(count.values())
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        share, q = {s: p(counts[s]) for s in sources}, p(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(share[s][t], share[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(share[s][t], q[t]), t) for t in kept if counts[s][t] and share[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items[:most])]
    return sorted(out)


@pytest.mark.parametrize("slice_terms,block_rows,tile_sources", [(10**6, 10**6, 256), (15, 60, 2)])
def test_every_row(spark, slice_terms, block_rows, tile_sources, monkeypatch):
    monkeypatch.setattr(divergence, "LOOK_AT_ONE_IN", 2)
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in ("terms", "counts", "n", "p", "rank", "slice", "found"):
        df = df.withColumn(name, F.lit("clash"))
    got = divergence.audited(df, min_docs=10, slice_terms=slice_terms, block_rows=block_rows,
                             tile_sources=tile_sources)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                          ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == expected(rows, 10)


def test_counts_beyond_long_arithmetic(spark):
    n, total, terms = 7 * 10**11, 15 * 10**12, 10**8
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 2) // (total + 2 * terms)


def test_empty(spark):
    assert divergence.audited(spark.createDataFrame([], SCHEMA)).collect() == []


def test_documents_cut_together_keep_their_own_terms(spark, monkeypatch):
    """Few rows, whatever the number of documents; every document counts for itself."""
    docs = spark.createDataFrame([(k, "One two, one" if k % 2 else "", "en", f"s{k % 3 % 2}") for k in range(60)],
                                 SCHEMA).coalesce(1)
    rows = divergence.with_terms(docs).collect()
    assert len(rows) == 2 and sum(len(r.docs) for r in rows) == 60
    assert sorted(map(tuple, (d for r in rows for d in r.docs))) == [()] * 30 + [("one en", "two en", "one en")] * 30


@pytest.mark.parametrize("held,row_terms,slices", [(10**6, 10**6, 1), (60, 7, 3)])
def test_folded_documents_count_as_the_documents_do(spark, monkeypatch, held, row_terms, slices):
    """Far fewer terms reach the model; occurrences, and which terms are in enough documents, stay."""
    monkeypatch.setattr(divergence, "HELD_ENTRIES", held)
    monkeypatch.setattr(divergence, "ROW_TERMS", row_terms)
    rows = make_rows()
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    marked = list(divergence._marked(docs).toArrow().to_batches(max_chunksize=20))
    want, seen, occurrences = collections.Counter(), collections.Counter(), 0
    for part in divergence._cut(iter(marked)):
        for row in part.to_pylist():
            for terms in row["docs"]:
                want.update((row["lang"], row["source"], t) for t in terms)
                seen.update(set(terms))
                occurrences += len(terms)
    got, documents, written = collections.Counter(), collections.Counter(), 0
    for part in divergence._folded(slices, 10)(iter(marked)):
        for row in part.to_pylist():
            assert len(set(row["terms"])) == len(row["terms"]) <= row_terms
            written += len(row["terms"])
            for t in row["terms"]:
                if row["fit"]:
                    documents[t] += 1
                else:
                    got[row["lang"], row["source"], t] += row["weight"]
    assert got == want
    assert {t for t, n in documents.items() if n >= 10} == {t for t, n in seen.items() if n >= 10}
    assert all(documents[t] == n for t, n in seen.items() if n < 10)
    if held > 60:
        assert written < 2 * occurrences / 3


def test_blocks_are_merged_whole(monkeypatch):
    """Rows of a block that arrive in several batches are one sum, whatever is held."""
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD_ENTRIES", 5)
    rng = random.Random(4)
    rows = sorted((lang, source, block, sorted(rng.sample(range(4096 * block, 4096 * block + 6), 3)))
                  for lang in "ab" for source in "xyz" for block in (0, 3) for _ in range(rng.randint(1, 9)))
    want = collections.Counter((r[0], r[1], at) for r in rows for at in r[3])
    batches = pa.Table.from_arrays(
        [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(list(divergence._BLOCKS)[:4])]
        + [pa.array([[1] * 3] * len(rows), pa.list_(pa.int64()))], schema=divergence._BLOCKS).to_batches(max_chunksize=4)
    got = [tuple(r.values()) for part in divergence._merged(iter(batches)) for r in part.to_pylist()]
    assert len(got) == len(want) and {g[:3]: g[3] for g in got} == want
