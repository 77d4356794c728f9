"""Training-data operators against brute force on small tables with edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marquee.llm import (
    components, decontam, linededup, lm, packing, phrases, quality, repeats, simhash, suffixdedup,
    toxicity, urlfilter,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ("digest", "spans", "shard", "words", "lines", "fp", "train", "stratum", "n_lines")


def word(rng):
    return "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    words = [word(rng) for _ in range(n)]
    return " ".join(w + rng.choice(["", "", ".", "\n", "\n\n", "\t"]) for w in words)


def make_docs():
    """Copies, near copies, shared passages, repeats, empty and odd texts, null cells."""
    rng = random.Random(5)
    passage, line = prose(rng, 60), "the same line again"
    base = [prose(rng, rng.randint(1, 160)) for _ in range(40)]
    texts = base + base[:6] + [b + " x" for b in base[:6]]
    texts += [prose(rng, 20) + " " + passage + " " + prose(rng, 20) for _ in range(8)]
    texts += [line + "\n" + line + "\n" + prose(rng, 9) + "\n" + line + "\n" + line] * 2
    texts += ["", " \t\n", None, "a", "same " * 300, "z" * 500, passage + passage,
              "ab" * 200 + "\n" + "ab" * 200, "Ünï çödé " * 40, "A B c d", "# | ### $$ <a> &", base[7] * 4]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i * 3 - 20, t, rng.choice(["en", "de", None]), "s", 1) for i, t in zip(ids, texts)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The rows with further columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in EXTRA:
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated rows, a shared id, null ids."""
    text = " ".join(f"w{i}" for i in range(40))
    return spark.createDataFrame(
        [(1, text, "en", "s", 1)] * 2 + [(1, "other " + text, None, None, None), (None, text, "en", "s", 1),
                                         (None, None, None, None, None), (7, text, "en", "s", 1)], SCHEMA)


def bytes_left(rows, width=100):
    order = sorted((i, (t or "").encode()) for i, t, *_ in rows)
    seen, out = {}, {}
    for i, b in order:
        for j in range(len(b) - width + 1):
            seen.setdefault(b[j:j + width], (i, j))
    for i, b in order:
        gone = [False] * len(b)
        for j in range(len(b) - width + 1):
            if seen[b[j:j + width]] != (i, j):
                gone[j:j + width] = [True] * width
        out[i] = (len(b), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)),
                  bytes(c for c, g in zip(b, gone) if not g))
    return out


def check_suffixes(docs, rows):
    want = bytes_left(rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in suffixdedup.deduplicated(docs).collect()}
    assert got == want
    assert any(n for _, n, _, _ in want.values())


def test_suffix_dedup(docs, rows):
    check_suffixes(docs, rows)


def test_suffix_dedup_with_hot_anchors_and_many_shards(docs, rows, monkeypatch):
    monkeypatch.setattr(repeats, "LEAST_HOT", 3)
    monkeypatch.setattr(repeats, "SHARD_SEGMENTS", 20)
    monkeypatch.setattr(repeats, "FLUSH_SEGMENTS", 7)
    recurring = repeats.recurring
    monkeypatch.setattr(repeats, "recurring", lambda d, k: recurring(d, k, least_hot=3))
    check_suffixes(docs, rows)


def test_suffix_dedup_edge_cases(empty, odd):
    assert suffixdedup.deduplicated(empty).count() == 0
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffixdedup.deduplicated(odd).collect())
    size = len(" ".join(f"w{i}" for i in range(40)))
    # The row without an id comes first and keeps all; rows equal in id and text fare alike.
    assert got[0] == (0, 0, 0) and got[1] == (0, size, 0)
    assert got[2] == got[3] == (1, size, size) and got[4] == (1, size + 6, size)
    assert got[5] == (7, size, size)


def test_suffix_dedup_of_nul_bytes(spark):
    nul = "\0" * 200
    texts = [nul, nul, "a" + nul + "b" * 50, nul + "c" * 300 + nul]
    check_suffixes(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA),
                   [(i, t) for i, t in enumerate(texts)])


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(1)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 30)))
            for _ in range(7)]
    shared = [suffixdedup.front_code(r)[0].tolist() for r in runs]
    got = [(runs[r][i], n) for r, i, n in suffixdedup.merge(runs, shared)]
    want = sorted(k for r in runs for k in r)
    assert [k for k, _ in got] == want
    for (a, _), (b, n) in zip(got, got[1:]):
        assert n == suffixdedup.shared_length(a, b, 0)
    assert list(suffixdedup.merge([], [])) == [] and list(suffixdedup.merge([[b"x"]], [[0]])) == [(0, 0, 0)]


def test_packed_runs_round_trip():
    entries = [(b"banana", 2, 3, [(1, 2, 3, 104)]), (b"ban", 1, 1, [(5, 6, 7, 107), (-9, 9, 9, 109)])]
    run = suffixdedup.Run(suffixdedup.pack_run(list(entries)))
    assert run.keys == [b"ban", b"banana"] and run.segments == [(1, 1), (2, 3)] and run.ends == [2, 3]
    assert run.places == [(5, 6, 7), (-9, 9, 9), (1, 2, 3)] and run.shared == [0, 3]


def phrases_left(rows, width=13):
    order = sorted((i, (t or "").encode().split()) for i, t, *_ in rows)
    seen, out = {}, {}
    for i, w in order:
        for j in range(len(w) - width + 1):
            seen.setdefault(tuple(w[j:j + width]), i)
    for i, w in order:
        gone = set()
        for j in range(len(w) - width + 1):
            if seen[tuple(w[j:j + width])] < i:
                gone.update(range(j, j + width))
        out[i] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def check_phrases(docs, rows):
    want = phrases_left(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in phrases.deduplicated(docs).collect()}
    assert got == want
    assert any(n for _, n, _ in want.values())


def test_phrase_automata(docs, rows):
    check_phrases(docs, rows)


def test_phrase_automata_with_hot_anchors_and_many_shards(docs, rows, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_SEGMENTS", 20)
    monkeypatch.setattr(repeats, "FLUSH_SEGMENTS", 7)
    recurring = repeats.recurring
    monkeypatch.setattr(repeats, "recurring", lambda d, k: recurring(d, k, least_hot=3))
    check_phrases(docs, rows)


def test_phrase_edge_cases(empty, odd):
    assert phrases.deduplicated(empty).count() == 0
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in phrases.deduplicated(odd).collect())
    assert got == [(0, 0, 0), (0, 40, 0), (1, 40, 40), (1, 40, 40), (1, 41, 40), (7, 40, 40)]


def test_anchors_cover_every_window_once():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = rng.integers(0, 60, 6)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        h = rng.integers(1, 6, starts[-1]).astype(np.uint64)
        batch = repeats.Batch(np.arange(6), np.arange(6), h, starts, None)
        doc, place, first, last = repeats.anchors(batch, 12, 4)
        covered = sorted(s for a, b in zip(first, last) for s in range(a, b + 1))
        want = [s for a, b in zip(starts, starts[1:]) for s in range(a, b - 11)]
        assert covered == want
        for p, a, b in zip(place, first, last):
            for s in range(a, b + 1):
                own = h[s:s + 9]
                assert p == s + max(i for i in range(9) if own[i] == own.min())
        assert (np.searchsorted(starts, place, side="right") - 1 == doc).all()


def brute_simhash(rows):
    fps = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        grams = [b" ".join(w[j:j + 3]) for j in range(max(1, len(w) - 2))] if w else []
        hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (fps[i], find(i)) for i in ids}


def test_simhash_groups(docs, rows):
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.simhash_groups(docs).collect()}
    assert got == brute_simhash(rows)


@pytest.mark.parametrize("limit", [1, 4, 64])
def test_links_are_whole_whatever_the_bucket_limit(spark, limit):
    rng = random.Random(limit)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    values = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for s in seeds for _ in range(25)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    classes = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in components.components(
        simhash.links(classes, 2, bucket_limit=limit)).collect()}
    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2:
                assert roots.get(a, a) == roots.get(b, b)
    # Components hold no more than links explain.
    near = collections.defaultdict(set)
    for a in signed:
        for b in signed:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2:
                near[a].add(b)
    for a, r in roots.items():
        seen, todo = {a}, [a]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert r == min(seen)


def test_threshold_allocation_is_least_cost():
    costs = [[5, 50], [1, 2], [9, 90]]
    # Every threshold from -1 (skipped, free) to 1; they have to sum to the budget.
    for budget in range(-3, 4):
        every = [(sum(c[t] if t >= 0 else 0 for c, t in zip(costs, picks)), list(picks))
                 for picks in itertools.product((-1, 0, 1), repeat=3) if sum(picks) == budget]
        price, picks = simhash.allocate(costs, budget)
        assert sum(picks) == budget and price == min(every)[0]


def test_simhash_edge_cases(empty, odd):
    assert simhash.simhash_groups(empty).count() == 0
    got = simhash.simhash_groups(odd).collect()
    assert len(got) == 6 and {r.component_id for r in got if r.fp} <= {1}
    assert [r.component_id for r in got if r.fp == 0] == [None]
    kept = simhash.keep_one_per_group(odd).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [(False, 1), (True, None)]
    copies = odd.where("doc_id is null").union(odd.where("doc_id is null"))
    assert sorted(r.text or "" for r in simhash.keep_one_per_group(copies).collect()) == [
        "", " ".join(f"w{i}" for i in range(40))]


def test_rows_of_one_id_with_different_texts_are_kept_apart(spark):
    rng = random.Random(9)
    texts = [" ".join(f"{rng.choice('abc')}{rng.randrange(10_000)}" for _ in range(60)) for _ in range(2)]
    docs = spark.createDataFrame([(4, texts[0]), (4, texts[1]), (5, texts[1]), (6, texts[0]), (4, texts[0])],
                                 "doc_id long, text string")
    kept = simhash.keep_one_per_group(docs).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted((4, t) for t in texts)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(5, 5)]
    random.Random(2).shuffle(chain)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[200 + i] == 100 for i in range(50))


SPACE = re.compile("[^\x20\x09-\x0D]+")


def test_quality_counts(docs, rows):
    got = {r.doc_id: tuple(r)[1:] for r in quality.measured(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    for i, t, *_ in rows:
        w = SPACE.findall(t or "")
        places = collections.defaultdict(list)
        for j in range(len(w) - 7):
            places[tuple(w[j:j + 8])].append(j)
        gone = {j + k for v in places.values() if len(v) > 1 for j in v for k in range(8)}
        lines = [x for x in (t or "").split("\n") if SPACE.search(x)]
        assert got[i] == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for x in w for c in x),
                          len(lines) - len(set(lines)), len(gone)), t


def test_binomial_tail(spark):
    cases = [(0, 10), (3, 50), (40, 1000), (0, 1)]
    df = spark.createDataFrame(cases, "k long, n long")
    got = [r[0] for r in df.select(quality.binomial_tail(F.col("k"), F.col("n"), 0.03)).collect()]
    for (k, n), g in zip(cases, got):
        assert g == pytest.approx(sum(math.comb(n, i) * 0.03**i * 0.97**(n - i) for i in range(k + 1)))


def test_cutoffs_are_safe_and_reject_junk(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(3000):
        junk = i % 10 == 0
        words = [word(rng) for _ in range(40)]
        if junk:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), "en" if i % 2 else "de"))
        labels.append((i, int(not junk)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.judged(docs, marks).collect()
    good = [r for r in got if r.doc_id % 10]
    assert sum(not r.kept for r in good) <= 0.05 * len(good)
    assert not any(r.kept for r in got if r.doc_id % 10 == 0)
    # Too few labels prove nothing: only the base rules reject.
    few = quality.judged(docs, marks.where("doc_id < 40")).collect()
    assert all(r.kept != r.base_failed for r in few)


def test_quality_edge_cases(spark, empty, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (7, None)], "doc_id long, quality int")
    assert quality.judged(empty, labels).count() == 0
    got = quality.judged(odd, labels).collect()
    assert len(got) == 6 and sum(r.base_failed for r in got) == 1
    assert quality.judged(odd.drop("lang"), labels.limit(0)).count() == 6


@pytest.mark.parametrize("run", [2, 3])
def test_line_dedup(docs, rows, run):
    order = sorted((i, t) for i, t, *_ in rows if t is not None)
    seen = {}
    held = {i: [(k, x) for k, x in enumerate(t.split("\n")) if SPACE.search(x)] for i, t in order}
    runs = {i: [tuple(some[j:j + run]) for j in range(len(some) - run + 1)]
            + [(x,) for x in some if len(SPACE.findall(x[1])) > 20] for i, some in held.items()}
    for i, _ in order:
        for some in sorted(runs[i]):
            seen.setdefault(tuple(x for _, x in some), (i, some[0][0]))
    got = {r.doc_id: r for r in linededup.deduplicated(docs, run=run).collect()}
    assert len(got) == len(rows) and got[next(i for i, t, *_ in rows if t is None)].text is None
    for i, t in order:
        gone = {k for some in runs[i] if seen[tuple(x for _, x in some)] != (i, some[0][0]) for k, _ in some}
        lines = t.split("\n")
        assert got[i].text == "\n".join(x for k, x in enumerate(lines) if k not in gone)
        assert (got[i].n_lines, got[i].removed_lines) == (len(lines), len(gone))


def test_every_window_has_one_fingerprint(spark):
    """Window minima are fewer than windows, and each window stands at its own."""
    rng = random.Random(8)
    texts = ["\n".join(f"line {rng.randrange(40)}" for _ in range(n)) for n in (0, 1, 2, 3, 30, 200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for run in (2, 4):
        got = {}
        for r in linededup.fingerprints(docs, run, None).collect():
            got.setdefault(r.doc_id, []).append((r.at, [w.start for w in r.windows]))
        for i, text in enumerate(texts):
            n = len(text.split("\n")) if text else 0
            places = got.get(i, [])
            starts = [s for at, some in places for s in some if s <= at < s + run]
            assert sorted(starts) == list(range(1, n - run + 2))
            assert len(places) == len({at for at, _ in places}) <= max(0, n - run + 1)
    assert len(got[5]) < 0.6 * 197


def test_one_line_of_forty_words_in_four_documents(spark):
    line = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(k, f"own {k}\n{line}\nlast {k}") for k in range(4)], "doc_id long, text string")
    got = {r.doc_id: r.removed_lines for r in linededup.deduplicated(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1}


def test_line_dedup_edge_cases(spark, empty):
    assert linededup.deduplicated(empty).count() == 0
    two = "one line\nand two"
    odd = spark.createDataFrame(
        [(None, two), (1, two), (1, two), (2, "\n" + two + "\n"), (3, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.text) for r in linededup.deduplicated(odd).collect()), key=repr)
    assert got == [(0, two), (1, ""), (1, ""), (2, "\n"), (3, None)]


def test_line_dedup_of_a_single_long_line(spark):
    long = " ".join(f"w{i}" for i in range(51))
    texts = [f"a\n{long}\nb", f"c\n{long}\nd", long, long[:-4], long[:-4], f"x\n{long}", "a\nq"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.deduplicated(docs, long_line=50).collect()}
    assert got == {0: texts[0], 1: "c\nd", 2: "", 3: long[:-4], 4: long[:-4], 5: "x", 6: "a\nq"}
    from corpus_pipeline import line_stage

    # The default counts lines of over 20 words.
    assert {r.doc_id: r.text for r in line_stage(spark, docs, "").collect()} == {**got, 4: ""}


def tokens(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("block", [50_000, 7])
def test_decontamination(spark, docs, rows, block):
    texts = [t for _, t, *_ in rows if t and len(t) > 200]
    items = [(i, " ".join(t.split()[3:30]).upper()) for i, t in enumerate(texts[:12])]
    items += [(50, "a B c"), (51, "same same"), (52, None), (53, "!!"), (None, texts[0]), (54, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = tokens(t)
        if w and i is not None:
            for j in range(max(1, len(w) - 9)):
                windows[tuple(w[j:j + 10])].add(str(i))
    want = {}
    for i, t, *_ in rows:
        w, hit, ids = tokens(t), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    ids |= windows[tuple(w[j:j + n])]
        want[i] = (len(w), len(hit), sorted(ids))
    hits = decontam.hits(docs, bench, block_windows=block).select("doc_id", "n_hit").collect()
    assert {r.doc_id: r.n_hit for r in hits} == {i: h for i, (_, h, _) in want.items() if h}
    if block == 50_000:
        got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontam.judged(docs, bench).collect()}
        assert got == want
        kept = decontam.clean(docs, bench)
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, x in want.items() if not x[1]}


def test_decontamination_edge_cases(spark, empty, odd):
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(12)))], "item_id long, text string")
    assert decontam.judged(empty, bench).count() == 0
    assert sorted(r.n_hit for r in decontam.judged(odd, bench).collect()) == [0, 12, 12, 12, 12, 12]
    assert decontam.judged(odd, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.clean(odd, bench).count() == 1


def test_packing_round_trip(spark, docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    capacity = 96
    got = collections.defaultdict(list)
    bins = collections.defaultdict(list)
    for r in packing.packed(docs, capacity=capacity, shard_pieces=30).collect():
        got[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for i, t, *_ in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        parts = sorted(got[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert [r.start for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
        assert sum(r.length for r in parts) == len(ids) and all(r.length == capacity for r in parts[1:])
        for r in parts:
            raw = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(raw)
    for places in bins.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= capacity


def test_units_give_the_tokenizers_ids():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    bpe = packing.ByteBpe("byte_bpe_50k.json")
    signs = st.sampled_from(list("ab 1\t\n\r\x0b\x1c\x85\xa0\u2003\u3000'stre.é漢😀<|endoftext|>"))

    @settings(max_examples=400, deadline=None)
    @given(st.one_of(st.text(max_size=40), st.lists(signs, max_size=40).map("".join)))
    def same(text):
        assert bpe.ids(text) == np.array(
            bpe.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    same()
    for text in ("a <|endoftext|> b", "x" * 3000, " " * 900 + "y"):
        assert bpe.ids(text) == bpe._reference(text)


def test_fullest_combination_is_best():
    rng = random.Random(8)
    for _ in range(200):
        sizes = sorted({rng.randint(1, 30) for _ in range(rng.randint(1, 6))}, reverse=True)
        counts = [rng.randint(1, 3) for _ in sizes]
        room = rng.randint(0, 60)
        picks = packing.fullest(sizes, counts, room)
        reach = {0}
        for s, c in zip(sizes, counts):
            reach |= {r + s * k for r in reach for k in range(c + 1) if r + s * k <= room}
        assert sum(picks) == max(reach)
        used = collections.Counter(picks)
        assert all(used[s] <= c for s, c in zip(sizes, counts))


def test_packing_edge_cases(spark, empty, odd):
    assert packing.packed(empty).count() == 0
    got = packing.packed(odd).collect()
    assert len(got) == 6 and len({r.sequence_id for r in got}) == 1


def test_toxicity_learns_and_scores(spark, empty, odd):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = [word(rng) for _ in range(30)] + (["vile", "scum", "vilest"][:1 + i % 3] if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    weights = toxicity.train(docs.where("doc_id < 400"), marks)
    assert 0 < np.count_nonzero(weights) < 2_000
    got = {r.doc_id: r.toxicity for r in toxicity.scored(docs.where("doc_id >= 400"), weights).collect()}
    right = sum((got[i] >= 0.5) == (i % 5 == 0) for i in got)
    assert right >= 0.95 * len(got) and all(0 <= s <= 1 for s in got.values())
    assert toxicity.scored(empty, weights).count() == 0
    assert len(toxicity.scored(odd, weights).collect()) == 6
    none = toxicity.train(empty, marks)
    assert not none.any() and {r.toxicity for r in toxicity.scored(odd, none).collect()} == {0.0}


def test_toxicity_fit_is_the_plain_recurrence():
    """Weights against the textbook update, one coordinate at a time."""
    rng = random.Random(6)
    setting = toxicity.Ftrl(bits=8, l1=0.2, epochs=2)
    texts = [" ".join(rng.choice(["ash", "bog", "cat", "dim", "eel"]) for _ in range(rng.randint(0, 6))).encode()
             for _ in range(60)]
    labels = np.array([float(b"eel" in t) for t in texts])
    z, n = [0.0] * 256, [0.0] * 256

    def weight(i):
        if abs(z[i]) <= setting.l1:
            return 0.0
        return -(z[i] - math.copysign(setting.l1, z[i])) / (
            (setting.beta + math.sqrt(n[i])) / setting.alpha + setting.l2)

    for _ in range(setting.epochs):
        for text, label in zip(texts, labels):
            slots = toxicity.features(text, setting.bits).tolist()
            w = {i: weight(i) for i in slots}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in slots:
                rate = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / setting.alpha
                z[i] += g - rate * w[i]
                n[i] += g * g
    got = toxicity.fit(texts, labels, setting)
    assert got.any() and np.allclose(got, [weight(i) for i in range(256)], atol=1e-6)


def test_repeats_of_an_id_are_learnt_once(spark):
    docs = spark.range(40).select((F.col("id") % 4).alias("doc_id"), F.concat(F.lit("some vile text "), "id").alias("text"))
    marks = spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id long, toxic int")
    weights = toxicity.train(docs, marks)
    once = docs.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    assert (weights == toxicity.train(once, marks)).all()


def test_toxicity_sample_is_bounded(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    marks = docs.select("doc_id", F.lit(1).alias("toxic"))
    assert toxicity.train(docs, marks, sample=5).any()


@pytest.mark.parametrize("shard_tokens", [4_000_000, 500])
def test_language_model(spark, docs, rows, shard_tokens):
    def toks(t):
        return (t or "").encode().lower().split() + [b" end"]

    count = collections.Counter()
    for i, t, *_ in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(toks(t))
    total, types = sum(count.values()), len(count)
    got = {r.doc_id: r for r in lm.scored(docs, shard_tokens=shard_tokens).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        own, r = toks(t), got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in count for w in own), total)
        plain = sum(math.log10((count[w] + 1) / (total + types + 1)) for w in own)
        assert r.base_score == pytest.approx(plain, rel=1e-6)
        assert r.score < 0
    learnt = [r for r in got.values() if not r.held_out]
    assert sum(r.score for r in learnt) > sum(r.base_score for r in learnt)


def model_rows(spark):
    """Trained texts over five words, and held-out ones with every pair and an unknown word."""
    rng = random.Random(3)
    words = "a b c d e".split()
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 7 == 2]
    learnt = [i for i in range(400) if i not in ids]
    rows = [(i, " ".join(rng.choices(words, [9, 5, 3, 2, 1], k=rng.randint(1, 30)))) for i in learnt]
    ends = words + ["zzz"]
    rows += list(zip(ids, ends + ["", *(f"{x} {y}" for x in words for y in ends)]))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3), ends


@pytest.mark.parametrize("shard_tokens", [4_000_000, 300])
def test_predictive_probabilities_of_a_context_sum_to_one(spark, shard_tokens):
    docs, _ = model_rows(spark)
    sums = collections.defaultdict(list)
    for r in lm.pair_probabilities(docs, shard_tokens=shard_tokens).collect():
        sums[r.context].append(r.probability)
    whole = [p for p in sums.values() if len(p) == 7]
    assert len(whole) == 6
    assert all(sum(p) == pytest.approx(1.0, abs=1e-9) for p in whole)


def test_language_model_does_not_depend_on_the_number_of_shards(spark, docs):
    def scores(shard_tokens):
        return sorted((r.doc_id, r.score) for r in lm.scored(docs, shard_tokens=shard_tokens).collect())

    few, many = scores(4_000_000), scores(500)
    assert [i for i, _ in few] == [i for i, _ in many]
    assert [s for _, s in few] == pytest.approx([s for _, s in many], rel=1e-6)


def test_base_score_is_exact_in_double_precision(spark):
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(3000)) for i in range(1, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    count = collections.Counter()
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(t.split() + [" end"])
    for r in lm.scored(docs, shard_tokens=9_000).collect():
        plain = math.fsum(math.log10((count[w] + 1) / (sum(count.values()) + len(count) + 1))
                          for w in texts[r.doc_id].split() + [" end"])
        assert r.base_score == pytest.approx(plain, rel=1e-12)


def test_document_lists_are_spread(spark):
    docs = spark.range(64).selectExpr("id as doc_id", "'a b' as text", "true as train").repartition(16)
    lists = lm.dealt(docs, 8, np.empty(0, np.uint64)).where("shard < 0").select("shard", "flush").collect()
    assert len({r.shard for r in lists}) > 2 and min(r.shard for r in lists) >= -8


def test_shards_meet_in_a_part_each(spark):
    """No two shards in one task of the shuffle or one bucket, whatever their number."""
    docs = spark.range(200).selectExpr("id as doc_id", "concat('a', id, ' b', id * 7) as text", "true as train")
    for shards in (1, 2, 24, 211):
        keys = lm.even_keys(spark, shards)
        assert len(set(keys.tolist())) == shards and keys.min() >= 0
    dealt = lm.dealt(docs, 24, np.empty(0, np.uint64)).where("shard >= 0").select("shard").distinct()
    assert dealt.count() == 24
    parts = dealt.repartition(24, "shard").select(F.spark_partition_id().alias("part")).distinct()
    assert parts.count() == 24


def test_every_word_before_is_a_context_of_its_own():
    tokens = lm.tokens_of(" ".join(f"w{i}" for i in range(300_000)).encode())
    assert len(np.unique(lm.contexts_of(tokens))) == 300_001


def test_seating_keeps_its_bounds_and_follows_the_restaurant():
    rng = np.random.default_rng(0)
    count = np.array([0, 1, 2, 50, 5000])
    tables = lm.seat(count, np.arange(5), np.full(5, 10.0), np.full(5, 0.01), 0.5, 1.0, rng)
    assert tables[0] == 0 and tables[1] == 1 and (tables[2:] >= 1).all() and (tables <= count).all()
    # One dish alone in a restaurant, base 1: the tables of a plain Pitman-Yor process.
    d, s, n = 0.5, 1.0, 40
    many = lm.seat(np.full(4000, n), np.arange(4000), np.zeros(4000), np.ones(4000), d, s, rng)
    mean = 1.0
    for j in range(1, n):
        mean += (s + d * mean) / (s + j)
    assert many.mean() == pytest.approx(mean, rel=0.03)


def test_language_model_edge_cases(spark, empty, odd):
    assert lm.scored(empty).count() == 0
    got = lm.scored(odd).collect()
    assert len(got) == 6 and sum(r.doc_id is None for r in got) == 2
    alone = spark.createDataFrame(
        [(i, "x y") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    for r in lm.scored(alone).collect():
        assert (r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, pytest.approx(0.0))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def test_url_rules(spark):
    urls = ["https://a.example.com/en/1", "http://www.example.com/en/1", "x://B.www.EXAMPLE.com/en/x?q", "nope",
            None, "http://com", "http://com/", "ftp://a.net/es/1#x", "ftp://a.net/es", "http://a.net/fr/?/en/",
            "http://notcom/", "http://xexample.com/en/", "a://b://c.net/es/", "://net/fr/1", "http://h.org/de/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn(
        "template", F.lit("clash")).withColumn("purity", F.lit(0))
    for r in urlfilter.judged(pages).collect():
        url = urls[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = host.lower()
        fit = [(len(h + p), h + p, v) for h, p, v in RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host, path), url
        if fit:
            assert (r.rule, r.verdict) == max(fit)[1:], url
        else:
            assert r.rule is None and r.verdict in ("allow", "block")


def test_url_templates(spark):
    """A host of one kind of path: variable segments become wildcards, impure ones are blocked."""
    labelled = [f"http://h.net/es/{w}/x" for w in (f"{chr(97 + i % 26)}{i}w" for i in range(200))]
    good = [f"http://g.com/a/{i}.html" for i in range(400)]
    mixed = [f"http://h.net/es/p{i}" for i in range(30)]
    pages = spark.createDataFrame(list(enumerate(labelled + good + mixed)), "page_id long, url string")
    got = urlfilter.judged(pages, wide=20).collect()
    names = collections.Counter(r.template for r in got)
    assert names == {"/a/{n}.html": 400, "/es/{*}/x": 200, "/es/{*}": 30}
    narrow = urlfilter.judged(pages, wide=100).where("template = '/es/p{n}'")
    assert narrow.count() == 30 and all(0 <= r.purity < 0.5 for r in narrow.collect())
    assert urlfilter.judged(pages.limit(0)).count() == 0
    deep = spark.createDataFrame([(1, "http://q.org/" + "/".join("abcdefghij"))], "page_id long, url string")
    assert urlfilter.judged(deep).first().template == "/a/b/c/d/e/f/{**}"


def test_urls_without_a_rule_are_judged_by_what_stands_above(spark):
    """The same template elsewhere, the host, and the merged siblings each speak for a template without labels."""
    blocked = [f"http://h{i}.net/es/p{i}" for i in range(300)]
    allowed = [f"http://g{i}.com/a/{i}.html" for i in range(900)]
    unruled = ["http://x.org/es/p7", "http://x.org/a/7.html", "http://x.org/other"]
    pages = spark.createDataFrame(list(enumerate(blocked + allowed + unruled)), "page_id long, url string")
    got = {(r.host, r.path): r for r in urlfilter.judged(pages).collect()}
    assert [got["x.org", p].verdict for p in ("/es/p7", "/a/7.html", "/other")] == ["block", "allow", "allow"]
    assert all(got["x.org", p].rule is None for p in ("/es/p7", "/a/7.html", "/other"))
    purity = [got["x.org", p].purity for p in ("/es/p7", "/other", "/a/7.html")]
    assert purity == sorted(purity) and len(set(purity)) == 3


def test_siblings_without_labels_take_the_pool(spark):
    """Branches of one host that differ in their first segment only."""
    counts = spark.createDataFrame(
        [("h", "/a/x", 0, 40), ("h", "/b/x", 0, 30), ("h", "/c/x", 0, 0), ("h", "/d/x", 50, 0), ("h", "/c", 0, 0),
         ("k", "/a/x", 1, 9), ("k", "/b/x", 2, 8), ("k", "/e/x", 0, 0)],
        "host string, template string, good long, bad long")
    got = {(r.host, r.template): (r.good, r.bad, r.pool_good, r.pool_bad) for r in urlfilter.merged(counts).collect()}
    assert got["h", "/c"] == got["h", "/c/x"] == (0, 0, 0, 0) and got["h", "/d/x"][2:] == (50, 0)
    assert got["k", "/e/x"] == (0, 0, 3, 17) and got["k", "/a/x"] == (1, 9, 3, 17)
    placed = counts.withColumn("urls", F.lit(1))
    purity = {(r.host, r.template): r.purity for r in urlfilter.purities(placed, 0.5, 20.0).collect()}
    assert purity["h", "/a/x"] < purity["h", "/c/x"] < purity["h", "/d/x"]
    assert purity["k", "/e/x"] < purity["h", "/c"]


def test_phrases_come_from_the_automaton(spark, docs, monkeypatch):
    """Without the automaton's matches nothing is located."""
    words = [f"w{i}".encode() for i in range(40)]
    segment = b" ".join(words[:20])
    other = b" ".join(words[3:23])
    blobs = [phrases.pack_segments([(segment, 8, 0, [(1, 0, 5, 25)]), (other, 8, 0, [(2, 0, 9, 29)])])]
    assert phrases.located(blobs, 13).tolist() == [[2, 0, 9, 26]]

    class Silent:
        def __init__(self, *_):
            pass

        def add_word(self, *_):
            pass

        make_automaton = add_word

        def iter(self, _):
            return iter(())

    monkeypatch.setattr(phrases.ahocorasick, "Automaton", Silent)
    assert not len(phrases.located(blobs, 13))


def test_word_hashes_follow_the_words(monkeypatch):
    """Equal words have equal hashes wherever they stand, also across stretches and beyond one."""
    rng = random.Random(12)
    words = [bytes(rng.randrange(33, 256) for _ in range(rng.choice([1, 2, 3, 9, 200]))) for _ in range(300)]
    text = [rng.choice(words) for _ in range(3000)]
    raw = np.frombuffer(b" ".join(text), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in text]) - 1
    starts = ends - [len(w) for w in text]
    whole = phrases.word_hashes(raw, starts, ends)
    monkeypatch.setattr(phrases, "STRETCH", 64)
    assert (phrases.word_hashes(raw, starts, ends) == whole).all()
    by = {}
    for word, h in zip(text, whole.tolist()):
        assert by.setdefault(word, h) == h
    assert len(set(by.values())) == len(by) == len(set(text))


def test_tokens_of_a_shard_are_kept_once_and_smaller(spark):
    """One row per shard whatever the number of flushes; every text finds its tokens in it."""
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(i % 50)) for i in range(600)]
    docs = spark.createDataFrame([(i, x, i % 3 > 0) for i, x in enumerate(texts)],
                                 "doc_id long, text string, train boolean").repartition(6)
    dealt = lm.dealt(docs, 4, np.empty(0, np.uint64)).localCheckpoint()
    sent = dealt.where("shard >= 0").toPandas()
    assert len(sent) > 4
    rows = lm.opened(dealt, 4, np.empty(0, np.uint64)).where("kind = 'tokens'").toPandas()
    assert sorted(rows["shard"]) == sorted(set(sent["shard"]))
    assert rows["blob"].map(len).sum() < sent["blob"].map(len).sum()
    shards = [lm.Shard.unpacked(b) for b in rows["blob"]]
    assert sum(len(x.pair) for x in shards) == sum(len(x.split()) + 1 for x in texts)
    assert sum(int(x.count.sum()) for x in shards) == sum(len(x.split()) + 1 for i, x in enumerate(texts) if i % 3)
    for x in shards:
        assert x.tokens.sum() == len(x.pair) and (np.diff(x.flush.astype(int)) >= 0).all()
        edges = np.cumsum(x.tokens)[:-1]
        assert all((np.diff(own.astype(int)) >= 0).all() for own in np.split(x.pair, edges))


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    """Every window under one hash: the words still decide."""
    monkeypatch.setattr(phrases, "mixed", lambda values: np.zeros(len(values), np.uint64))
    a, b = (b" ".join(f"{x}{i}".encode() for i in range(13)) for x in "ab")
    blobs = [phrases.pack_segments([(a, 1, 0, [(1, 0, 0, 13)]), (b, 1, 0, [(2, 0, 0, 13)]),
                                    (b + b" z", 2, 0, [(3, 0, 4, 18)])])]
    assert phrases.located(blobs, 13).tolist() == [[3, 0, 4, 17]]


def test_digest_columns(spark, sf_dir):
    """Every registered query returns its contract's columns, one row per row where asked."""
    from marquee.llm.queries import QUERIES

    n_docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    columns = {
        "op1": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op2": "doc_id held_out score predicted", "op3": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op5": "doc_id piece start length ids_crc32 sequence_id offset",
        "op6": "doc_id n_words n_hit n_items items_sha256 contaminated",
        "op7": "doc_id n_words n_removed kept_sha256", "op8": "page_id host path rule verdict",
        "op9": "doc_id fingerprint component_id",
        "op10": "doc_id held_out n_tokens n_known train_tokens base_score score", "op4": "doc_id",
        "op11": "lang source part item value rank",
        "op12": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
        "op13": "doc_id n_tokens ids_sha256 decoded_sha256",
    }
    assert {n.split("_")[0] for n in QUERIES} == set(columns)
    for name, query in QUERIES.items():
        out = query(spark, sf_dir)
        assert set(columns[name.split("_")[0]].split()) <= set(out.columns), name
        rows = out.collect()
        if name.split("_")[0] not in ("op5", "op8", "op11", "op12"):
            assert len(rows) == n_docs, name
        if name == "op3_suffix_dedup":
            assert all(re.fullmatch("[0-9a-f]{64}", r.kept_sha256) for r in rows)
            assert rows and hashlib.sha256(b"").hexdigest()
