"""Drains give one result however stored answers arrive; names and bases stay apart."""

import json
import os
import unicodedata
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_sources import CFG, answers, body, snapshot, start_store, write_json

from marquee.catalog import standins as stand_ins
from marquee.operators import candidates, pages, profiling
from marquee.plans.enrich import drain, run_enrichment
from marquee.schemas import DATASET_COLUMNS
from marquee.session import materialise
from marquee.sources import catalogue
from marquee.sources import responses as stored
from marquee.sources import store as store_module
from marquee.streaming.drain import Drain

NAME = "wiki_combined_8_Title_{}_1990_film.json"
TEXTS = ["nothing", "| country = A\n| x =", "| country = B\n| x =", "{oops", "{}", "[]"]


def repeated():
    """Misses, hits and invalid bodies for one key, misses and nothing valid for others."""
    rows = [(NAME.format(4), t if t[0] in "{[" else json.dumps(body(t))) for t in TEXTS]
    rows += [(NAME.format(2), json.dumps(body("nothing"))), (NAME.format(2), json.dumps(body("more"))),
             (NAME.format(3), "{oops"), (NAME.format(5), "{}")]
    return rows


@pytest.fixture(scope="module")
def by_table(spark, tmp_path_factory):
    """What one batch drain over the table of all bodies gives."""
    store = start_store(spark, tmp_path_factory.mktemp("table"))
    table = spark.createDataFrame(repeated(), stored.BODY_SCHEMA)
    drain(store, stored.combined_responses(table, 8), CFG)
    return snapshot(store)


@pytest.mark.parametrize("files", [1, 2, 99])
@pytest.mark.parametrize("backwards", [False, True])
def test_drain_does_not_depend_on_batches_or_order(spark, tmp_path, by_table, files, backwards):
    store, landed = start_store(spark, tmp_path / "s"), str(tmp_path / "landed")
    rows = repeated()[::-1] if backwards else repeated()
    for at in range(0, len(rows), 3):
        spark.createDataFrame(rows[at:at + 3], stored.BODY_SCHEMA).coalesce(1).write.mode("append").parquet(landed)
    Drain(store, "d", replace(CFG, checkpoint_rows=files)).run_landed(landed)
    assert snapshot(store) == by_table
    rows, state = by_table
    assert rows[4][9] in ("A", "B") and [r[0] for r in state] == ["t1", "t2"]


def test_folder_and_table_agree_on_invalid_bodies(spark, tmp_path, by_table):
    folder = str(tmp_path / "cache")
    for name, text in repeated():
        if name == NAME.format(4) and "country = A" not in text or "more" in text:
            continue
        write_json(folder, name, text)
    store = start_store(spark, tmp_path / "s")
    Drain(store, "d", CFG).run(folder)
    rows, state = snapshot(store)
    assert [r[0] for r in state] == ["t1", "t2"] and rows[4][9] == "A" and rows[3][9] == ""


def test_drain_names_do_not_meet_job_names(spark, tmp_path):
    folder = answers(str(tmp_path / "cache"))
    for name in ("enrich", "import", "collect"):
        store = start_store(spark, tmp_path / name)
        drain(store, stored.combined_responses(
            spark.createDataFrame([], stored.BODY_SCHEMA), 8), CFG)
        Drain(store, name, CFG).run(folder)
        assert snapshot(store)[0][4][-1] == "Four"


def test_a_new_dataset_meets_the_stored_answers_again(spark, tmp_path):
    folder = answers(str(tmp_path / "cache"))
    store = start_store(spark, tmp_path / "s")
    Drain(store, "d", CFG).run(folder)
    first = snapshot(store)
    start_store(spark, tmp_path / "s")
    assert snapshot(store)[0][4][-1] == ""
    Drain(store, "d", CFG).run(folder)
    assert snapshot(store) == first


def test_runs_leave_the_stored_rows_where_they_are(spark, tmp_path, monkeypatch):
    folder = answers(str(tmp_path / "cache"))
    table = stored.combined_responses(stored.read_bodies(spark, folder), 8)
    store = start_store(spark, tmp_path / "s")
    before = sorted(os.listdir(f"{store.folder(1)}/dataset"))
    for _ in range(2):
        run_enrichment(store, table, CFG)
    assert sorted(os.listdir(f"{store.folder(1)}/dataset")) == before
    assert not any(os.path.exists(f"{store.folder(v)}/{n}") for v in (2, 3) for n in ("dataset", "state"))
    joined, n = snapshot(store), store.profile().first().wikipedia_enriched_count
    # After enough changes a run writes a whole version, which reads the same.
    monkeypatch.setattr(store_module, "COMPACT_AFTER", 2)
    run_enrichment(store, table, CFG)
    assert os.path.exists(f"{store.folder(4)}/dataset") and store.version() == 4
    assert snapshot(store) == joined and store.profile().first().wikipedia_enriched_count == n
    assert sorted(r.pos for r in store.pending().collect()) == sorted(
        r[0] for r in joined[0] if not (r[8] or r[9] or r[13]))


def test_second_drain_under_one_name_meets_stored_answers(spark, tmp_path):
    """First and retry drain under one name equal the batch drains."""
    folder, retry = answers(str(tmp_path / "cache")), replace(CFG, retry_failed=True)
    table = stored.combined_responses(stored.read_bodies(spark, folder), 8)
    batch, stream = start_store(spark, tmp_path / "b"), start_store(spark, tmp_path / "s")
    for cfg in (CFG, retry):
        drain(batch, table, cfg)
        Drain(stream, "one", cfg).run(folder)
        assert snapshot(stream) == snapshot(batch)
    assert {r[4] for r in snapshot(stream)[1]} == {8}
    # Nothing is left that a further drain of either kind would attempt.
    for cfg in (CFG, retry):
        assert Drain(stream, "one", cfg).run(folder) == 3


def test_a_raised_limit_meets_answers_landed_before(spark, tmp_path):
    folder = str(tmp_path / "cache")
    write_json(folder, "wiki_combined_1_Title_4_1990_film.json", body("nothing"))
    write_json(folder, "wiki_combined_8_Title_4_1990_film.json", body("nothing", "| country = Later\n| x ="))
    low, high = replace(CFG, search_limit=1), replace(CFG, retry_failed=True)
    store = start_store(spark, tmp_path / "s")
    Drain(store, "one", low).run(folder)
    rows, state = snapshot(store)
    assert rows[4][9] == "" and "t4" in [r[0] for r in state]
    Drain(store, "one", high).run(folder)
    rows, state = snapshot(store)
    assert rows[4][9] == "Later" and "t4" not in [r[0] for r in state]


def test_landing_reads_neither_dataset_nor_state(spark, tmp_path, monkeypatch):
    """A micro-batch costs what its files cost, however large the store is."""
    folder = answers(str(tmp_path / "cache"))
    store = start_store(spark, tmp_path / "s")
    job, files = Drain(store, "d", CFG), stored.read_bodies(spark, folder)

    def unread(self, *_):
        raise AssertionError("a micro-batch has read the store")

    with monkeypatch.context() as held:
        for name in ("dataset", "pending", "state", "profile", "_commits"):
            held.setattr(store_module.Store, name, unread)
        job.land(files, 0, "x")
    assert job.drain() == 2 and snapshot(store)[0][4][-1] == "Four"


def test_a_drain_reads_the_answers_of_its_own_limit_only(spark, tmp_path):
    folder = str(tmp_path / "cache")
    for limit in (1, 8):
        write_json(folder, f"wiki_combined_{limit}_Title_4_1990_film.json", body("nothing"))
    job = Drain(start_store(spark, tmp_path / "s"), "d", CFG)
    job.land(stored.read_bodies(spark, folder), 0, "x")
    text = job.answers()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(search_limit" in text and "= 8)]" in text


def test_ten_runs_keep_the_profile_without_reading_the_dataset(spark, tmp_path, monkeypatch):
    folder = answers(str(tmp_path / "cache"))
    write_json(folder, "wiki_combined_8_Title_6_1990_film.json", body("| budget = $5 million\n| language = L\n| x ="))
    table = stored.combined_responses(stored.read_bodies(spark, folder), 8)
    store = start_store(spark, tmp_path / "s")

    def unread(self):
        raise AssertionError("a run has read the whole dataset")

    for k in range(10):
        cfg = replace(CFG, batch_rows=1 + k % 2, retry_failed=k % 3 == 2)
        with monkeypatch.context() as held:
            held.setattr(store_module.Store, "dataset", unread)
            run_enrichment(store, table, cfg)
        if k % 5 == 4:
            whole = profiling.profile_document(store.dataset().select(*DATASET_COLUMNS), cfg).first()
            assert store.profile().first() == whole
    assert store.version() == 11 and whole.wikipedia_enriched_count > 2


def test_one_row_per_row_asked(spark):
    rows = spark.createDataFrame([("t1", "M", 1931), ("t2", "N", 1932)],
                                 "tconst string, primaryTitle string, startYear int")
    searches = spark.createDataFrame(
        [("M_1931_film", "P one"), ("M_1931_film", "P two"), ("N_1932_film", None)],
        "lookup_key string, page string")
    parses = spark.createDataFrame(
        [("P_one", "| country = A\n| x ="), ("P_one", "| country = B\n| x ="), ("P_two", "| country = C\n| x =")],
        "page_key string, content string")
    looked = pages.lookup_two_call(rows, searches, parses, 2).orderBy("tconst").collect()
    assert [(r.tconst, r.page) for r in looked] == [("t1", "P one"), ("t2", None)]
    assert looked[0].fields.Country == "A" and looked[1].fields is None


def test_folding_reads_and_writes_the_parts_of_changed_rows(spark, sf_dir, tmp_path, monkeypatch):
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        store = store_module.Store(spark, str(tmp_path / "s"))
        rows = stand_ins.dataset(spark, sf_dir)
        store.publish(rows, stand_ins.state(spark, sf_dir).limit(0), CFG)
        bounds = sorted(map(tuple, store.parts(1).select("lo", "hi", "part").collect()))
        assert len(bounds) == 8 and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
        cfg = replace(stand_ins.RUN, batch_rows=5)
        answered = materialise(stand_ins.responses(spark, sf_dir))
        monkeypatch.setattr(store_module, "COMPACT_AFTER", 2)
        for _ in range(3):
            run_enrichment(store, answered, cfg)
        # The batches were the first rows, which lie in the first parts.
        changed = store._changes([2, 3], "outcomes").filter("outcome = 'enriched'").select("pos")
        last = changed.agg(F.max("pos")).first()[0]
        old = {r.part for r in store.parts(4).filter("version = 1").collect()}
        assert old and old >= {part for lo, _, part in bounds if lo > last + 200}
        touched = store.parts_of(1, changed)
        files = store._rows(1, touched).inputFiles()
        assert {f.split("part=")[1].split("/")[0] for f in files} == {str(r.part) for r in touched.collect()}
        assert len(files) < len(store._rows(1).inputFiles())
        assert not any(f"part={p}/" in f for p in old for f in files)
        monkeypatch.setattr(store_module, "COMPACT_AFTER", 99)
        joined = store_module.Store(spark, str(tmp_path / "joined"))
        joined.publish(rows, stand_ins.state(spark, sf_dir).limit(0), CFG)
        for _ in range(3):
            run_enrichment(joined, answered, cfg)
        assert str(snapshot(store)) == str(snapshot(joined))
        assert store.profile().first() == joined.profile().first() == profiling.profile_document(
            store.dataset().select(*DATASET_COLUMNS), cfg).first()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_two_calls_without_a_bound(spark):
    """Hot searches and hot pages are spread; each page is parsed once, whoever asks."""
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("tconst"),
        F.when(F.col("id") < 2000, F.lit("Hot")).otherwise(F.concat(F.lit("T"), F.col("id") % 50)).alias("primaryTitle"),
        F.lit(1990).alias("startYear"))
    searches = spark.createDataFrame(
        [("Hot_1990_film", "Page hot")] + [(f"T{k}_1990_film", "Page hot" if k % 2 else f"Page {k}") for k in range(49)],
        "lookup_key string, page string")
    parses = spark.createDataFrame(
        [("Page_hot", "| country = H\n| x ="), ("Page_hot", "| country = Z\n| x ="), ("Page_4", "| country = F\n| x ="),
         ("Page_6", ""), ("Page_99", "| country = N\n| x =")], "page_key string, content string")
    free = pages.lookup_two_call(rows, searches, parses, hot_rows=40)
    bound = pages.lookup_two_call(rows, searches, parses, 3000)
    columns = ["tconst", "page", "fields"]
    got = sorted(map(tuple, free.select(columns).collect()))
    assert got == sorted(map(tuple, bound.select(columns).collect()))
    assert len(got) == 3000 and sum(r[2] is not None and r[2].Country == "H" for r in got) > 2000
    assert "_slice" in free._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_several_files_follow_their_names(spark, tmp_path):
    head = "tconst\taverageRating\tnumVotes\n"
    (tmp_path / "a.tsv").write_text(head + "t1\t1.0\t1\n")
    (tmp_path / "b.tsv").write_text(head + "".join(f"x{i}\t5.0\t{i}\n" for i in range(3000)) + "t1\t2.0\t2\n")
    (tmp_path / "c.tsv").write_text(head + "t1\t3.0\t3\n")
    landed = catalogue.land_ratings(catalogue.read_ratings(spark, str(tmp_path)), str(tmp_path / "out"))
    assert [tuple(r) for r in landed.filter("tconst = 't1'").collect()] == [("t1", 3.0, 3)]


def test_initials_know_every_character(spark):
    """A prefix test per letter equals the upper-case test on every character there is."""
    marks = "".join(chr(c) for c in range(1, 0x1F000) if unicodedata.category(chr(c)) not in ("Cs", "Cn"))
    df = spark.createDataFrame([(c,) for c in marks], "c string")
    tests = [(candidates.has_initial(F.col("c"), x) == F.upper("c").startswith(x)).alias(x)
             for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    assert df.select(*tests).agg(*[F.min(t).alias(t) for t in df.select(*tests).columns]).first() == (True,) * 26


@pytest.mark.parametrize("letter", list("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
def test_every_initial_reaches_the_scan(spark, sf_dir, letter):
    from marquee.catalog import standins as t

    df = t.titles(spark, sf_dir).filter(candidates.has_initial(F.col("primaryTitle"), letter))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert f"StringStartsWith(p_name,{letter})" in pushed
