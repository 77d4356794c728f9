"""Files in, files out: exports, responses, state, store, drain."""

import csv
import glob
import gzip
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from marquee import JobConfig
from marquee.operators import incremental, pages
from marquee.operators.profiling import missing_profile
from marquee.plans.collect import ShortfallError, collect_dataset
from marquee.plans.enrich import drain, run_enrichment
from marquee.plans.report import check_profile, deliver
from marquee.schemas import DATASET, DATASET_COLUMNS, STATE
from marquee.session import drop_scratch, scratch_path
from marquee.sources import catalogue, datasets
from marquee.sources import responses as stored
from marquee.sources.store import Store
from marquee.streaming.drain import Drain


def write_gz(path, header, rows):
    with gzip.open(path, "wt", encoding="utf-8", newline="") as f:
        for row in [header, *rows]:
            f.write("\t".join(row) + "\n")
    return str(path)


def write_json(folder, name, value):
    os.makedirs(folder, exist_ok=True)
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def body(*texts):
    return {"query": {"pages": [
        {"index": i, "title": f"P{i}",
         "revisions": [{"slots": {"main": {"content": t}}}] if t is not None else []}
        for i, t in enumerate(texts, 1)]}}


@pytest.fixture
def catalogue_files(tmp_path):
    titles = write_gz(
        tmp_path / "basics.tsv.gz",
        ["tconst", "titleType", "primaryTitle", "originalTitle", "startYear", "runtimeMinutes", "genres"],
        [["t1", "movie", " metropolis", "x", "1927", "153", "Drama,Sci-Fi"],
         ["t2", "movie", "M", "x", "1931", "99", "\\N"],
         ["t3", "movie", '"Max" at noon', "x", "1950", "80", "Crime"],
         ["t4", "movie", '"Moss', "x", "1950", "80", "Crime"],
         ["t5", "short", "Mini", "x", "1950", "80", "Crime"],
         ["t6", "movie", "Mé", "x", "1950", "\\N", ""]])
    ratings = write_gz(
        tmp_path / "ratings.tsv.gz", ["tconst", "averageRating", "numVotes"],
        [["t1", "8.3", "100"], ["t2", "1.0", "1"], ["t2", "8.3", "1,000"], ["t3", "7", "10"]])
    credits = write_gz(
        tmp_path / "principals.tsv.gz", ["nconst", "category", "tconst"],
        [["n9", "actor", "t1"], ["n2", "actress", "t2"], ["n3", "actor", "t2"], ["n1", "actor", "t2"]])
    return titles, ratings, credits


def test_read_tsv(spark, catalogue_files):
    rows = catalogue.read_titles(spark, catalogue_files[0]).orderBy("ordering").collect()
    assert [r.primaryTitle for r in rows] == [
        " metropolis", "M", "Max at noon", '"Moss', "Mini", "Mé"]
    assert [r.ordering.row for r in rows] == list(range(6))
    assert rows[1].genres == "\\N" and rows[5].genres is None
    credits = catalogue.read_credits(spark, catalogue_files[2]).orderBy("ordering").collect()
    assert [tuple(r)[:3] for r in credits][0] == ("t1", "actor", "n9")


def test_missing_columns_become_null(spark, tmp_path):
    path = write_gz(tmp_path / "x.tsv.gz", ["tconst"], [["t1"]])
    row = catalogue.read_ratings(spark, path).first()
    assert tuple(row)[:3] == ("t1", None, None) and row.ordering.row == 0


def test_collect_from_files(spark, catalogue_files, tmp_path):
    folder = str(tmp_path / "cache")
    write_json(folder, "wiki_search_M_1931_film.json",
               {"query": {"search": [{"title": ""}, {"title": "M (1931 film)"}]}})
    write_json(folder, "wiki_parse_M_1931_film_.json", {"parse": {"wikitext": {
        "*": "{{Infobox film\n| country = [[Germany]]\n| budget = $2 million\n| x =\n}}\n== Plot ==\nHe whistles, \"so\"."}}})
    write_json(folder, "wiki_search_metropolis_1927_film.json",
               {"query": {"search": [{"title": "Metropolis"}]}})
    write_json(folder, "wiki_parse_Metropolis.json", {"error": {"code": "missing"}})
    write_json(folder, "wiki_search_Max_at_noon_1950_film.json", {"query": {"search": []}})
    bodies = stored.read_bodies(spark, folder)
    searches, parses = stored.search_responses(bodies), stored.parse_responses(bodies)

    def lookup(rows, bound):
        return pages.lookup_two_call(rows, searches, parses, bound)

    raw_titles, raw_ratings, raw_credits = catalogue_files
    titles = catalogue.land_titles(
        catalogue.read_titles(spark, raw_titles), str(tmp_path / "titles"))
    ratings = catalogue.land_ratings(
        catalogue.read_ratings(spark, raw_ratings), str(tmp_path / "ratings"))
    credits = catalogue.land_credits(
        catalogue.read_credits(spark, raw_credits), str(tmp_path / "credits"))
    cfg = JobConfig(target_rows=3)
    rows = {r.tconst: r for r in collect_dataset(titles, ratings, credits, lookup, cfg).collect()}
    assert set(rows) == {"t1", "t2", "t3"}
    assert rows["t2"].asDict() == {
        "pos": 1, "tconst": "t2", "primaryTitle": "M", "startYear": 1931, "genres": [],
        "lead_actors_ids": ["n3", "n1"], "runtimeMinutes": 99, "averageRating": 8.3,
        "Language": "", "Country": "Germany", "numVotes": 1000, "budget": 2.0,
        "BoxOffice": None, "plot": 'He whistles, "so".'}
    assert (rows["t1"].plot, rows["t1"].lead_actors_ids) == ("", ["n9"])
    assert rows["t3"].lead_actors_ids == []
    strict = replace(cfg, require_page=True)
    with pytest.raises(ShortfallError, match="only 1 of 3"):
        collect_dataset(titles, ratings, credits, lookup, strict)
    shallow = replace(cfg, enrich_limit=0)
    assert {r.plot for r in collect_dataset(titles, ratings, credits, lookup, shallow).collect()} == {""}


def test_combined_scan(spark, tmp_path):
    folder = str(tmp_path)
    write_json(folder, "wiki_combined_8_A_1_film.json", body(None, "text"))
    write_json(folder, "wiki_combined_1_A_1_film.json", body("other limit"))
    write_json(folder, "wiki_combined_8_B.json", {"batchcomplete": True})
    write_json(folder, "wiki_combined_8_C.json", {})
    write_json(folder, "wiki_combined_8_D.json", "not json {")
    write_json(folder, "wiki_combined_8_E.json", {"query": {"pages": [{"revisions": None}]}})
    got = stored.combined_responses(stored.read_bodies(spark, folder), 8)
    by_key = {r.lookup_key: r.pages for r in got.collect()}
    assert set(by_key) == {"A_1_film", "B", "E"} and by_key["B"] is None
    rows = stored.candidate_pages(got).orderBy("lookup_key", "index").collect()
    assert [tuple(r) for r in rows] == [
        ("A_1_film", 1, "P1", ""), ("A_1_film", 2, "P2", "text"), ("E", 999, "", "")]
    landed = stored.land(got, str(tmp_path / "landed"))
    assert landed.count() == 3


ROWS = [
    ("t1", 'A "quoted", title', 1931, ["Crime", 'x"y'], ["n1"], 99, 8.3, "German", "", 5, 1.5,
     12345678.25, "line one\nline two"),
    ("t2", " B ", 1990, [], [], 60, 7.0, "", "", 12, None, None, ""),
]


def test_dataset_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, DATASET)
    path = str(tmp_path / "csv")
    datasets.write_dataset_csv(df, path, order="tconst")
    part = sorted(glob.glob(path + "/part-*"))
    lines = []
    for name in part:
        with open(name, encoding="utf-8", newline="") as f:
            lines += list(csv.DictReader(f))
    assert list(lines[0]) == DATASET_COLUMNS
    assert lines[0]["genres"] == '["Crime", "x\\"y"]'
    assert lines[0]["BoxOffice"] == "12345678.25" and lines[0]["plot"] == "line one\nline two"
    assert lines[1]["budget"] == "" and lines[1]["lead_actors_ids"] == "[]"
    assert lines[1]["primaryTitle"] == " B "
    back = datasets.read_dataset_csv(spark, path).orderBy("pos")
    assert [r.tconst for r in back.collect()] == ["t1", "t2"]
    again = datasets.typed_dataset(back).select(*DATASET_COLUMNS).orderBy("tconst").collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in df.orderBy("tconst").collect()]
    # A CSV written by another tool, with \r\n rows and quoted line breaks.
    other = str(tmp_path / "other.csv")
    with open(other, "w", newline="", encoding="utf-8") as f:
        writer = csv.DictWriter(f, fieldnames=DATASET_COLUMNS)
        writer.writeheader()
        writer.writerows(lines)
    rows = datasets.read_dataset_csv(spark, other).orderBy("pos").collect()
    assert [{c: r[c] for c in DATASET_COLUMNS} for r in rows] == lines
    text = missing_profile(datasets.read_dataset_csv(spark, other).drop("pos")).collect()
    typed = missing_profile(df).collect()
    assert text == typed


def test_deliver(spark, tmp_path):
    df = spark.createDataFrame([(*ROWS[0][:1], "Max", *ROWS[0][2:]), ROWS[1]], DATASET)
    df = df.withColumn("pos", F.length("plot"))
    lines = deliver(df, JobConfig(), str(tmp_path / "csv"), str(tmp_path / "profile"), minimum_rows=1)
    got = {r.field: r.line for r in lines.collect()}
    assert got["Country"] == "Country: 1 missing (100.0%)" and list(got) == DATASET_COLUMNS
    document = datasets.read_profile(spark, str(tmp_path / "profile"))
    row = document.first()
    assert (row.movie_count, row.team_letter, row.candidate_pool_size) == (1, "M", 30000)
    assert row.missing.plot.missing_count == 0
    assert check_profile(df.filter("tconst = 't1'"), document).count() == 0
    assert check_profile(df, document).count() > 0


def test_state_files(spark, tmp_path):
    entry = {"title": "T", "year": "1990", "reason": "r", "retry_search_limit": 8}
    write_json(str(tmp_path), "s.json", {"failed_rows": {"k1": entry, "k2": {"title": "U"}}})
    rows = datasets.read_state_json(spark, str(tmp_path / "s.json")).orderBy("key")
    assert [tuple(r) for r in rows.collect()] == [
        ("k1", "T", "1990", "r", 8), ("k2", "U", None, None, None)]
    for name, text in (("bad.json", "{oops"), ("list.json", '{"failed_rows": [1]}'), ("none.json", "{}")):
        write_json(str(tmp_path), name, text)
        assert datasets.read_state_json(spark, str(tmp_path / name)).count() == 0
    empty = datasets.read_state_json(spark, str(tmp_path / "absent.json"))
    assert empty.count() == 0 and empty.schema.names == STATE.names
    datasets.write_state_lines(rows, str(tmp_path / "out"))
    again = datasets.read_state_lines(spark, str(tmp_path / "out"))
    assert again.orderBy("key").collect() == rows.collect()


# ---- store, runs, drain ------------------------------------------------------
def start_store(spark, root, n=8):
    rows = [(i, f"t{i}", f"Title {i % 6}", 1990, [], [], 90, 7.0,
             "French" if i == 0 else "", "", 1, 3.0, None, "") for i in range(n)]
    schema = "pos long, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in DATASET)
    store = Store(spark, str(root))
    state = spark.createDataFrame([("t1", "T", "1990", "old", 0)], STATE)
    store.publish(spark.createDataFrame(rows, schema), state, JobConfig())
    return store


def answers(folder):
    write_json(folder, "wiki_combined_8_Title_1_1990_film.json", body("| country = One\n| x ="))
    write_json(folder, "wiki_combined_8_Title_2_1990_film.json", body("", "nothing here"))
    write_json(folder, "wiki_combined_8_Title_3_1990_film.json", {"query": {}})
    write_json(folder, "wiki_combined_8_Title_4_1990_film.json", body("== Plot ==\nFour"))
    write_json(folder, "wiki_combined_8_Title_5_1990_film.json", {})
    write_json(folder, "wiki_combined_8_Other_1990_film.json", body("| country = X"))
    return folder


def snapshot(store):
    rows = store.dataset().orderBy("pos").collect()
    state = store.state().orderBy("key").collect()
    return [tuple(r) for r in rows], [tuple(r) for r in state]


CFG = JobConfig(search_limit=8, checkpoint_rows=2, batch_rows=3)


def test_chunked_runs_equal_one_drain(spark, tmp_path):
    folder = answers(str(tmp_path / "cache"))
    table = stored.combined_responses(stored.read_bodies(spark, folder), 8)
    one, many = start_store(spark, tmp_path / "one"), start_store(spark, tmp_path / "many")
    total = drain(one, table, CFG)
    assert tuple(total) == (6, 2, 2, 1)
    first = run_enrichment(many, table, CFG)
    assert tuple(first) == (3, 1, 2, 1)
    for _ in range(3):
        run_enrichment(many, table, CFG)
    assert many.version() == 5
    assert snapshot(one) == snapshot(many)
    rows, state = snapshot(one)
    assert [r[0] for r in state] == ["t1", "t2", "t3"]
    assert rows[4][-1] == "Four" and rows[4][11] is None and rows[5][11] == 3.0
    again = drain(one, table, CFG)
    assert again.enriched == 0 and again.newly_failed == 0
    assert one.profile().first().wikipedia_enriched_count == 3


def test_a_large_state_file_is_read_by_its_entries(spark, tmp_path):
    """Several tasks parse one document; a damaged one gives none, whatever is damaged."""
    state = {f"k{i}{{}}\n    }}": {"title": f'T "{i}" }}\n    }},', "year": None if i % 3 else "1990",
                                  "reason": "né", "retry_search_limit": i % 9} for i in range(20_000)}
    text = json.dumps({"failed_rows": state}, indent=2, ensure_ascii=False)
    path = tmp_path / "large.json"
    path.write_text(text, encoding="utf-8")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
        rows = datasets.read_state_json(spark, str(path))
        got = {r.key: (r.title, r.year, r.reason, r.retry_search_limit) for r in rows.collect()}
        assert got == {k: tuple(v.values()) for k, v in state.items()}
        assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 3
        middle = len(text) // 2
        for k, broken in enumerate([text[:-3], text[:middle], text[middle:], text[:middle] + text[middle + 40:],
                                    text + text, "[" + text + "]", text.replace("failed_rows", "other")]):
            bad = tmp_path / f"bad{k}.json"
            bad.write_text(broken, encoding="utf-8")
            assert datasets.read_state_json(spark, str(bad)).count() in ((0,) if k != 4 else (0, 20_000)), k
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    one = tmp_path / "line.json"
    one.write_text(json.dumps({"failed_rows": {"a": {"title": "x"}}}))
    assert [tuple(r) for r in datasets.read_state_json(spark, str(one)).collect()] == [("a", "x", None, None, None)]


def test_streaming_drain_equals_batch(spark, tmp_path):
    folder = answers(str(tmp_path / "cache"))
    table = stored.combined_responses(stored.read_bodies(spark, folder), 8)
    batch, stream = start_store(spark, tmp_path / "b"), start_store(spark, tmp_path / "s")
    drain(batch, table, CFG)
    job = Drain(stream, "first", CFG)
    assert job.run(folder) == 2
    assert snapshot(stream) == snapshot(batch)
    # A second run under the same name finds nothing new and publishes nothing.
    assert Drain(stream, "first", CFG).run(folder) == 2
    # Later files continue the drain; known misses are left alone without retry.
    write_json(folder, "wiki_combined_8_Title_5_1990_film_.json", body("| country = Z"))
    write_json(folder, "wiki_combined_8_Title_0_1990_film.json", body("| country = Zero\n| x="))
    assert Drain(stream, "first", CFG).run(folder) == 3
    rows, state = snapshot(stream)
    assert rows[6][9] == "Zero" and rows[0][9] == "" and [r[0] for r in state] == ["t1", "t2", "t3"]
    # Retry mode visits known failures only.
    retry = replace(CFG, retry_failed=True)
    Drain(stream, "retry", retry).run(folder)
    rows, state = snapshot(stream)
    assert rows[1][9] == "One"
    assert [(r[0], r[4]) for r in state] == [("t2", 8), ("t3", 8)]


def test_repeated_responses_count_once(spark, tmp_path):
    store = start_store(spark, tmp_path / "s")
    name = "wiki_combined_8_Title_4_1990_film.json"
    bodies = [(name, json.dumps(b)) for b in (
        body("nothing"), body("| country = A\n| x ="), body("| country = A\n| x ="))]
    spark.createDataFrame(bodies, "name string, body string").write.parquet(str(tmp_path / "landed"))
    Drain(store, "d", CFG).run_landed(str(tmp_path / "landed"))
    rows = store.dataset().collect()
    assert len(rows) == 8 and [r.Country for r in rows if r.pos == 4] == ["A"]
    assert store.state().count() == 1


def test_replayed_landing_is_idempotent(spark, tmp_path):
    folder = answers(str(tmp_path / "cache"))
    store = start_store(spark, tmp_path / "s")
    job = Drain(store, "d", CFG)
    files = stored.read_bodies(spark, folder)
    half = files.filter(F.col("name").contains("Title_4"))
    for _ in range(2):
        job.land(half, 0, "x")
        job.land(files, 1, "x")
        landed = spark.read.parquet(job.memo)
        assert landed.count() == half.count() + stored.every_combined_response(files).count()
    job.drain()
    assert store.dataset().filter("plot = 'Four'").count() == 1
    assert job.drain() == store.version() == 2


def test_unpublished_version_is_invisible(spark, tmp_path):
    store = start_store(spark, tmp_path / "s")
    store.dataset().limit(1).write.parquet(f"{store.folder(2)}/dataset")
    assert store.version() == 1 and store.dataset().count() == 8
    assert incremental.pending_rows(
        incremental.with_key(store.dataset()), store.state()).count() == 6


def test_command_line(spark, catalogue_files, tmp_path, monkeypatch, capsys):
    from marquee.__main__ import main

    raw, cache, store = tmp_path / "raw", str(tmp_path / "cache"), str(tmp_path / "store")
    raw.mkdir()
    for name, path in zip(("title.basics", "title.ratings", "title.principals"), catalogue_files):
        (raw / f"{name}.tsv.gz").write_bytes(open(path, "rb").read())
    write_json(cache, "wiki_search_M_1931_film.json", {"query": {"search": []}})
    write_json(cache, "wiki_combined_1_M_1931_film.json", body("| country = Germany\n| x ="))
    write_json(cache, "wiki_combined_8_metropolis_1927_film.json", body("== Plot ==\nCity"))
    monkeypatch.setenv("TARGET_MOVIE_COUNT", "3")
    main(["collect", "--raw", str(raw), "--responses", cache, "--store", store])
    main(["enrich", "--responses", cache, "--store", store])
    assert "'attempted': 3, 'enriched': 1" in capsys.readouterr().out
    monkeypatch.setenv("WIKI_SEARCH_LIMIT", "8")
    monkeypatch.setenv("ENRICH_RETRY_FAILED", "0")
    main(["drain", "--responses", cache, "--store", store])
    main(["report", "--store", store, "--out", str(tmp_path / "out"), "--minimum-rows", "2"])
    out = capsys.readouterr().out
    assert "version 3" in out and "Country: 1 missing (50.0%)" in out
    main(["import", "--dataset", str(tmp_path / "out" / "dataset"), "--state",
          str(tmp_path / "none.json"), "--store", str(tmp_path / "second")])
    rows = Store(spark, str(tmp_path / "second")).dataset().orderBy("pos").collect()
    assert [r.tconst for r in rows] == ["t2", "t1"]
    # Each job has removed what it wrote for itself.
    mine = scratch_path(spark)
    spark.range(1).write.parquet(mine)
    drop_scratch(spark)
    assert not os.path.exists(mine.removeprefix("file://"))
