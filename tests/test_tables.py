"""Table operators on small hand-made inputs."""

import math

import pytest
from pyspark.sql import functions as F

from marquee import JobConfig
from marquee.functions.text import fold_case
from marquee.operators import candidates, credits, dataset, incremental, profiling, quality
from marquee.operators.joins import lookup_join
from marquee.operators import ranking
from marquee.schemas import DATASET, DATASET_COLUMNS, STATE
from marquee.session import materialise

M2 = JobConfig(pool_rows=2, target_rows=2)

TITLES = [
    ("t1", "movie", " metropolis", "1927", "153"), ("t2", "movie", "M", "1931", "99"),
    ("t3", "movie", "Mank", "2025", "131"), ("t4", "short", "Moon", "1950", "90"),
    ("t5", "movie", "Mini", "1950", "59"), ("t6", "movie", "Max", "1950", "300"),
    ("t7", "movie", "Mono", "1950", "\\N"), ("t8", "movie", "Moss", "2024", "60"),
    ("t9", "movie", "Alien", "1979", "117"),
]
RATINGS = [
    ("t1", "8.3", "100"), ("t2", "8.3", "100"), ("t3", "6.8", "900"), ("t4", "7.0", "900"),
    ("t5", "7.0", "900"), ("t7", "7.0", "900"), ("t8", "7.0", "50"), ("t9", "8.5", "900"),
]


def titles(spark, rows=TITLES):
    raw = spark.createDataFrame(
        [(*r, "Drama, Comedy") for r in rows],
        "tconst string, titleType string, primaryTitle string, startYear string, "
        "runtimeMinutes string, genres string")
    return candidates.project_titles(raw)


def ratings(spark, rows=RATINGS):
    return candidates.project_ratings(spark.createDataFrame(
        rows, "tconst string, averageRating string, numVotes string"))


def pool(spark, cfg, t=TITLES, r=RATINGS):
    rated = candidates.rated_candidates(
        candidates.eligible_titles(titles(spark, t), cfg), ratings(spark, r))
    return candidates.ranked_pool(rated, cfg).orderBy("rank").collect()


def test_selection(spark):
    got = pool(spark, M2)
    assert [(r["rank"], r.tconst, r.primaryTitle) for r in got] == [
        (1, "t2", "M"), (2, "t1", "metropolis")]
    assert got[0].genres == ["Drama", "Comedy"]
    got = pool(spark, JobConfig(pool_rows=9, enrich_limit=1))
    assert [(r.tconst, r.looked_up) for r in got] == [("t2", True), ("t1", False), ("t8", False)]


def test_nan_rating_counts_as_rated(spark):
    got = pool(spark, M2, r=[("t1", "nan", "5"), ("t2", "abc", "9"), ("t8", "7", None)])
    assert [r.tconst for r in got] == ["t1"] and math.isnan(got[0].averageRating)


def test_last_rating_wins(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 5, 1), ("a", None, 7, 3), ("a", 2.0, 6, 2), ("b", 3.0, 1, 4)],
        "tconst string, averageRating double, numVotes long, ordering long")
    got = {r.tconst: (r.averageRating, r.numVotes)
           for r in candidates.last_per_key(df, "tconst", "ordering").collect()}
    assert got == {"a": (None, 7), "b": (3.0, 1)}


def test_initial_matches_full_upper_case(spark):
    words = ["ßtraße", "ﬁne", "ſix", "ıx", "Ix", "max", "Max", "Éa", "", "1st"]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    for letter in "SFIMÉ1":
        got = {r.t for r in df.filter(candidates.has_initial(F.col("t"), letter)).collect()}
        assert got == {w for w in words if w.upper().startswith(letter)}, letter


def test_plain_initials_have_no_foreign_partner():
    partners = {}
    for c in map(chr, range(0x110000)):
        partners.setdefault(c.upper()[0], []).append(c)
    for letter in candidates.PLAIN_INITIALS:
        assert partners[letter] == [letter, letter.lower()]


def test_fold_case_matches_caseless_form(spark):
    # Letters whose caseless form is not the lower case one, Cherokee apart.
    odd = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000
           and chr(c).casefold() != chr(c).lower() and not 0x13A0 <= c < 0x13FE
           and not 0xAB70 <= c < 0xABC0]
    words = odd + ["Straße", "ΟΔΟΣ", "οδος", "ıI", "İx", "MAX"]
    df = spark.createDataFrame([(w,) for w in words], "t string").coalesce(1)
    got = [r[0] for r in df.select(fold_case(F.col("t"))).collect()]
    wrong = [w for w, g in zip(words, got) if g != w.casefold()]
    assert len(wrong) <= 5, wrong


def credit_rows(spark):
    lines = ["actress n1", "actor n2", "actor n3", "actor n2", "director n4", "actor n5",
             "actor n6", "actor n7", "actor n8"]
    rows = [("t2", *line.split(), i) for i, line in enumerate(lines)]
    rows += [("t3", "actor", "", 1), ("t3", "actor", None, 2), ("zz", "actor", "n9", 1)]
    return spark.createDataFrame(
        rows, "tconst string, category string, nconst string, ordering long")


def test_lead_actors(spark):
    cfg = JobConfig()
    rows = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "tconst string")
    actors = credits.lead_actors(credits.credits_of(credit_rows(spark), rows, 3), cfg)
    got = {r.tconst: r.lead_actors_ids for r in credits.attach_actors(rows, actors).collect()}
    assert got == {"t1": [], "t2": ["n2", "n3", "n5", "n6", "n7"], "t3": []}


@pytest.mark.parametrize("k", [5, 2_500, 4_000, 9_000])
def test_ranked_top_k_is_exact_on_every_route(spark, k):
    # Half the rows share the leading value, so ranges must split inside it.
    df = spark.range(6000).select(
        F.col("id").cast("string").alias("tconst"),
        F.greatest(F.col("id") % 6, F.lit(3)).alias("v"))
    order = [F.desc("v"), F.asc("tconst")]
    ranked = ranking.ranked_top_k(df, order, k, F.col("v")).orderBy("rank")
    got = [tuple(r) for r in ranked.select("tconst", "rank").collect()]
    want = sorted(range(6000), key=lambda i: (-max(i % 6, 3), str(i)))[:k]
    assert got == [(str(i), n) for n, i in enumerate(want, 1)]
    cut = ranking.top_k(df, order, k, F.col("v"))
    assert cut.columns == df.columns and {r.tconst for r in cut.collect()} == {str(i) for i in want}


def test_lookup_join_with_hot_keys_equals_plain_join(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("key"))
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("unused", 4)], "key string, v int")
    plain = rows.join(dim, "key", "left").orderBy("id").collect()
    spread = lookup_join(rows, dim, "key", "id", hot_rows=320).orderBy("id")
    assert spread.columns == ["key", "id", "v"]
    assert spread.collect() == plain


def test_hot_key_rows_leave_their_single_task(spark):
    """A third of the rows share one key; no task may keep them all."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
             "spark.sql.adaptive.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    rows = spark.range(60_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 2000).alias("key"))
    dim = spark.range(2000).select(F.col("id").alias("key"), F.lit("x").alias("v"))
    try:
        for name, value in names.items():
            spark.conf.set(name, value)

        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert largest(rows.join(dim, "key", "left")) > 20_000
        assert largest(lookup_join(rows, dim, "key", "id", hot_rows=5_000)) < 10_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# ---- dataset, profile, checks ------------------------------------------------
def dataset_row(**changes):
    row = {"tconst": "t1", "primaryTitle": "M", "startYear": 1931, "genres": ["Crime"],
           "lead_actors_ids": ["n1"], "runtimeMinutes": 99, "averageRating": 8.3,
           "Language": "German", "Country": "Germany", "numVotes": 5, "budget": 1.5,
           "BoxOffice": 2.0, "plot": "x"}
    return tuple({**row, **changes}[c] for c in DATASET_COLUMNS)


def dataset_of(spark, *rows):
    return spark.createDataFrame(list(rows), DATASET)


def test_profile(spark):
    df = dataset_of(
        spark, dataset_row(), dataset_row(plot="", genres=[], averageRating=float("nan")),
        dataset_row(plot=None, budget=None, Language=""))
    got = {r.field: (r.missing_count, r.missing_percent) for r in
           profiling.missing_profile(df).collect()}
    assert list(got) == DATASET_COLUMNS
    assert got["plot"] == (2, 66.67) and got["genres"] == (1, 33.33)
    assert got["averageRating"] == (1, 33.33) and got["tconst"] == (0, 0.0)
    lines = {r.field: r.line for r in profiling.report_lines(profiling.missing_profile(df)).collect()}
    assert lines["plot"] == "plot: 2 missing (66.67%)"
    assert lines["tconst"] == "tconst: 0 missing (0.0%)"
    empty = profiling.missing_profile(df.limit(0)).collect()
    assert {(r.missing_count, r.missing_percent) for r in empty} == {(0, 0.0)}
    counters = profiling.dataset_counters(df).first()
    assert tuple(counters) == (3, 3, 1)


def test_text_lists_count_as_missing_in_text_form(spark):
    df = spark.createDataFrame([("[]", "a"), ("", None)], "genres string, plot string")
    got = {r.field: r.missing_count for r in profiling.missing_profile(df).collect()}
    assert got == {"genres": 2, "plot": 1}


def test_published_percentages(spark):
    # Published profile of the delivered dataset: missing rows of 7435 and percent.
    published = [(9, 0.12), (453, 6.09), (315, 4.24), (364, 4.9), (5424, 72.95), (4788, 64.4),
                 (1458, 19.61), (0, 0.0)]
    df = spark.range(7435).select(*[
        F.when(F.col("id") >= n, F.lit("x")).alias(f"c{i}") for i, (n, _) in enumerate(published)])
    got = [(r.missing_count, r.missing_percent) for r in profiling.missing_profile(df).collect()]
    assert got == published


def test_profile_diff(spark):
    a = profiling.missing_profile(dataset_of(spark, dataset_row(), dataset_row(plot="")))
    b = profiling.missing_profile(dataset_of(spark, dataset_row(), dataset_row()))
    assert profiling.profile_diff(a, a).count() == 0
    diff = profiling.profile_diff(a, b).collect()
    assert [tuple(r) for r in diff] == [("plot", 1, 50.0, 0, 0.0)]
    assert profiling.profile_diff(a, b.filter("field <> 'tconst'")).count() == 2


def test_quality(spark):
    cfg = JobConfig()
    good = dataset_of(spark, dataset_row(), dataset_row(primaryTitle="max"))
    quality.require_quality(quality.quality_checks(good, cfg, minimum_rows=2))
    bad = dataset_of(spark, dataset_row(primaryTitle="Alien", startYear=2025, runtimeMinutes=301),
                     dataset_row(plot="", Language="", Country=None, runtimeMinutes=59))
    checks = quality.quality_checks(bad.withColumn("extra", F.lit(1)), cfg)
    assert not any(r.passed for r in checks.collect())
    with pytest.raises(quality.QualityError, match="initials"):
        quality.require_quality(checks)


def test_strict_selection_and_rows(spark):
    cells = "struct<budget:string,BoxOffice:string,Language:string,Country:string,plot:string>"
    rows = spark.createDataFrame([(1, "a", None), (2, "b", (None, None, None, None, "")),
                                  (3, "c", ("$5 million", "", "French", None, "p"))],
                                 f"rank int, tconst string, fields {cells}")
    strict = dataset.select_rows(rows, JobConfig(target_rows=1, require_page=True))
    assert [r.tconst for r in strict.collect()] == ["b"]
    assert [r.tconst for r in dataset.select_rows(rows, M2).orderBy("rank").collect()] == ["a", "b"]
    full = rows.select("rank", "tconst", "fields", *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in DATASET
        if f.name in ("primaryTitle", "startYear", "genres", "lead_actors_ids", "runtimeMinutes",
                      "averageRating", "numVotes")])
    built = dataset.build_rows(full)
    assert built.schema.names == ["pos", *DATASET_COLUMNS]
    got = {r.tconst: (r.Language, r.Country, r.budget, r.BoxOffice, r.plot)
           for r in built.collect()}
    assert got["a"] == ("", "", None, None, "") and got["c"] == ("French", "", 5.0, None, "p")
    assert [r.tconst for r in dataset.enriched_only(built).collect()] == ["c"]


# ---- resumable runs ----------------------------------------------------------
def state_of(spark, entries):
    return spark.createDataFrame([(k, "T", "1", "old", n) for k, n in entries.items()], STATE)


def keyed(spark, enriched=("k1",), n=5):
    rows = [(i, f"k{i}", f"Title {i}", 1990, "x" if f"k{i}" in enriched else "", "", "",
             7.0, None) for i in range(1, n + 1)]
    return incremental.with_key(spark.createDataFrame(
        rows, "pos long, tconst string, primaryTitle string, startYear int, plot string, "
        "Language string, Country string, budget double, BoxOffice double"))


def run(spark, cfg, state, responses):
    rows = keyed(spark)
    decided = incremental.decide(rows, state, cfg)
    batch = incremental.next_batch(decided, cfg)
    out = materialise(incremental.attempt(batch, responses, cfg.batch_rows))
    merged = incremental.merge_enriched(rows, out)
    after = incremental.state_after(state, out, cfg, cfg.batch_rows)
    return (
        {r.key: r.action for r in decided.collect()},
        {r.key: r.outcome for r in out.collect()},
        {r.key: r for r in merged.collect()},
        {r.key: r for r in after.collect()},
        incremental.run_counters(decided, out, cfg).first(),
    )


def responses(spark, pages):
    rows = [(f"Title_{i}_1990_film", [(1, f"P{i}", text)] if text is not None else None)
            for i, text in pages.items()]
    return spark.createDataFrame(
        rows, "lookup_key string, pages array<struct<index:int,title:string,content:string>>")


def test_run_without_retry(spark):
    cfg = JobConfig(batch_rows=2)
    actions, outcome, merged, after, counters = run(
        spark, cfg, state_of(spark, {"k2": 0}),
        responses(spark, {3: "| country = \n| language = French\n| budget = x", 4: "none"}))
    assert actions == {"k1": "ignore", "k2": "skip", "k3": "attempt", "k4": "attempt", "k5": "attempt"}
    assert outcome == {"k3": "enriched", "k4": "missed"}
    row = merged["k3"]
    assert (row.Language, row.Country, row.plot, row.budget) == ("French", "", "", None)
    assert merged["k4"].budget == 7.0
    assert set(after) == {"k2", "k4"}
    assert (after["k4"].reason, after["k4"].retry_search_limit, after["k4"].year) == (
        "no usable Wikipedia fields in candidates: P4", 0, "1990")
    assert tuple(counters) == (2, 1, 1, 1)


def test_run_with_retry(spark):
    cfg = JobConfig(batch_rows=2, search_limit=8, retry_failed=True)
    state = state_of(spark, {"k2": 0, "k3": 8, "k9": None})
    actions, outcome, merged, after, counters = run(spark, cfg, state, responses(spark, {2: None}))
    assert actions == {"k1": "ignore", "k2": "attempt", "k3": "skip", "k4": "ignore", "k5": "ignore"}
    assert outcome == {"k2": "missed"}
    assert after["k2"].reason == "no Wikipedia search result"
    assert {k: r.retry_search_limit for k, r in after.items()} == {"k2": 8, "k3": 8, "k9": None}
    assert tuple(counters) == (1, 0, 1, 1)


def test_run_hit_clears_failure_and_no_response_changes_nothing(spark):
    cfg = JobConfig(batch_rows=9, search_limit=8, retry_failed=True)
    state = state_of(spark, {"k2": 0, "k3": 1})
    _, outcome, merged, after, counters = run(
        spark, cfg, state, responses(spark, {2: "== Plot ==\nStory"}))
    assert outcome == {"k2": "enriched", "k3": "no_response"}
    assert set(after) == {"k3"} and after["k3"].retry_search_limit == 1
    assert merged["k2"].plot == "Story" and tuple(counters) == (2, 1, 0, 0)


def test_skips_after_a_full_batch_are_not_counted(spark):
    state = state_of(spark, {"k2": 0, "k5": 0})
    for size, want in ((1, 1), (2, 1), (3, 2), (None, 2), (0, 0)):
        cfg = JobConfig(batch_rows=size)
        decided = incremental.decide(keyed(spark), state, cfg)
        tried = incremental.next_batch(decided, cfg).withColumn("outcome", F.lit("no_response"))
        counters = incremental.run_counters(decided, tried, cfg).first()
        assert tuple(counters) == (min(2 if size is None else size, 2), 0, 0, want), size


def test_settings(spark):
    cfg = JobConfig.from_settings({"TEAM_LETTER": " lx", "REQUIRE_WIKIPEDIA_PAGE": "yes"})
    assert (cfg.letter, cfg.require_page, cfg.pool_size, cfg.lookup_depth) == ("L", True, 30000, 10000)
    loop = JobConfig.from_settings({}, drain=True)
    assert (loop.batch_rows, loop.search_limit, loop.retry_failed) == (500, 8, True)
    assert JobConfig.from_settings({}) == JobConfig()
