"""Physical plans: what is pushed, what is shuffled, what is not."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from marquee.catalog import queries as q
from marquee.catalog import standins as t
from marquee.operators import candidates, credits, incremental, pages
from marquee.operators.joins import _hot_keys, lookup_join
from marquee.operators import ranking
from marquee.operators.ranking import top_k
from marquee.session import materialise
from marquee.sources import catalogue


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    raw = t.raw_titles(spark, sf_dir)
    return catalogue.land_titles(raw, str(tmp_path_factory.mktemp("landed") / "titles"))


def test_all_title_filters_reach_the_scan(landed):
    text = full_plan(candidates.eligible_titles(landed, t.CONFIG).select("tconst"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    for part in ("EqualTo(titleType,STANDARD)", "StringStartsWith(primaryTitle,L)",
                 "StringStartsWith(primaryTitle,l)", "LessThanOrEqual(startYear,2024)",
                 "GreaterThanOrEqual(runtimeMinutes,60)", "LessThanOrEqual(runtimeMinutes,300)"):
        assert part in pushed, pushed
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "genres" not in schema


def test_pool_is_a_bounded_top_k(spark, sf_dir):
    text = plan(q.ranked_pool(spark, sf_dir))
    assert f"TakeOrderedAndProject(limit={t.CONFIG.pool_rows}" in text
    # The only single-task window sits above the cut.
    assert text.index("Window") < text.index("TakeOrderedAndProject")


@pytest.mark.parametrize("k", [30_000, 300_000])
def test_large_pool_is_cut_before_the_range_shuffle(spark, monkeypatch, k):
    """Only rows above a threshold are shuffled, and no task ranks over about 2k of them."""
    written = []

    def noted(df):
        written.append(plan(df))
        return materialise(df)

    monkeypatch.setattr(ranking, "materialise", noted)
    rows = materialise(spark.range(1_000_000).select(
        F.col("id").cast("string").alias("tconst"), F.pmod(F.xxhash64("id"), F.lit(90_000)).alias("v")))
    out = ranking.top_k(rows, [F.desc("v"), F.asc("tconst")], k, F.col("v"))
    assert "Exchange rangepartitioning" in written[0] and "Filter" in written[0]
    assert written[0].index("Exchange rangepartitioning") < written[0].index("Filter")
    assert "SinglePartition" not in written[0] and out.count() == k
    least = ranking._threshold(rows, k, F.col("v"))
    assert k <= rows.filter(F.col("v") >= least).count() <= 2 * k + 1_000


def test_actor_cut_runs_before_the_shuffle(spark, sf_dir):
    text = plan(credits.lead_actors(t.credits(spark, sf_dir), t.CONFIG))
    assert "row_number(), 5, Final" in text and "row_number(), 5, Partial" in text
    assert text.count("Exchange hashpartitioning") == 2


def test_credits_are_filtered_in_place(spark, sf_dir):
    ids = t.titles(spark, sf_dir).select("tconst").limit(50)
    text = plan(credits.credits_of(t.credits(spark, sf_dir), ids, 50))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    unbounded = plan(credits.credits_of(t.credits(spark, sf_dir), ids))
    assert "LeftSemi" in unbounded


def test_pages_are_parsed_once_and_before_the_shuffle(spark, sf_dir):
    answers = materialise(t.responses(spark, sf_dir))
    parsed = pages.parsed_responses(answers).filter("fields is not null").filter("page <> ''")
    text = plan(parsed)
    assert text.count("aggregate(") == 1 and "Exchange" not in text


def test_profile_moves_one_row_per_task(spark, sf_dir):
    text = plan(q.missing_profile(spark, sf_dir))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_small_batches_leave_the_dataset_in_place(spark, sf_dir):
    rows = t.dataset(spark, sf_dir)
    out = q._outcomes(spark, sf_dir, t.RUN)
    assert "SortMergeJoin" not in plan(incremental.merge_enriched(rows, out))
    after = plan(incremental.state_after(t.state(spark, sf_dir), out, t.RUN, t.RUN.batch_rows))
    assert "BroadcastHashJoin" in after and "LeftAnti" in after


def test_pending_filter_reaches_the_scan(spark, sf_dir):
    rows = materialise(t.dataset(spark, sf_dir))
    text = full_plan(incremental.pending(rows).select("pos"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "Or(IsNull(plot),EqualTo(plot,))" in pushed


def test_every_hot_key_is_sliced_by_its_size(spark):
    """Over 1,024 hot keys, one of them far larger than 64 slices of the limit."""
    rows = spark.range(400_000).select("id", F.when(F.col("id") < 200_000, F.lit(-1)).otherwise(
        F.col("id") % 1_500).alias("k"))
    hot = {r.k: r._slices for r in _hot_keys(rows, "k", "id", 64).collect()}
    assert len(hot) > 1_024 and hot[-1] > 2_000
    dim = spark.createDataFrame([(-1, 1), (7, 2)], "k long, v int")
    joined = lookup_join(rows, dim, "k", "id", hot_rows=64)
    assert joined.count() == 400_000 and joined.filter("v = 1").count() == 200_000
    assert "_slice" in plan(joined) and "TakeOrdered" not in plan(joined)


def test_last_record_per_key_uses_a_partial_hash_aggregate(spark, sf_dir):
    text = plan(q.last_rating(spark, sf_dir))
    assert "SortAggregate" not in text and "partial_max_by" in text


@pytest.mark.parametrize("name", ["markup_clean", "infobox_fields", "page_lookup", "final_rows",
                                  "lead_actors", "run_counters", "clean_float"])
def test_no_python_in_the_plan(spark, sf_dir, name):
    text = plan(q.QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "ArrowEval" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("by_file", [False, True])
@pytest.mark.parametrize("n", [0, 1, 137, 4_000, 9_000, 10**6])
def test_batch_ends_inside_one_part(spark, monkeypatch, by_file, n):
    """Batch and passed-over failures from counts per part, against the plain order."""
    monkeypatch.setattr(incremental, "PART_POSITIONS", 500)
    rows = spark.range(20_000).select(
        F.struct(F.format_string("f%05d", F.floor(F.col("id") / 700)).alias("file"), F.col("id").alias("row"))
        .alias("pos") if by_file else F.col("id").alias("pos"),
        F.when(F.col("id") % 7 < 3, "attempt").when(F.col("id") % 7 < 5, "skip").otherwise("ignore").alias("action"))
    kinds = ["attempt"] * 3 + ["skip"] * 2 + ["ignore"] * 2
    order = [kinds[k % 7] for k in range(20_000)]
    places = [k for k, a in enumerate(order) if a == "attempt"][:n]
    full = 0 < n == len(places)
    skips = order[:places[-1]].count("skip") if full else order.count("skip") if n else 0
    batch, passed = incremental.batch_and_skips(materialise(rows), replace(t.RUN, batch_rows=n))
    number = F.col("pos.row") if by_file else F.col("pos")
    assert sorted(r[0] for r in batch.select(number).collect()) == places and passed == skips


def test_batch_orders_rows_of_one_part_only(spark, monkeypatch):
    """A large batch of imported rows: nothing but the part it ends in is ranged or sorted."""
    written = []

    def noted(df):
        written.append(plan(df))
        return materialise(df)

    rows = materialise(spark.range(400_000).select(
        F.struct(F.format_string("f%05d", F.floor(F.col("id") / 50_000)).alias("file"), F.col("id").alias("row"))
        .alias("pos"), F.lit("attempt").alias("action")))
    monkeypatch.setattr(ranking, "materialise", noted)
    batch, _ = incremental.batch_and_skips(rows, replace(t.RUN, batch_rows=130_000))
    assert len(written) == 1 and "EqualTo(pos.file,f00002)" in full_plan(rows.filter(
        incremental._Parts(rows.schema["pos"].dataType).inside("f00002")))
    assert "Sort" not in plan(batch.filter("pos.file < 'f00002'")) and batch.count() == 130_000


def test_a_run_scans_its_pending_rows_for_sums_and_for_the_batch(spark, sf_dir):
    rows = incremental.with_key(incremental.pending(materialise(t.dataset(spark, sf_dir))))
    decided = incremental.decide(rows, t.state(spark, sf_dir), t.RUN)
    batch, skipped = incremental.batch_and_skips(decided, replace(t.RUN, batch_rows=20))
    # The counters read the outcomes and a number, no pending row.
    text = plan(incremental.counters(materialise(incremental.attempt(batch, t.responses(spark, sf_dir), 20)), skipped))
    assert text.count("FileScan") == 1


def test_top_k_zero(spark):
    assert top_k(spark.range(5), [F.asc("id")], 0, None).count() == 0
