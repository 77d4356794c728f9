"""One query per operator, each over whole stand-in tables.

Outputs are flat and typed alike for Spark and the SQL counterpart: counts are
bigint, rounded values double, lists joined text.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.catalog import standins as t
from marquee.config import JobConfig
from marquee.functions import pagetext, text
from marquee.functions.markup import clean_markup
from marquee.functions.money import money_millions
from marquee.functions.text import bind
from marquee.operators import (
    candidates, credits, dataset, incremental, pages, profiling, quality, ranking,
)
from marquee.plans.collect import collect_rows
from marquee.plans.enrich import drain, run_enrichment
from marquee.schemas import DATASET_COLUMNS
from marquee.session import materialise, scratch_path
from marquee.sources import catalogue, datasets
from marquee.sources import responses as stored
from marquee.sources.store import Store
from marquee.streaming.drain import Drain

Query = Callable[[SparkSession, str], DataFrame]


def _joined(column: str):
    return F.array_join(column, ", ").alias(column)


def _flat(df: DataFrame) -> DataFrame:
    """Lists as text, integers as bigint."""
    out = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind.startswith("array"):
            out.append(_joined(f.name))
        elif kind == "int":
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ---- titles and ratings ------------------------------------------------------
def candidate_projection(spark, sf):
    return _flat(t.typed_raw_titles(spark, sf))


def eligible_titles(spark, sf):
    return _flat(candidates.eligible_titles(t.typed_raw_titles(spark, sf), t.CONFIG))


def title_prefix(spark, sf):
    return t.titles(spark, sf).filter(
        candidates.has_initial(F.col("primaryTitle"), t.CONFIG.letter)
    ).select("tconst", "primaryTitle")


def last_rating(spark, sf):
    return candidates.last_per_key(t.repeated_ratings(spark, sf), "tconst", "ordering")


def _rated(spark, sf):
    return candidates.rated_candidates(
        candidates.eligible_titles(t.titles(spark, sf), t.CONFIG), t.ratings(spark, sf)
    )


def rated_candidates(spark, sf):
    return _flat(_rated(spark, sf))


def candidate_pool(spark, sf):
    return _flat(candidates.candidate_pool(_rated(spark, sf), t.CONFIG))


def ranked_pool(spark, sf):
    return _flat(candidates.ranked_pool(_rated(spark, sf), t.CONFIG))


def large_pool(spark, sf):
    """A pool of the default size, ranked, out of every rating record."""
    order = [F.desc("numVotes"), F.asc("ordering")]
    size = JobConfig().pool_size
    return ranking.ranked_top_k(
        t.repeated_ratings(spark, sf), order, size, F.col("numVotes")
    ).select("tconst", "numVotes", F.col("rank").cast("bigint").alias("rank"))


# ---- credits -----------------------------------------------------------------
def _selected(spark, sf):
    return candidates.eligible_titles(t.titles(spark, sf), t.CONFIG)


def credits_semi(spark, sf):
    return credits.credits_of(t.credits(spark, sf), _selected(spark, sf)).select(
        "tconst", "category", "nconst", "ordering"
    )


def lead_actors_rank(spark, sf):
    return _flat(credits.lead_actor_ranks(t.credits(spark, sf), t.CONFIG))


def lead_actors(spark, sf):
    actors = credits.lead_actors(t.credits(spark, sf), t.CONFIG)
    return _flat(credits.attach_actors(t.titles(spark, sf).select("tconst"), actors))


# ---- scalar functions --------------------------------------------------------
def clean_int(spark, sf):
    return t.raw_titles(spark, sf).select(
        "tconst",
        text.clean_int(F.col("startYear")).alias("year"),
        text.clean_int(F.col("runtimeMinutes")).alias("runtime"),
        text.clean_int(F.col("genres")).alias("in_genres"),
    )


def clean_float(spark, sf):
    return t.raw_titles(spark, sf).select(
        "tconst",
        text.clean_float(F.col("startYear")).alias("year"),
        text.clean_float(F.col("runtimeMinutes")).alias("runtime"),
    )


def list_field(spark, sf):
    return t.raw_titles(spark, sf).select(
        "tconst", text.list_text(text.list_field(F.col("genres"))).alias("genres")
    )


def first_value(spark, sf):
    return t.table(spark, sf, "documents").select(
        "doc_id", text.first_value(F.col("text")).alias("head")
    )


def lookup_key(spark, sf):
    return t.typed_raw_titles(spark, sf).select(
        "tconst",
        text.search_key(F.col("primaryTitle"), F.col("startYear")).alias("search_key"),
        text.combined_key(F.col("primaryTitle"), F.col("startYear")).alias("combined_key"),
    )


def markup_clean(spark, sf):
    cleaned = clean_markup(F.col("html"))
    return t.table(spark, sf, "pages").select("page_id", cleaned.alias("clean")).select(
        "page_id", F.md5("clean").alias("digest"), F.length("clean").cast("bigint").alias("n_chars")
    )


def infobox_fields(spark, sf):
    box = pagetext.infobox_fields(F.col("content"))
    return t.page_texts(spark, sf).select("part", "slot", box.alias("box")).select(
        "part", F.col("slot").cast("bigint").alias("slot"),
        "box.budget", "box.BoxOffice", "box.Language", "box.Country",
    )


def plot_section(spark, sf):
    return t.page_texts(spark, sf).select(
        "part", F.col("slot").cast("bigint").alias("slot"),
        pagetext.plot_section(F.col("content")).alias("plot"),
    )


def money(spark, sf):
    box = bind(pagetext.infobox_fields(F.col("content")), lambda b: F.transform(
        F.array(b["budget"], b["BoxOffice"]), money_millions
    ))
    return t.page_texts(spark, sf).select("part", "slot", box.alias("amounts")).select(
        "part", F.col("slot").cast("bigint").alias("slot"),
        F.col("amounts")[0].alias("budget"), F.col("amounts")[1].alias("BoxOffice"),
    )


# ---- page lookups ------------------------------------------------------------
def first_usable_page(spark, sf):
    return pages.parsed_responses(t.responses(spark, sf)).filter("fields is not null").select(
        "lookup_key", "page", "fields.Language", "fields.Country", "fields.plot",
    )


def miss_reason(spark, sf):
    return pages.parsed_responses(t.responses(spark, sf)).filter("fields is null").select(
        "lookup_key", "reason"
    )


def page_lookup(spark, sf):
    """Titles from 2020 on have not been asked for yet."""
    answers = t.responses(spark, sf).filter(~F.col("lookup_key").rlike("_20[23][0-9]_film$"))
    looked = pages.lookup_combined(t.titles(spark, sf), answers)
    return pages.with_money(looked.select(
        "tconst", "lookup_key", "has_response", "page", "reason", "fields"
    ))


# ---- collect -----------------------------------------------------------------
def _lookup(spark, sf):
    bodies = materialise(t.two_call_bodies(spark, sf))
    searches, parses = stored.search_responses(bodies), stored.parse_responses(bodies)
    return lambda rows, bound: pages.lookup_two_call(rows, searches, parses, bound)


def _collected(spark, sf, cfg):
    rows = collect_rows(
        t.titles(spark, sf), t.ratings(spark, sf), t.credits(spark, sf), _lookup(spark, sf), cfg
    )
    return rows.select(*DATASET_COLUMNS)


def strict_selection(spark, sf):
    ranked = candidates.ranked_pool(_rated(spark, sf), t.CONFIG)
    strict = replace(t.CONFIG, require_page=True, target_rows=10)
    looked = _lookup(spark, sf)(materialise(ranked), t.CONFIG.pool_size)
    return dataset.select_rows(looked, strict).select(
        F.col("rank").cast("bigint").alias("rank"), "tconst", "page"
    )


def final_rows(spark, sf):
    return _flat(_collected(spark, sf, t.CONFIG))


def final_enriched_only(spark, sf):
    return _flat(dataset.enriched_only(_collected(spark, sf, t.CONFIG)))


# ---- dataset, profile, checks ------------------------------------------------
def _dataset(spark, sf):
    return t.dataset(spark, sf).select(*DATASET_COLUMNS)


def enriched_flag(spark, sf):
    return dataset.flag_rows(t.dataset(spark, sf)).select("pos", "enriched", "core_complete")


def missing_profile(spark, sf):
    return profiling.missing_profile(_dataset(spark, sf))


def dataset_counters(spark, sf):
    return profiling.dataset_counters(_dataset(spark, sf))


def missing_report_lines(spark, sf):
    return profiling.report_lines(profiling.missing_profile(_dataset(spark, sf)))


def profile_document(spark, sf):
    document = profiling.profile_document(_dataset(spark, sf), t.CONFIG)
    return document.select(
        *[c for c in document.columns if c != "missing"],
        *[F.col(f"missing.{c}.missing_count").alias(f"{c}_count") for c in DATASET_COLUMNS],
        *[F.col(f"missing.{c}.missing_percent").alias(f"{c}_percent") for c in DATASET_COLUMNS],
    ).withColumns({c: F.col(c).cast("bigint") for c in (
        "target_movie_count", "candidate_pool_size", "wikipedia_enrich_limit")})


def profile_diff(spark, sf):
    rows = t.dataset(spark, sf)
    run = _outcomes(spark, sf, t.RUN)
    after = incremental.merge_enriched(rows, run)
    return profiling.profile_diff(
        profiling.missing_profile(rows, DATASET_COLUMNS),
        profiling.missing_profile(after, DATASET_COLUMNS),
    )


def validation_metrics(spark, sf):
    return quality.validation_metrics(_dataset(spark, sf), t.CONFIG)


def quality_checks(spark, sf):
    return quality.quality_checks(_dataset(spark, sf), t.CONFIG, minimum_rows=1000)


# ---- resumable enrichment ----------------------------------------------------
def _decided(spark, sf, cfg):
    rows = incremental.with_key(t.dataset(spark, sf))
    return incremental.decide(rows, t.state(spark, sf), cfg)


def _outcomes(spark, sf, cfg):
    rows = incremental.with_key(incremental.pending(t.dataset(spark, sf)))
    batch = incremental.next_batch(incremental.decide(rows, t.state(spark, sf), cfg), cfg)
    return materialise(incremental.attempt(batch, t.responses(spark, sf), cfg.batch_rows))


def _both_modes(make: Callable[..., DataFrame], spark, sf) -> DataFrame:
    parts = [make(spark, sf, cfg).withColumn("retry", F.lit(cfg.retry_failed))
             for cfg in (t.RUN, t.RETRY)]
    return parts[0].unionByName(parts[1])


def pending_rows(spark, sf):
    rows = incremental.with_key(t.dataset(spark, sf))
    return incremental.pending_rows(rows, t.state(spark, sf)).select("pos", "key")


def run_decisions(spark, sf):
    return _both_modes(_decided, spark, sf).select("retry", "pos", "key", "action")


def next_batch(spark, sf):
    def batch(spark, sf, cfg):
        return incremental.next_batch(_decided(spark, sf, cfg), cfg).select("pos", "key")

    return _both_modes(batch, spark, sf)


def run_outcomes(spark, sf):
    return _both_modes(_outcomes, spark, sf).select("retry", "pos", "key", "outcome", "reason")


def merge_enriched(spark, sf):
    def merged(spark, sf, cfg):
        return incremental.merge_enriched(t.dataset(spark, sf), _outcomes(spark, sf, cfg))

    return _both_modes(merged, spark, sf).select(
        "retry", "pos", "Language", "Country", "budget", "BoxOffice", "plot"
    )


def imported_batch(spark, sf):
    """Batch and passed-over failures over rows placed by file and row, as an import leaves them."""
    def batch(spark, sf, cfg):
        place = F.struct(F.format_string("part-%09d", F.floor(F.col("pos") / 300)).alias("file"),
                         F.col("pos").alias("row"))
        decided = _decided(spark, sf, cfg).withColumn("pos", place)
        rows, skipped = incremental.batch_and_skips(decided, cfg)
        return rows.select(F.col("pos.row").alias("pos"), "key", F.lit(skipped).cast("long").alias("skipped_failed"))

    return _both_modes(batch, spark, sf)


def state_after(spark, sf):
    def after(spark, sf, cfg):
        return incremental.state_after(
            t.state(spark, sf), _outcomes(spark, sf, cfg), cfg, cfg.batch_rows)

    return _flat(_both_modes(after, spark, sf))


def run_counters(spark, sf):
    def counters(spark, sf, cfg):
        return incremental.run_counters(
            _decided(spark, sf, cfg), _outcomes(spark, sf, cfg), cfg)

    return _both_modes(counters, spark, sf)


# ---- files, store, stream ----------------------------------------------------
def tsv_scan(spark, sf):
    """Raw titles out to a compressed export and back through the reader."""
    path = scratch_path(spark)
    t.raw_titles(spark, sf).write.csv(
        path, sep="\t", header=True, quote="", nullValue="\\N", emptyValue="", compression="gzip",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return _flat(candidates.project_titles(catalogue.read_titles(spark, path)).drop("ordering"))


def dataset_csv(spark, sf):
    """The dataset out to CSV and back, typed again."""
    path = scratch_path(spark)
    datasets.write_dataset_csv(t.dataset(spark, sf), path, order="pos")
    return _flat(datasets.typed_dataset(datasets.read_dataset_csv(spark, path)).drop("pos"))


def profile_json(spark, sf):
    path = scratch_path(spark)
    datasets.write_profile(t.dataset(spark, sf), t.CONFIG, path)
    return profiling.profile_of_document(datasets.read_profile(spark, path))


def state_lines(spark, sf):
    path = scratch_path(spark)
    datasets.write_state_lines(t.state(spark, sf), path)
    return _flat(datasets.read_state_lines(spark, path))


def scan_responses(spark, sf):
    answers = stored.combined_responses(t.combined_bodies(t.responses(spark, sf)), t.RUN.search_limit)
    return stored.candidate_pages(answers).select(
        "lookup_key", F.col("index").cast("bigint").alias("index"), "title",
        F.md5("content").alias("digest"),
    )


def two_call_lookup(spark, sf):
    ranked = materialise(candidates.ranked_pool(_rated(spark, sf), t.CONFIG))
    bodies = t.two_call_bodies(spark, sf)
    looked = pages.lookup_two_call(
        ranked, stored.search_responses(bodies), stored.parse_responses(bodies),
        t.CONFIG.pool_size)
    return pages.with_money(looked.select("tconst", "page", "fields"))


def two_call_every(spark, sf):
    """Every part asked for through two calls, without a bound on the rows."""
    bodies = t.two_call_bodies(spark, sf)
    looked = pages.lookup_two_call(
        t.titles(spark, sf), stored.search_responses(bodies), stored.parse_responses(bodies))
    return pages.with_money(looked.select("tconst", "page", "fields"))


def _new_store(spark, sf) -> Store:
    store = Store(spark, scratch_path(spark))
    store.publish(t.dataset(spark, sf), t.state(spark, sf), t.CONFIG)
    return store


_PAGE_COLUMNS = ["pos", "Language", "Country", "budget", "BoxOffice", "plot"]


def enrich_run(spark, sf):
    """One published run over a stored dataset."""
    store = _new_store(spark, sf)
    run_enrichment(store, t.responses(spark, sf), t.RUN)
    return store.dataset().select(*_PAGE_COLUMNS)


# Bytes of bodies that one file of landed responses holds, about.
LANDED_BYTES = 128 * 1024 * 1024


def _land(bodies: DataFrame, path: str, batches: int, each: int, by) -> int:
    """Write bodies as files dealt by ``by``; how many of them a micro-batch takes.

    The stream takes ``batches`` micro-batches whatever the size: of ``each`` files,
    or of as many more as keep a file, and so a task that writes one, small.
    """
    rows = materialise(bodies)
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    per_batch = max(each, math.ceil(size / LANDED_BYTES / batches))
    rows.repartition(batches * per_batch, by).write.parquet(path)
    return per_batch


def drain_stream(spark, sf):
    """Stream of landed responses drained into a stored dataset in two batches."""
    store, landed = _new_store(spark, sf), scratch_path(spark)
    files = _land(t.combined_bodies(t.responses(spark, sf)), landed, 2, 2, "name")
    Drain(store, "landed", replace(t.RUN, checkpoint_rows=files)).run_landed(landed)
    return store.dataset().select(*_PAGE_COLUMNS)


def _drained_twice(spark, sf) -> Store:
    """A first drain, then one that retries, both under one name."""
    store, landed = _new_store(spark, sf), scratch_path(spark)
    files = _land(t.combined_bodies(t.responses(spark, sf)), landed, 2, 2, "name")
    for cfg in (t.RUN, t.RETRY):
        Drain(store, "landed", replace(cfg, checkpoint_rows=files)).run_landed(landed)
    return store


def drain_retry(spark, sf):
    return _drained_twice(spark, sf).dataset().select(*_PAGE_COLUMNS)


def drain_retry_state(spark, sf):
    return _flat(_drained_twice(spark, sf).state())


def drain_profile(spark, sf):
    """The stored profile after two drains, kept by the changed rows alone."""
    return profiling.profile_of_document(_drained_twice(spark, sf).profile())


def enrich_repeated(spark, sf):
    """One run over responses that hold several answers per request; counters beside the rows."""
    store = _new_store(spark, sf)
    got = run_enrichment(store, t.repeated_responses(spark, sf), t.RUN)
    return store.dataset().agg(F.count("*").alias("n_rows"), F.countDistinct("pos").alias("n_pos")).select(
        "*", F.lit(got.attempted).cast("long").alias("attempted"),
        F.lit(got.enriched).cast("long").alias("enriched"))


def drain_repeated(spark, sf):
    """Stream of landed responses, several per request and a third of the files each time, into a store."""
    store, landed = _new_store(spark, sf), scratch_path(spark)
    files = _land(t.combined_bodies(t.repeated_responses(spark, sf)), landed, 3, 1, F.md5("body"))
    Drain(store, "repeated", replace(t.RUN, checkpoint_rows=files)).run_landed(landed)
    page = F.col("plot").isin("", "Known story", "Old story") & (F.col("Language") == "") & (
        F.col("Country") == "")
    return store.dataset().select("pos", (~page).alias("enriched"))


# Rows of a state document.
STATE_ROWS = 50_000


def state_json(spark, sf):
    """Failure state out of the one-document JSON form, beside files that hold none."""
    path = scratch_path(spark)
    entry = F.struct("title", "year", "reason", "retry_search_limit")
    rows = t.state(spark, sf)
    files = max(16, math.ceil(rows.count() / STATE_ROWS))
    parted = rows.withColumn("file", F.pmod(F.xxhash64("key"), F.lit(files)))
    held = F.map_from_entries(F.collect_list(F.struct("key", entry)))
    documents = parted.groupBy("file").agg(held.alias("m")).select(
        F.concat(F.lit("d"), "file").alias("file"),
        # Every other file in the layout of a written state, the rest on one line.
        F.when(F.col("file") % 2 == 0, F.to_json(F.struct(F.col("m").alias("failed_rows")), {"pretty": "true"}))
        .otherwise(F.to_json(F.struct(F.col("m").alias("failed_rows")))).alias("value"))
    broken = documents.select(F.concat(F.lit("cut"), "file").alias("file"),
                              F.expr("left(value, length(value) - 3)").alias("value"))
    other = documents.select(F.concat(F.lit("list"), "file").alias("file"),
                             F.concat(F.lit("["), "value", F.lit("]")).alias("value"))
    empty = documents.select(F.concat(F.lit("empty"), "file").alias("file"), F.lit("{}").alias("value"))
    documents.union(broken).union(other).union(empty).write.partitionBy("file").text(path)
    return _flat(datasets.read_state_json(spark, path))


def store_restart(spark, sf):
    """Two runs over one store, the second one on what the first has left."""
    store = _new_store(spark, sf)
    for _ in range(2):
        run_enrichment(Store(spark, store.root), t.responses(spark, sf), t.RUN)
    return store.dataset().select(*_PAGE_COLUMNS)


def title_files(spark, sf):
    """Raw titles in several files of unequal size; the last row of a repeated title counts."""
    path, raw = scratch_path(spark), t.raw_titles(spark, sf)
    late = raw.filter("tconst % 3 = 0").withColumn("primaryTitle", F.concat(F.lit("Late "), "primaryTitle"))
    for name, rows in (("a", raw), ("b", late)):
        rows.write.csv(
            f"{path}/part={name}", sep="\t", header=True, quote="", nullValue="\\N", emptyValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    titles = candidates.project_titles(catalogue.read_titles(spark, path))
    every = replace(t.CONFIG, max_year=9999, min_runtime=0, max_runtime=9999)
    return _flat(candidates.eligible_titles(titles, every))


def drain_state(spark, sf):
    """Failure state after draining everything in one batch job."""
    store = _new_store(spark, sf)
    drain(store, t.responses(spark, sf), t.RUN)
    return _flat(store.state())


QUERIES: dict[str, Query] = {
    "candidate_projection": candidate_projection,
    "eligible_titles": eligible_titles,
    "title_prefix": title_prefix,
    "last_rating": last_rating,
    "rated_candidates": rated_candidates,
    "candidate_pool": candidate_pool,
    "ranked_pool": ranked_pool,
    "large_pool": large_pool,
    "credits_semi": credits_semi,
    "lead_actors_rank": lead_actors_rank,
    "lead_actors": lead_actors,
    "clean_int": clean_int,
    "clean_float": clean_float,
    "list_field": list_field,
    "first_value": first_value,
    "lookup_key": lookup_key,
    "markup_clean": markup_clean,
    "infobox_fields": infobox_fields,
    "plot_section": plot_section,
    "money_millions": money,
    "first_usable_page": first_usable_page,
    "miss_reason": miss_reason,
    "page_lookup": page_lookup,
    "strict_selection": strict_selection,
    "final_rows": final_rows,
    "final_enriched_only": final_enriched_only,
    "enriched_flag": enriched_flag,
    "missing_profile": missing_profile,
    "dataset_counters": dataset_counters,
    "missing_report_lines": missing_report_lines,
    "profile_document": profile_document,
    "profile_diff": profile_diff,
    "validation_metrics": validation_metrics,
    "quality_checks": quality_checks,
    "pending_rows": pending_rows,
    "run_decisions": run_decisions,
    "next_batch": next_batch,
    "imported_batch": imported_batch,
    "run_outcomes": run_outcomes,
    "merge_enriched": merge_enriched,
    "state_after": state_after,
    "run_counters": run_counters,
    "tsv_scan": tsv_scan,
    "dataset_csv": dataset_csv,
    "profile_json": profile_json,
    "state_lines": state_lines,
    "scan_responses": scan_responses,
    "two_call_lookup": two_call_lookup,
    "two_call_every": two_call_every,
    "enrich_run": enrich_run,
    "drain_stream": drain_stream,
    "drain_state": drain_state,
    "drain_retry": drain_retry,
    "drain_retry_state": drain_retry_state,
    "drain_profile": drain_profile,
    "enrich_repeated": enrich_repeated,
    "drain_repeated": drain_repeated,
    "state_json": state_json,
    "store_restart": store_restart,
    "title_files": title_files,
}
