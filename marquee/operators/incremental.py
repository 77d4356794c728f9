"""One resumable enrichment run: decide, attempt, merge, remember misses.

``rows`` carry a unique, totally ordered ``pos`` (dataset order) and ``key``
(row identity used by the failure state).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.config import JobConfig
from marquee.functions.flags import is_enriched, is_pending
from marquee.functions.text import row_key
from marquee.operators.joins import BROADCAST_KEYS
from marquee.operators.pages import lookup_combined, with_money
from marquee.operators.ranking import DIRECT_ROWS, top_k
from marquee.schemas import STATE
from marquee.session import materialise

ATTEMPT, SKIP, IGNORE = "attempt", "skip", "ignore"
ENRICHED, MISSED, NO_RESPONSE = "enriched", "missed", "no_response"
# Cells that an enriched row may get anew: text keeps its old value where the page has none.
TEXT_CELLS, AMOUNT_CELLS = ("Language", "Country", "plot"), ("budget", "BoxOffice")
# Positions that share a part where positions are numbers; imported rows go by file.
PART_POSITIONS = 65_536


def pending(dataset: DataFrame) -> DataFrame:
    """Rows that still lack page fields; the test reaches the file scan."""
    return dataset.filter(is_pending())


def with_key(dataset: DataFrame) -> DataFrame:
    return dataset.withColumn(
        "key", row_key(F.col("tconst"), F.col("primaryTitle"), F.col("startYear"))
    )


def pending_rows(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows without page fields that are not known failures."""
    return pending(rows).join(state.select("key"), "key", "left_anti")


def decide(rows: DataFrame, state: DataFrame, cfg: JobConfig) -> DataFrame:
    """Add ``action``: attempt, skip (counted) or ignore.

    Keys are unique but for rows without an id; adaptive skew handling splits
    the partition if many of those share a title and year.
    """
    known = state.select(
        "key", F.coalesce("retry_search_limit", F.lit(0)).alias("_tried"), F.lit(True).alias("_known")
    )
    joined = rows.join(known, "key", "left")
    seen = F.coalesce("_known", F.lit(False))
    if cfg.retry_failed:
        action = (
            F.when(F.coalesce("_tried", F.lit(0)) >= cfg.search_limit, SKIP)
            .when(seen, ATTEMPT).otherwise(IGNORE)
        )
    else:
        action = F.when(seen, SKIP).otherwise(ATTEMPT)
    return joined.withColumn(
        "action", F.when(is_enriched(), IGNORE).otherwise(action)
    ).drop("_tried", "_known")


def next_batch(decided: DataFrame, cfg: JobConfig) -> DataFrame:
    """First ``batch_rows`` rows to attempt, in dataset order; ``None`` takes all."""
    todo = decided.filter(F.col("action") == ATTEMPT)
    if cfg.batch_rows is None:
        return todo
    if cfg.batch_rows <= DIRECT_ROWS:
        return top_k(todo, [F.asc("pos")], max(cfg.batch_rows, 0), None)
    return batch_and_skips(decided, cfg)[0]


class _Parts:
    """Positions cut into parts that follow each other: numbers by width, imported rows by file."""

    def __init__(self, kind: T.DataType) -> None:
        self.by_file = isinstance(kind, T.StructType)
        self.place = F.col("pos.file") if self.by_file else F.col("pos")
        self.number = self.place if self.by_file else F.floor(self.place / PART_POSITIONS)
        # A number that falls along the positions of one part.
        self.lead = -F.col("pos.row") if self.by_file else -F.col("pos")

    def _bound(self, part) -> Column:
        return F.lit(part) if self.by_file else F.lit(part * PART_POSITIONS)

    # Written as bounds of the stored column, so that they reach the file scan.
    def before(self, part) -> Column:
        return self.place < self._bound(part)

    def inside(self, part) -> Column:
        if self.by_file:
            return self.place == self._bound(part)
        return (self.place >= self._bound(part)) & (self.place < self._bound(part + 1))


def batch_and_skips(decided: DataFrame, cfg: JobConfig) -> tuple[DataFrame, int]:
    """(rows to attempt, known failures passed over before the batch was full).

    One pass over the pending rows counts both kinds per part of the positions; a
    prefix sum over the parts finds the one in which the batch ends. Parts before
    it are taken as they are, and only that one is ordered, whatever the batch size
    and however positions are made.
    """
    counts = [F.count_if(F.col("action") == a).alias(a) for a in (ATTEMPT, SKIP)]
    todo = decided.filter(F.col("action") == ATTEMPT)
    if cfg.batch_rows is None:
        return todo, decided.agg(*counts).first()[SKIP]
    if cfg.batch_rows <= 0:
        return todo.limit(0), 0
    parts = _Parts(decided.schema["pos"].dataType)
    sums = decided.groupBy(parts.number.alias("part")).agg(*counts)
    # One row per part: as many as files, or as blocks of positions.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", ATTEMPT, *[
        F.coalesce(F.sum(a).over(earlier), F.lit(0)).alias(f"{a}_before") for a in (ATTEMPT, SKIP)], SKIP)
    full = F.col(f"{ATTEMPT}_before") + F.col(ATTEMPT) >= cfg.batch_rows
    found = sums.agg(F.min_by(F.struct(*sums.columns), F.when(full, F.col("part"))).alias("cut"),
                     F.coalesce(F.sum(SKIP), F.lit(0)).alias("all")).first()
    if found.cut is None:
        return todo, found.all
    wanted = cfg.batch_rows - found.cut[f"{ATTEMPT}_before"]
    there = decided.filter(parts.inside(found.cut.part))
    last_rows = materialise(top_k(there.filter(F.col("action") == ATTEMPT), [F.asc("pos")], wanted, parts.lead))
    last = last_rows.agg(F.max("pos").alias("last"))
    passed = there.filter(F.col("action") == SKIP).filter(F.col("pos") < last.scalar()).count()
    rows = todo.filter(parts.before(found.cut.part)).unionByName(last_rows)
    return rows, found.cut[f"{SKIP}_before"] + passed


def outcomes_of(looked: DataFrame, *kept: str) -> DataFrame:
    """What came of every attempted row, with its parsed page columns and ``kept`` ones."""
    outcome = (
        F.when(~F.col("has_response"), NO_RESPONSE)
        .when(F.col("fields").isNull(), MISSED).otherwise(ENRICHED)
    )
    return with_money(looked.select(
        "pos", "key", "primaryTitle", F.col("startYear").cast("string").alias("year"),
        outcome.alias("outcome"), "reason", "fields", *kept,
    ))


def attempt(batch: DataFrame, responses: DataFrame, at_most: int | None) -> DataFrame:
    """Look the batch up in the stored responses; the batch is written once for both its uses."""
    rows = materialise(batch.select("pos", "key", "primaryTitle", "startYear", *cells_before(batch)))
    return outcomes_of(lookup_combined(rows, responses, "pos", at_most), *_carried(rows))


def cells_before(rows: DataFrame) -> list[Column]:
    """The cells a run may change as they are now, carried beside its outcomes."""
    cells = (*TEXT_CELLS, *AMOUNT_CELLS)
    return [F.struct(*cells).alias("before")] if set(cells) <= set(rows.columns) else []


def _carried(rows: DataFrame) -> list[str]:
    return [c for c in ("before",) if c in rows.columns]


def cells_after(old: str = "") -> dict[str, Column]:
    """The changed cells of a row with a hit; ``old`` is where its cells were before."""
    return {**{c: F.coalesce(f"page_{c}", f"{old}{c}") for c in TEXT_CELLS},
            **{c: F.col(f"page_{c}") for c in AMOUNT_CELLS}}


def merge_enriched(dataset: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Dataset with the enriched rows overwritten.

    Text the page did not name keeps its old value; amounts are always replaced.
    Outcomes read from a written table have a known size, so a small batch is
    broadcast by the optimiser and the dataset stays where it is.
    """
    hits = outcomes.filter(F.col("outcome") == ENRICHED).select(
        "pos", F.lit(True).alias("_hit"),
        "page_Language", "page_Country", "page_budget", "page_BoxOffice", "page_plot",
    )
    joined = dataset.join(hits, "pos", "left")
    hit = F.coalesce("_hit", F.lit(False))
    updated = {c: F.when(hit, new).otherwise(F.col(c)) for c, new in cells_after().items()}
    return joined.select(*[
        updated.get(c, F.col(c)).alias(c) for c in dataset.columns
    ])


def state_changes(outcomes: DataFrame, cfg: JobConfig) -> DataFrame:
    """Last change per key: an entry to upsert, or ``outcome = enriched`` to delete."""
    tried = outcomes.filter(F.col("outcome") != NO_RESPONSE)
    return tried.groupBy("key").agg(
        F.max_by("outcome", "pos").alias("outcome"),
        F.max_by("primaryTitle", "pos").alias("title"),
        F.max_by("year", "pos").alias("year"),
        F.max_by("reason", "pos").alias("reason"),
        F.lit(cfg.search_limit if cfg.retry_failed else 0).cast("int").alias("retry_search_limit"),
    )


def state_after(
    state: DataFrame, outcomes: DataFrame, cfg: JobConfig, at_most: int | None = None
) -> DataFrame:
    """Failure state after a run: hits deleted, misses upserted, the rest kept."""
    return state_with(state, state_changes(outcomes, cfg), at_most)


def state_with(state: DataFrame, changes: DataFrame, at_most: int | None = None) -> DataFrame:
    """State with one change per key applied."""
    touched = changes.select("key")
    if at_most is not None and at_most <= BROADCAST_KEYS:
        touched = F.broadcast(touched)
    kept = state.select(*STATE.names).join(touched, "key", "left_anti")
    misses = changes.filter(F.col("outcome") == MISSED).select(*STATE.names)
    return kept.unionByName(misses)


def run_counters(decided: DataFrame, outcomes: DataFrame, cfg: JobConfig) -> DataFrame:
    """One row: attempted, enriched, newly_failed, skipped_failed.

    A known failure is counted only when it lies before the row that filled the
    batch; a batch that never filled counts them all.
    """
    return counters(outcomes, batch_and_skips(decided, cfg)[1])


def counters(outcomes: DataFrame, skipped: int) -> DataFrame:
    """The run's counters where the passed-over failures were counted with its batch."""
    return outcomes.agg(
        F.count("*").alias("attempted"),
        F.count_if(F.col("outcome") == ENRICHED).alias("enriched"),
        F.count_if(F.col("outcome") == MISSED).alias("newly_failed"),
        F.lit(skipped).cast("long").alias("skipped_failed"),
    )
