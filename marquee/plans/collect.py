"""Collect: pool, page lookups, selection, actors, final rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import JobConfig
from marquee.operators.candidates import eligible_titles, ranked_pool, rated_candidates
from marquee.operators.credits import attach_actors, credits_of, lead_actors
from marquee.operators.dataset import build_rows, select_rows
from marquee.session import materialise

# Adds a ``fields`` struct (NULL without a page) to rows bounded by the number.
PageLookup = Callable[[DataFrame, int], DataFrame]


class ShortfallError(RuntimeError):
    """Fewer rows qualified than the target asks for."""


def select_with_pages(
    titles: DataFrame, ratings: DataFrame, lookup: PageLookup, cfg: JobConfig
) -> DataFrame:
    """Ranked, page-joined rows, at most ``target_rows`` of them."""
    ranked = ranked_pool(
        rated_candidates(eligible_titles(titles, cfg), ratings), cfg
    )
    if not cfg.require_page:
        # Without the page filter only the first rows can be selected.
        ranked = ranked.filter(F.col("rank") <= cfg.target_rows)
    # The wide scans above run once; everything below works on bounded rows.
    ranked = materialise(ranked)
    deep = min(cfg.lookup_depth, cfg.pool_size)
    found = lookup(ranked.filter("looked_up"), deep).select("rank", "fields")
    looked = ranked.drop("looked_up").join(found, "rank", "left")
    return select_rows(looked, cfg)


def collect_rows(
    titles: DataFrame, ratings: DataFrame, credits: DataFrame, lookup: PageLookup, cfg: JobConfig
) -> DataFrame:
    """Dataset rows in rank order ``pos``; credits are read for selected titles only."""
    selected = materialise(select_with_pages(titles, ratings, lookup, cfg))
    actors = lead_actors(credits_of(credits, selected, cfg.target_rows), cfg)
    return build_rows(attach_actors(selected, actors))


def collect_dataset(
    titles: DataFrame, ratings: DataFrame, credits: DataFrame, lookup: PageLookup, cfg: JobConfig
) -> DataFrame:
    """``collect_rows`` that insists on ``target_rows`` rows, like a delivery must."""
    rows = materialise(collect_rows(titles, ratings, credits, lookup, cfg))
    got = rows.count()
    if got < cfg.target_rows:
        raise ShortfallError(
            f"only {got} of {cfg.target_rows} rows qualified; "
            f"raise the pool size above {cfg.pool_size}"
        )
    return rows
