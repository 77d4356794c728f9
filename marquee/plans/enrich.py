"""Resumable enrichment of a stored dataset, one bounded run at a time."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Row

from marquee.config import JobConfig
from marquee.operators import incremental
from marquee.session import materialise
from marquee.sources.store import Store


def run_enrichment(store: Store, responses: DataFrame, cfg: JobConfig) -> Row:
    """Attempt the next batch, publish its changes, return the counters.

    The batch and the failures it passed over come from one pass over the pending
    rows. The outcomes are written once; changes and counters read that table, so
    responses are looked up and parsed a single time.
    """
    rows = incremental.with_key(store.pending())
    decided = incremental.decide(rows, store.state(), cfg)
    batch, skipped = incremental.batch_and_skips(decided, cfg)
    outcomes = materialise(incremental.attempt(batch, responses, cfg.batch_rows))
    store.append(outcomes, cfg, source="enrich")
    return incremental.counters(outcomes, skipped).first()


def drain(store: Store, responses: DataFrame, cfg: JobConfig) -> Row:
    """Work off everything the stored responses allow.

    A row's outcome depends on its own state only, so running chunk after chunk
    until nothing changes equals one run without a batch limit.
    """
    return run_enrichment(store, responses, replace(cfg, batch_rows=None))
