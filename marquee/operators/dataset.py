"""Shape of the delivered dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import JobConfig
from marquee.functions.flags import is_core_complete, is_enriched
from marquee.operators.pages import with_money
from marquee.operators.ranking import top_k
from marquee.schemas import DATASET


def select_rows(looked_up: DataFrame, cfg: JobConfig) -> DataFrame:
    """First ``target_rows`` by rank; strict mode drops rows without a page.

    A row counts as having a page when any text was found for it (``fields``
    is set), whether or not that text held a usable field.
    """
    rows = looked_up.filter(F.col("fields").isNotNull()) if cfg.require_page else looked_up
    return top_k(rows, [F.asc("rank")], cfg.target_rows, -F.col("rank"))


def build_rows(selected: DataFrame) -> DataFrame:
    """``pos`` (the rank) and the thirteen dataset columns; absent text becomes ``''``."""
    computed = {
        **{c: F.coalesce(f"page_{c}", F.lit("")) for c in ("Language", "Country", "plot")},
        **{c: F.col(f"page_{c}") for c in ("budget", "BoxOffice")},
    }
    return with_money(selected).select(F.col("rank").alias("pos"), *[
        computed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in DATASET
    ])


def enriched_only(dataset: DataFrame) -> DataFrame:
    """Rows with at least one page-backed text column."""
    return dataset.filter(is_enriched())


def flag_rows(dataset: DataFrame) -> DataFrame:
    return dataset.withColumns({"enriched": is_enriched(), "core_complete": is_core_complete()})
