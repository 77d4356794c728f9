"""Constraint checks on the delivered dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import JobConfig
from marquee.functions.flags import is_enriched
from marquee.operators.candidates import has_initial
from marquee.schemas import DATASET_COLUMNS

# Fixed value: smallest dataset that may be delivered.
MINIMUM_ROWS = 5000


class QualityError(RuntimeError):
    """The dataset breaks a constraint."""


def validation_metrics(df: DataFrame, cfg: JobConfig) -> DataFrame:
    """One row of observed values, from a single pass."""
    initial_ok = F.coalesce(has_initial(F.col("primaryTitle"), cfg.letter), F.lit(False))
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(~initial_ok).alias("wrong_initials"),
        F.max("startYear").cast("bigint").alias("max_year"),
        F.min("runtimeMinutes").cast("bigint").alias("min_runtime"),
        F.max("runtimeMinutes").cast("bigint").alias("max_runtime"),
        F.count_if(is_enriched()).alias("enriched_rows"),
    )


def quality_checks(
    df: DataFrame, cfg: JobConfig, minimum_rows: int = MINIMUM_ROWS,
    columns: list[str] | None = None,
) -> DataFrame:
    """(check, observed, passed) for every constraint."""
    expected = DATASET_COLUMNS if columns is None else columns
    rules = {
        "minimum_rows": ("row_count", F.col("row_count") >= minimum_rows),
        "columns": (None, F.lit(df.columns == expected)),
        "initials": ("wrong_initials", F.col("wrong_initials") == 0),
        "max_year": ("max_year", F.col("max_year") <= cfg.max_year),
        "min_runtime": ("min_runtime", F.col("min_runtime") >= cfg.min_runtime),
        "max_runtime": ("max_runtime", F.col("max_runtime") <= cfg.max_runtime),
        "all_enriched": ("enriched_rows", F.col("enriched_rows") == F.col("row_count")),
    }
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("check"),
            (F.col(metric) if metric else F.lit(len(df.columns))).cast("bigint").alias("observed"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )
        for name, (metric, passed) in rules.items()
    ])
    return validation_metrics(df, cfg).select(F.inline(entries))


def require_quality(checks: DataFrame) -> None:
    """Raise with the failed checks; there are only a handful of rows."""
    failed = [f"{r['check']} ({r['observed']})" for r in checks.filter(~F.col("passed")).collect()]
    if failed:
        raise QualityError("failed checks: " + ", ".join(failed))
