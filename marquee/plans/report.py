"""Profile report and delivery of a finished dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.config import JobConfig
from marquee.operators.dataset import enriched_only
from marquee.operators.profiling import (
    missing_profile, profile_diff, profile_of_document, report_lines,
)
from marquee.operators.quality import MINIMUM_ROWS, quality_checks, require_quality
from marquee.schemas import DATASET_COLUMNS
from marquee.sources.datasets import read_profile, write_dataset_csv, write_profile


def report(dataset: DataFrame, cfg: JobConfig, profile_path: str) -> DataFrame:
    """Write the profile document and return one line of text per column."""
    write_profile(dataset, cfg, profile_path)
    document = read_profile(dataset.sparkSession, profile_path)
    return report_lines(profile_of_document(document))


def check_profile(dataset: DataFrame, document: DataFrame) -> DataFrame:
    """Differences between a stored profile document and the dataset."""
    return profile_diff(
        profile_of_document(document), missing_profile(dataset.select(*DATASET_COLUMNS))
    )


def deliver(
    dataset: DataFrame, cfg: JobConfig, csv_path: str, profile_path: str,
    minimum_rows: int = MINIMUM_ROWS, order: str | None = "pos",
) -> DataFrame:
    """Keep enriched rows, check them, export CSV and profile, return the lines."""
    final = enriched_only(dataset)
    require_quality(quality_checks(final.select(*DATASET_COLUMNS), cfg, minimum_rows))
    write_dataset_csv(final, csv_path, order)
    return report(final, cfg, profile_path)
