"""Catalogue tables: tab-separated exports in, sorted Parquet out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.text import unquote
from marquee.operators.candidates import last_per_key, project_ratings, project_titles

# Columns each table is read for; a file without one of them yields NULLs.
TITLE_FIELDS = ["tconst", "titleType", "primaryTitle", "startYear", "runtimeMinutes", "genres"]
RATING_FIELDS = ["tconst", "averageRating", "numVotes"]
CREDIT_FIELDS = ["tconst", "category", "nconst"]


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-string rows by header name, plus ``ordering``: file, block of the file, row.

    The reader packs large files first, so a running number alone would order
    rows of several files by file size.

    Missing cells stay spelled as in the file; the cell cleaners know them.

    The parser itself ignores quotes: with quoting on, one stray leading quote
    would swallow the rest of the file. Quotes that close inside their cell are
    removed afterwards.
    """
    raw = (
        spark.read.option("sep", "\t").option("header", True)
        .option("quote", "")
        .csv(path)
    )
    picked = [
        unquote(F.col(f"`{c}`")).alias(c) if c in raw.columns
        else F.lit(None).cast("string").alias(c)
        for c in columns
    ]
    return raw.select(*picked, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias("ordering"))


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, TITLE_FIELDS)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, RATING_FIELDS)


def read_credits(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, CREDIT_FIELDS)


def _land(df: DataFrame, path: str, *sort: str) -> DataFrame:
    """Write range-partitioned by ``sort`` so row-group statistics are narrow.

    A compressed export arrives as one task; the range shuffle also gives the
    table its parallelism. The last sort column is unique enough to split runs
    of equal leading values.
    """
    df.repartitionByRange(*sort).sortWithinPartitions(*sort).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def land_titles(raw: DataFrame, path: str) -> DataFrame:
    """Typed, trimmed titles clustered by type and title, with their file order."""
    return _land(project_titles(raw), path, "titleType", "primaryTitle", "tconst")


def land_ratings(raw: DataFrame, path: str) -> DataFrame:
    """Typed ratings, last record per title."""
    return _land(last_per_key(project_ratings(raw), "tconst", "ordering"), path, "tconst")


def land_credits(raw: DataFrame, path: str) -> DataFrame:
    """Credits clustered by title, in file order."""
    return _land(raw, path, "tconst", "ordering")
