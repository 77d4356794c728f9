"""Missing-value profile and row counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.config import JobConfig
from marquee.functions.flags import is_core_complete, is_enriched, is_missing
from marquee.functions.numbers import round2


def _percent(missing: Column, total: Column) -> Column:
    return F.when(total > 0, round2(missing / total * 100)).otherwise(F.lit(0.0))


def _missing_totals(df: DataFrame, columns: list[str]) -> list[Column]:
    kinds = {f.name: f.dataType for f in df.schema}
    return [F.count_if(is_missing(F.col(c), kinds[c])).alias(f"_missing_{c}") for c in columns]


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(field, missing_count, missing_percent) from a single pass."""
    columns = columns or df.columns
    totals = df.agg(F.count("*").alias("_rows"), *_missing_totals(df, columns))
    entries = F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"_missing_{c}").alias("missing_count"))
        for c in columns
    ])
    return totals.select("_rows", F.inline(entries)).select(
        "field", "missing_count",
        _percent(F.col("missing_count"), F.col("_rows")).alias("missing_percent"),
    )


def _counts() -> list[Column]:
    return [
        F.count("*").alias("movie_count"),
        F.count_if(is_enriched()).alias("wikipedia_enriched_count"),
        F.count_if(is_core_complete()).alias("wikipedia_core_complete_count"),
    ]


def dataset_counters(df: DataFrame) -> DataFrame:
    """One row: all rows, enriched rows, core-complete rows."""
    return df.agg(*_counts())


def profile_totals(df: DataFrame) -> DataFrame:
    """One row of counts: all, enriched and complete rows, and missing cells per column."""
    return df.agg(*_counts(), *_missing_totals(df, df.columns))


def profile_document(df: DataFrame, cfg: JobConfig) -> DataFrame:
    """One row holding counters, settings and the profile of every column."""
    return document_of_totals(profile_totals(df), df.columns, cfg)


def document_of_totals(totals: DataFrame, columns: list[str], cfg: JobConfig) -> DataFrame:
    per_field = F.struct(*[
        F.struct(
            F.col(f"_missing_{c}").alias("missing_count"),
            _percent(F.col(f"_missing_{c}"), F.col("movie_count")).alias("missing_percent"),
        ).alias(c)
        for c in columns
    ])
    return totals.select(
        "movie_count",
        F.lit(cfg.letter).alias("team_letter"),
        F.lit(cfg.target_rows).alias("target_movie_count"),
        F.lit(cfg.pool_size).alias("candidate_pool_size"),
        F.lit(cfg.require_page).alias("require_wikipedia_page"),
        F.lit(cfg.lookup_depth).alias("wikipedia_enrich_limit"),
        "wikipedia_enriched_count",
        "wikipedia_core_complete_count",
        per_field.alias("missing"),
    )


def profile_after(document: DataFrame, old: DataFrame, new: DataFrame, cfg: JobConfig) -> DataFrame:
    """Profile of a dataset some of whose rows have changed, from the profile before.

    ``old`` and ``new`` are the same rows before and after, with the columns that may
    have changed; what both say alike cancels out, so nothing else is read.
    """
    columns = document.schema["missing"].dataType.names
    kinds = {f.name: f.dataType for f in old.schema}
    both = old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1)))

    def moved(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("_sign")).otherwise(0)), F.lit(0))

    change = both.agg(
        moved(is_enriched()).alias("wikipedia_enriched_count"),
        moved(is_core_complete()).alias("wikipedia_core_complete_count"),
        *[moved(is_missing(F.col(c), kinds[c])).alias(f"_missing_{c}") for c in old.columns])
    shift = change.first().asDict()
    totals = document.select(
        "movie_count",
        *[(F.col(c) + shift[c]).alias(c) for c in ("wikipedia_enriched_count", "wikipedia_core_complete_count")],
        *[(F.col(f"missing.{c}.missing_count") + shift.get(f"_missing_{c}", 0)).alias(f"_missing_{c}")
          for c in columns])
    return document_of_totals(totals, columns, cfg)


def profile_of_document(document: DataFrame) -> DataFrame:
    """Long form of a stored profile document."""
    names = document.schema["missing"].dataType.names
    entries = F.array(*[
        F.struct(
            F.lit(n).alias("field"),
            F.col(f"missing.{n}.missing_count").alias("missing_count"),
            F.col(f"missing.{n}.missing_percent").alias("missing_percent"),
        )
        for n in names
    ])
    return document.select(F.inline(entries))


def report_lines(profile: DataFrame) -> DataFrame:
    """(field, line): one printable line per column."""
    line = F.concat(
        F.col("field"), F.lit(": "), F.col("missing_count").cast("string"),
        F.lit(" missing ("), F.col("missing_percent").cast("string"), F.lit("%)"),
    )
    return profile.select("field", line.alias("line"))


def profile_diff(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Fields whose stored and recomputed profile disagree or exist once only."""
    old = stored.select(
        "field", F.col("missing_count").alias("stored_count"),
        F.col("missing_percent").alias("stored_percent"))
    new = current.select(
        "field", F.col("missing_count").alias("current_count"),
        F.col("missing_percent").alias("current_percent"))
    same = (F.col("stored_count").eqNullSafe(F.col("current_count"))
            & F.col("stored_percent").eqNullSafe(F.col("current_percent")))
    return old.join(new, "field", "full").filter(~same)
