"""From raw title and rating tables to the ranked popularity pool."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.config import JobConfig
from marquee.functions.text import clean_float, clean_int, fold_case, list_field, strip
from marquee.operators.ranking import ranked_top_k, top_k

# Fixed value: no non-ASCII character upper-cases into these initials, so a
# plain prefix test on both cases is exact and reaches the file scan.
PLAIN_INITIALS = "BCDEGKLMNOPQRUVXZ"
# Fixed value: the other characters whose upper case begins with these initials.
FOREIGN_INITIALS = {
    "A": "ẚ", "F": "ﬀﬁﬂﬃﬄ", "H": "ẖ", "I": "ı", "J": "ǰ", "S": "ſßﬅﬆ", "T": "ẗ", "W": "ẘ", "Y": "ẙ",
}

TITLE_COLUMNS = ["tconst", "titleType", "primaryTitle", "startYear", "runtimeMinutes", "genres"]


def project_titles(raw: DataFrame) -> DataFrame:
    """Typed titles from all-string rows; ``ordering`` is kept when present."""
    kept = [c for c in ("ordering",) if c in raw.columns]
    return raw.select(
        "tconst",
        "titleType",
        strip(F.coalesce("primaryTitle", F.lit(""))).alias("primaryTitle"),
        clean_int(F.col("startYear")).try_cast("int").alias("startYear"),
        clean_int(F.col("runtimeMinutes")).try_cast("int").alias("runtimeMinutes"),
        list_field(F.col("genres")).alias("genres"),
        *kept,
    )


def project_ratings(raw: DataFrame) -> DataFrame:
    """Typed ratings from all-string rows; ``ordering`` is kept when present."""
    kept = [c for c in ("ordering",) if c in raw.columns]
    return raw.select(
        "tconst",
        clean_float(F.col("averageRating")).alias("averageRating"),
        clean_int(F.col("numVotes")).alias("numVotes"),
        *kept,
    )


def last_per_key(df: DataFrame, key: str, ordering: str) -> DataFrame:
    """Last row per key; one partial aggregate, so copies of a hot key fold early."""
    values = [c for c in df.columns if c not in (key, ordering)]
    return df.groupBy(key).agg(*[F.max_by(c, ordering).alias(c) for c in values])


def has_initial(title: Column, letter: str) -> Column:
    """Case-insensitive first letter of a trimmed title.

    A letter is spelled out as the few prefixes that upper-case to it, which
    reach the file scan; anything else is compared in upper case.
    """
    if letter not in PLAIN_INITIALS and letter not in FOREIGN_INITIALS or len(letter) != 1:
        return F.upper(title).startswith(letter)
    prefixes = [letter, letter.lower(), *FOREIGN_INITIALS.get(letter, "")]
    return reduce(or_, (title.startswith(p) for p in prefixes))


def eligible_titles(titles: DataFrame, cfg: JobConfig) -> DataFrame:
    """Titles of the wanted type, initial, year and length.

    Where the rows know their ``ordering``, the last eligible row of a title counts.
    """
    wanted = titles.filter(
        (F.col("titleType") == cfg.title_type)
        & has_initial(F.col("primaryTitle"), cfg.letter)
        & (F.col("startYear") <= cfg.max_year)
        & F.col("runtimeMinutes").between(cfg.min_runtime, cfg.max_runtime)
    )
    if "ordering" not in titles.columns:
        return wanted
    return last_per_key(wanted, "tconst", "ordering").select(
        [c for c in titles.columns if c != "ordering"])


def rated_candidates(eligible: DataFrame, ratings: DataFrame) -> DataFrame:
    """Eligible titles that have both a rating (NaN counts) and a vote count."""
    usable = ratings.filter(F.col("averageRating").isNotNull() & F.col("numVotes").isNotNull())
    return eligible.drop("titleType").join(
        usable.select("tconst", "averageRating", "numVotes"), "tconst", "inner"
    )


def popularity_order() -> list[Column]:
    return [F.desc("numVotes"), F.asc(fold_case(F.col("primaryTitle"))), F.asc("tconst")]


def candidate_pool(rated: DataFrame, cfg: JobConfig) -> DataFrame:
    """The ``pool_size`` most popular candidates, unranked."""
    return top_k(rated, popularity_order(), cfg.pool_size, F.col("numVotes"))


def ranked_pool(rated: DataFrame, cfg: JobConfig) -> DataFrame:
    """Pool rows with rank 1..n and whether their rank earns a page lookup."""
    ranked = ranked_top_k(rated, popularity_order(), cfg.pool_size, F.col("numVotes"))
    return ranked.withColumn("looked_up", F.col("rank") <= cfg.lookup_depth)
