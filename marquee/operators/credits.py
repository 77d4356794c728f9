"""Lead actors per title from the credits table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.config import JobConfig
from marquee.functions.text import non_empty
from marquee.operators.joins import keep_keys


def credits_of(credits: DataFrame, selected: DataFrame, at_most: int | None = None) -> DataFrame:
    """Credits of the selected titles only."""
    return keep_keys(credits, selected, "tconst", at_most)


def lead_actor_ranks(credits: DataFrame, cfg: JobConfig) -> DataFrame:
    """First distinct actors per title in credit order: (tconst, nconst, place).

    Repeats fold before the shuffle and the per-title cut also runs before it,
    so a title with very many credits never lands whole in one task.
    """
    first_seen = (
        credits.filter((F.col("category") == cfg.actor_category) & non_empty(F.col("nconst")))
        .groupBy("tconst", "nconst").agg(F.min("ordering").alias("ordering"))
    )
    in_order = Window.partitionBy("tconst").orderBy("ordering", "nconst")
    return (
        first_seen.withColumn("place", F.row_number().over(in_order))
        .filter(F.col("place") <= cfg.max_actors)
        .select("tconst", "nconst", "place")
    )


def lead_actors(credits: DataFrame, cfg: JobConfig) -> DataFrame:
    """One row per title with ``lead_actors_ids``, at most ``max_actors`` long."""
    placed = F.array_sort(F.collect_list(F.struct("place", "nconst")))
    return lead_actor_ranks(credits, cfg).groupBy("tconst").agg(
        F.transform(placed, lambda a: a["nconst"]).alias("lead_actors_ids")
    )


def attach_actors(rows: DataFrame, actors: DataFrame) -> DataFrame:
    """Rows with their actor list; titles without one get an empty list."""
    return rows.join(actors, "tconst", "left").withColumn(
        "lead_actors_ids",
        F.coalesce("lead_actors_ids", F.array().cast("array<string>")),
    )
