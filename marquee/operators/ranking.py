"""Exact top-k and ranks in a total order, whatever k is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialise

# Up to this k an ordered limit sends its last task k rows per task at most, which stays small.
DIRECT_ROWS = 2_000
# Rank error of the threshold estimate: one row in this many, guaranteed by the sketch.
ACCURACY = 10_000
# Shares of the rows a threshold may keep: each half the one before, down to the error.
SHARES = [2.0 ** -j for j in range(14)]


def top_k(df: DataFrame, order: list[Column], k: int, lead: Column | None) -> DataFrame:
    """First ``k`` rows in a total order.

    ``lead`` is a number that falls along ``order``: the first sort column, or
    its negative where that rises; ``None`` where there is no number. Larger
    cuts first drop what lies below a threshold of it, see ``_ranked``.
    """
    if k > DIRECT_ROWS:
        return _ranked(df, order, k, lead, "_rank").drop("_rank")
    return df.orderBy(*order).limit(k)


def ranked_top_k(
    df: DataFrame, order: list[Column], k: int, lead: Column | None, name: str = "rank"
) -> DataFrame:
    """``top_k`` with ranks 1..k; a single-task window only ever sees a small cut set."""
    if k > DIRECT_ROWS:
        return _ranked(df, order, k, lead, name)
    return top_k(df, order, k, lead).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def _threshold(df: DataFrame, k: int, lead: Column) -> float | None:
    """A value of ``lead`` that at least ``k`` rows reach; ``None`` keeps all rows.

    One partial aggregate: a quantile sketch whose rank error is bounded, asked
    for a share that is larger than the wanted one by twice that error, and by
    a factor of two at most.
    """
    rows = df.select(lead.cast("double").alias("lead")).agg(
        F.count("lead").alias("n"),
        F.percentile_approx("lead", [1 - s for s in SHARES], ACCURACY).alias("q")).first()
    if rows.n <= k:
        return None
    enough = [q for s, q in zip(SHARES, rows.q) if s >= k / rows.n + 2 / ACCURACY]
    return enough[-1] if enough else None


def _ranked(
    df: DataFrame, order: list[Column], k: int, lead: Column | None, name: str
) -> DataFrame:
    """Rank inside ranges of the order, shifted by the rows in earlier ranges.

    Only rows at or above the threshold are shuffled; the filter reaches the
    scan. The order is total, so a run of equal leading values splits into
    ranges as well, however many rows tie at the threshold. The range number is
    written with the rows, which keeps it fixed if a task reruns.
    """
    least = None if lead is None else _threshold(df, k, lead)
    some = df if least is None else df.filter(lead.cast("double") >= F.lit(least))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        some.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    starts = sizes.select("_range", earlier.alias("_before")).filter(F.col("_before") < k)
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        placed.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_before") + place)
        .filter(F.col(name) <= k)
        .drop("_range", "_before")
    )
