"""Join helpers that state their size and skew assumptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialise

# Key sets up to this many rows are broadcast (keys are short: about 20 MB at most).
BROADCAST_KEYS = 100_000
# A key with more rows is spread over as many tasks as keep each at about this many.
HOT_ROWS = 1_000_000
# Rows without a key meet nothing; they are spread over this many slices.
NULL_SLICES = 64
# Hot keys are recognised on one row in this many, chosen by a hash of the row id.
LOOK_AT_ONE_IN = 64


def keep_keys(big: DataFrame, keys: DataFrame, key: str, at_most: int | None = None) -> DataFrame:
    """Rows of ``big`` whose key is in ``keys``.

    ``at_most`` is a proven upper bound on ``keys``; with a small one ``big`` is
    filtered in place, otherwise the optimiser picks a shuffle join.
    """
    wanted = keys.select(key)
    if at_most is not None and at_most <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    return big.join(wanted, key, "left_semi")


def _hot_keys(rows: DataFrame, key: str, row_id: str, hot_rows: int) -> DataFrame:
    """(key, slices) of the frequent keys, from an estimate of their rows.

    The estimate only decides which task a row goes to, never whether it is in
    the result. Choosing rows by hash keeps it identical on every evaluation.
    There are at most rows / hot_rows such keys, so the optimiser, which knows
    no bound, may broadcast them by their measured size or shuffle them.
    """
    seen = rows.filter(F.pmod(F.xxhash64(row_id), F.lit(LOOK_AT_ONE_IN)) == 0)
    many = F.col("_n") * LOOK_AT_ONE_IN
    return (
        seen.groupBy(key).agg(F.count("*").alias("_n")).filter(many >= hot_rows)
        .select(key, F.ceil(many / hot_rows).cast("int").alias("_slices"))
    )


def lookup_join(
    rows: DataFrame, dim: DataFrame, key: str, row_id: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``rows`` left join ``dim`` (unique on ``key``) with hot keys spread out.

    Rows of a hot key get a slice number from their id, and its ``dim`` row is
    copied once per slice, as many as the key's estimated rows ask for. Rows
    without a key are spread too, every other key joins as usual. The result is
    the plain left join whatever the frequencies.
    """
    hot = materialise(_hot_keys(rows, key, row_id, hot_rows))
    slices = F.coalesce("_slices", F.when(F.col(key).isNull(), NULL_SLICES).otherwise(1))
    # Salted again: the slice must not follow the rows picked for the estimate.
    salt = F.pmod(F.xxhash64(row_id, F.lit("slice")), slices).cast("int")
    left = rows.join(hot, key, "left").withColumn("_slice", salt).drop("_slices")
    copies = F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)
    right = dim.join(hot, key, "left").withColumn("_slice", F.explode(copies)).drop("_slices")
    return left.join(right, [key, "_slice"], "left").drop("_slice")
