"""The training-data pipeline: every stage works on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontam, linededup, packing, simhash, toxicity
from marquee.llm.common import table
from marquee.session import ENGINE_CONF, materialise


def _ready(spark: SparkSession) -> None:
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay."""
    _ready(spark)
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, weights).where("toxicity < 0.5").select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of line runs and of single long lines are cut out of the texts; every document stays."""
    _ready(spark)
    out = linededup.deduplicated(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: three-word shingles, two bits."""
    _ready(spark)
    return simhash.keep_one_per_group(docs, shingle=3, distance=2)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window stay."""
    _ready(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the documents left."""
    _ready(spark)
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("best_fit_packing", packing_stage),
]

# A learnt score and a token packing are beyond SQL; the tests hold run() to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
