"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    decontam, divergence, linededup, lm, packing, phrases, quality, repair, sentences, simhash,
    suffixdedup, toxicity, urlfilter,
)
from marquee.llm.common import id_remainder, table
from marquee.llm.oracles import ORACLES


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.drop("rejected_by")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_remainder("doc_id", 5) == 0)
    weights = toxicity.train(docs.where("not held_out"), table(spark, sf_dir, "labels"))
    return (toxicity.scored(docs.select("doc_id", "text", "held_out"), weights)
            .select("doc_id", "held_out", F.col("toxicity").alias("score"),
                    (F.col("toxicity") >= 0.5).cast("int").alias("predicted")))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixdedup.deduplicated(table(spark, sf_dir, "documents"), digest_only=True)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans",
                       F.lower(F.hex("kept")).alias("kept_sha256"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = linededup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lines.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                        F.col("removed_lines").cast("long").alias("n_removed"),
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontam.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


def op7_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = phrases.deduplicated(table(spark, sf_dir, "documents"), digest_only=True)
    return rows.select("doc_id", "n_words", "n_removed", F.lower(F.hex("kept")).alias("kept_sha256"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judged(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_pitman_yor_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = repair.audited(repair.damaged(rows)).withColumnRenamed("conv_id", "found_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (rows.select("conv_id").distinct()
            .join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
            .select("conv_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.digests(table(spark, sf_dir, "documents"))


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_decontamination": op6_decontamination,
    "op7_phrase_automata": op7_phrase_automata,
    "op8_url_filter": op8_url_filter,
    "op9_simhash": op9_simhash,
    "op10_pitman_yor_lm": op10_pitman_yor_lm,
    "op11_source_divergence": op11_source_divergence,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_sentence_pieces": op13_sentence_pieces,
}
