"""Toxicity scores by FTRL-proximal logistic regression on hashed n-grams.

Features are a text's distinct words, their first four and five letters, word
pairs and skip pairs (one word between), lower-cased, hashed into 2**``bits``
slots. Training is on a bounded
sample of labelled rows (``sample`` rows, those of the least id hashes), in one
task, with per-coordinate rates; L1 leaves few weights, which are broadcast
(2**bits floats at most) to score every text.

Defined results: null and empty texts have no features and score the bias
alone; labels of the same doc_id count as their maximum; rows labelled null are
not learnt from; of rows that share an id the one of the least text digest is
learnt from; without any labelled row, or where no weight is left, nothing speaks
against a text and every score is 0; repeated rows are scored each; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import WordHashes, mixed, small_batches, texts_of

SAMPLE = 8_000
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_SKIP = np.uint64(0xC2B2AE3D27D4EB4F)
_STEM = np.uint64(0xD6E8FEB86659FD93)
_words = WordHashes(seed=7)


@dataclass(frozen=True)
class Ftrl:
    bits: int = 20
    alpha: float = 0.6
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 1.0
    epochs: int = 3


def features(text: bytes, bits: int) -> np.ndarray:
    """Distinct feature slots of a text; slot 0 is the bias."""
    words = [w for w in (w.strip(b".,;:!?\"'()") for w in text.lower().split()) if w]
    h = _words.of(words)
    grams = [h, *(_words.of([w[:n] for w in words if len(w) > n]) ^ _STEM for n in (4, 5))]
    if len(h) > 1:
        grams.append(h[:-1] * _PAIR + h[1:])
    if len(h) > 2:
        grams.append((h[:-2] * _SKIP + h[2:]) ^ _SKIP)
    slots = mixed(np.concatenate(grams)) >> np.uint64(64 - bits)
    return np.unique(np.append(slots, np.uint64(0))).astype(np.int32)


def fit(texts: list[bytes], labels: np.ndarray, setting: Ftrl) -> np.ndarray:
    """Weights after ``epochs`` passes in the given order."""
    size = 1 << setting.bits
    z, n = np.zeros(size), np.zeros(size)
    rows = [features(t, setting.bits) for t in texts]

    def weights(idx):
        zi, ni = z[idx], n[idx]
        shrunk = np.sign(zi) * setting.l1 - zi
        w = shrunk / ((setting.beta + np.sqrt(ni)) / setting.alpha + setting.l2)
        return np.where(np.abs(zi) <= setting.l1, 0.0, w)

    for _ in range(setting.epochs):
        for idx, y in zip(rows, labels):
            w = weights(idx)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - y
            root = np.sqrt(n[idx])
            n[idx] += g * g
            z[idx] += g - (np.sqrt(n[idx]) - root) / setting.alpha * w
    return weights(np.arange(size)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, setting: Ftrl = Ftrl(),
          sample: int = SAMPLE) -> np.ndarray:
    """Weights learnt from the ``sample`` labelled rows of ``docs`` with the least id hashes."""
    marks = (labels.where("doc_id is not null and toxic is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("label")))
    # The ids are cut to the bound first, then only their texts are fetched.
    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    picked = (named.select("doc_id").distinct().join(marks, "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = (named.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label")
            .agg(F.min_by("text", F.struct(digest, F.col("text").isNull())).alias("text"))
            .withColumn("all", F.lit(0)))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(text=frame["text"].fillna("")).sort_values(["doc_id", "text"])
        order = np.random.default_rng(11).permutation(len(frame))
        frame = frame.iloc[order]
        weights = fit([t.encode() for t in frame["text"]], frame["label"].to_numpy(np.float64),
                      setting)
        slots = np.flatnonzero(weights)
        return pd.DataFrame({"slot": slots, "weight": weights[slots]})

    out = np.zeros(1 << setting.bits, np.float32)
    for row in rows.groupBy("all").applyInPandas(run, "slot long, weight double").collect():
        out[row.slot] = row.weight
    return out


def scored(docs: DataFrame, weights: np.ndarray, setting: Ftrl = Ftrl()) -> DataFrame:
    """The columns of ``docs`` with ``toxicity`` (0 to 1) put behind."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    learnt = bool(weights.any())

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shared.value
        for some in texts:
            if not learnt:
                yield pd.Series(np.zeros(len(some)))
                continue
            sums = np.array([w[features(t, setting.bits)].sum(dtype=np.float64)
                             for t in texts_of(pa.array(some, pa.string()))])
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(sums, -30, 30))), dtype="float64")

    return docs.withColumn("toxicity", score(F.col("text").cast("string")))
