"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import materialise, scratch_path

# The six characters that part words.
SPACE = r"[\x20\x09-\x0D]+"

# Applications whose workers have this package.
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Make ready for Python tasks: rows per Arrow batch, so that whole texts stay
    small together, and this package on every worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).resolve().parent.parent
        held = Path(tempfile.mkdtemp(prefix="marquee-ship-")) / "marquee_package.zip"
        with zipfile.ZipFile(held, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(held))


def bucketed(df: DataFrame, key: str, buckets: int, folder: str) -> DataFrame:
    """Write once to the shared folder, a folder per value of ``folder``, one bucket of
    ``key`` per file, and read back.

    Grouping or joining by ``key`` then needs no shuffle, however often. ``df`` comes
    dealt by ``key`` into as many partitions.
    """
    spark = df.sparkSession
    name = f"marquee_{uuid.uuid4().hex}"
    (df.write.partitionBy(folder).bucketBy(buckets, key)
     .option("path", scratch_path(spark)).saveAsTable(name))
    return spark.table(name)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of every text of an Arrow column; null counts as empty."""
    raw = column.cast(pa.large_string()).cast(pa.large_binary())
    for value in raw:
        yield value.as_py() or b""


class WordHashes(dict):
    """Hash of a word's bytes, remembered while the table stays small."""

    def __init__(self, seed: int = 0, limit: int = 400_000):
        super().__init__()
        self.seed, self.limit = seed, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = xxhash.xxh64_intdigest(word, seed=self.seed)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Finish 64-bit values so that every bit depends on all others."""
    out = values ^ (values >> np.uint64(31))
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


__all__ = ["SPACE", "WordHashes", "bucketed", "id_remainder", "materialise", "mixed",
           "small_batches", "table", "texts_of"]
