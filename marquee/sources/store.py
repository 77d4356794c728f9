"""Versioned dataset and failure state, published by a row in a commit table.

A version is a whole dataset and state, or the changes of one run on top of the
version before: what a run costs follows its batch, the stored rows stay where
they are. Readers join the changes since the last whole version; after
``COMPACT_AFTER`` of them the next run folds them in. The dataset lies in parts, ranges
of ``pos`` with their bounds listed beside them, so that folding reads and writes
the parts in which changed rows lie, and the list names the rest where they are.
Every publish writes new folders and then appends one commit row, so readers see a
version or the one before it, and nothing is overwritten while it is being
read. One job at a time writes to a store.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.config import JobConfig
from marquee.operators import incremental
from marquee.operators.profiling import profile_after
from marquee.schemas import DATASET, STATE
from marquee.session import materialise
from marquee.sources.datasets import read_or_empty, read_profile, write_profile

_COMMITS = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("base", T.LongType()),
])
# Versions of changes that readers join before a run writes a whole version again.
COMPACT_AFTER = 32


def hits_of(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("outcome") == incremental.ENRICHED)


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def _commits(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/commits", _COMMITS)

    def version(self) -> int:
        """Latest published version, 0 before the first."""
        return self._commits().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def folder(self, version: int) -> str:
        return f"{self.root}/versions/{version:08d}"

    def _span(self) -> tuple[int, list[int]]:
        """The last whole version, and the versions of changes after it."""
        last = self._commits().orderBy(F.desc("version")).first()
        if last is None:
            return 0, []
        return last.base, list(range(last.base + 1, last.version + 1))

    def _changes(self, versions: list[int], name: str) -> DataFrame:
        """Change rows of some versions with their ``version``, from one read of all their folders."""
        rows = self.spark.read.parquet(*[f"{self.folder(v)}/{name}" for v in versions])
        return rows.withColumn("version", F.regexp_extract(
            F.col("_metadata.file_path"), r"/versions/([0-9]+)/", 1).cast("bigint"))

    def _enriched(self, versions: list[int]) -> DataFrame:
        """Last enriched outcome per row."""
        hits = self._changes(versions, "outcomes").filter(F.col("outcome") == incremental.ENRICHED)
        values = F.struct(*[c for c in hits.columns if c not in ("pos", "version", "before")])
        return hits.groupBy("pos").agg(F.max_by(values, "version").alias("o")).select("pos", "o.*")

    def parts(self, base: int) -> DataFrame:
        """(part, version, lo, hi): where each part of a whole version lies, and its first and last ``pos``."""
        return self.spark.read.parquet(f"{self.folder(base)}/parts")

    def _rows(self, base: int, parts: DataFrame | None = None) -> DataFrame:
        """Stored rows of a whole version, or of some of its parts."""
        held = self.parts(base)
        listed = (held if parts is None else parts).select("part", "version").collect()
        paths = [f"{self.folder(r.version)}/dataset/part={r.part}" for r in sorted(listed)]
        pos = T.StructField("pos", held.schema["lo"].dataType)
        schema = T.StructType([pos, *DATASET.fields])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def parts_of(self, base: int, rows: DataFrame) -> DataFrame:
        """The parts in which rows lie, by the bounds alone; there are as few of them as files."""
        held = F.broadcast(self.parts(base)).alias("p")
        inside = rows.select("pos").join(held, F.col("pos").between(F.col("p.lo"), F.col("p.hi")))
        return inside.select("p.*").distinct()

    def dataset(self) -> DataFrame:
        """Published rows: ``pos`` and the thirteen dataset columns."""
        base, later = self._span()
        rows = self._rows(base)
        return incremental.merge_enriched(rows, self._enriched(later)) if later else rows

    def pending(self) -> DataFrame:
        """Published rows that still lack page fields; the test reaches the scan of the stored rows."""
        base, later = self._span()
        rows = incremental.pending(self._rows(base))
        if not later:
            return rows
        return rows.join(self._enriched(later).select("pos"), "pos", "left_anti")

    def state(self) -> DataFrame:
        base, later = self._span()
        rows = read_or_empty(self.spark, f"{self.folder(base)}/state", STATE)
        if not later:
            return rows
        changes = self._changes(later, "state_changes")
        values = F.struct(*[c for c in changes.columns if c not in ("key", "version")])
        last = changes.groupBy("key").agg(F.max_by(values, "version").alias("o")).select("key", "o.*")
        return incremental.state_with(rows, last)

    def profile(self) -> DataFrame:
        return read_profile(self.spark, f"{self.folder(self.version())}/profile")

    def append(self, outcomes: DataFrame, cfg: JobConfig, source: str, batch: int = 0) -> int:
        """Publish the changes of one run: its outcomes and what they do to the state."""
        base, later = self._span()
        if len(later) >= COMPACT_AFTER:
            return self._fold(base, later, outcomes, cfg, source, batch)
        version = self.version() + 1
        folder = self.folder(version)
        outcomes.write.mode("overwrite").parquet(f"{folder}/outcomes")
        written = self.spark.read.parquet(f"{folder}/outcomes")
        incremental.state_changes(written, cfg).write.mode("overwrite").parquet(
            f"{folder}/state_changes")
        self._profile_after(hits_of(written), cfg, folder)
        self._commit(version, source, batch, base)
        return version

    def _fold(
        self, base: int, later: list[int], outcomes: DataFrame, cfg: JobConfig, source: str, batch: int,
    ) -> int:
        """The next whole version: parts without a changed row stay, the others are written anew."""
        version = self.version() + 1
        folder = self.folder(version)
        hits = hits_of(outcomes).drop("before")
        changed = materialise(self._enriched(later).unionByName(hits.select(self._enriched(later).columns)))
        touched = materialise(self.parts_of(base, changed))
        rows = incremental.merge_enriched(self._rows(base, touched), changed)
        own = self._write_parts(rows, folder)
        # A part goes by its number and the version that wrote it.
        kept = self.parts(base).join(F.broadcast(touched), ["part", "version"], "left_anti")
        kept.unionByName(own.withColumn("version", F.lit(version).cast("bigint"))).write.mode(
            "overwrite").parquet(f"{folder}/parts")
        state = incremental.state_after(self.state(), outcomes, cfg)
        state.select(*STATE.names).write.mode("overwrite").parquet(f"{folder}/state")
        self._profile_after(hits_of(outcomes), cfg, folder)
        self._commit(version, source, batch, version)
        return version

    def _write_parts(self, rows: DataFrame, folder: str) -> DataFrame:
        """Rows as ranges of ``pos``, a folder each; (part, lo, hi) of those written."""
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in DATASET]
        ranged = rows.select("pos", *typed).repartitionByRange("pos").sortWithinPartitions("pos")
        ranged.withColumn("part", F.spark_partition_id()).write.mode("overwrite").partitionBy(
            "part").parquet(f"{folder}/dataset")
        pos = T.StructField("pos", rows.schema["pos"].dataType)
        schema = T.StructType([pos, T.StructField("part", T.IntegerType())])
        written = read_or_empty(self.spark, f"{folder}/dataset", schema)
        return written.groupBy("part").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))

    def _profile_after(self, hits: DataFrame, cfg: JobConfig, folder: str) -> None:
        """Only the changed rows are looked at, as they were and as they are now."""
        cells = incremental.cells_after("before.")
        document = profile_after(
            self.profile(), hits.select("before.*"),
            hits.select(*[new.alias(c) for c, new in cells.items()]), cfg)
        document.write.mode("overwrite").json(f"{folder}/profile")

    def _commit(self, version: int, source: str, batch: int, base: int) -> None:
        row = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"), F.lit(source).alias("source"),
            F.lit(batch).cast("bigint").alias("batch"), F.lit(base).cast("bigint").alias("base"),
        )
        row.write.mode("append").parquet(f"{self.root}/commits")

    def publish(
        self, dataset: DataFrame, state: DataFrame, cfg: JobConfig,
        source: str = "import", batch: int = 0,
    ) -> int:
        """Write the next version as a whole, its profile, then the commit row.

        A failed attempt leaves folders without a commit row; the next publish
        writes over them.
        """
        version = self.version() + 1
        folder = self.folder(version)
        own = self._write_parts(dataset, folder)
        own.withColumn("version", F.lit(version).cast("bigint")).write.mode("overwrite").parquet(
            f"{folder}/parts")
        state.select(*STATE.names).write.mode("overwrite").parquet(f"{folder}/state")
        write_profile(self._rows(version), cfg, f"{folder}/profile")
        self._commit(version, source, batch, version)
        return version
