"""Drain arriving response files into a stored dataset.

Landing and draining are two steps. Landing is the stream: every micro-batch
parses the responses that have arrived, once, and adds the answers to the store's
memo, by lookup key and the limit they were asked with. It reads neither dataset nor
state, so its cost follows the files that arrived; the stream's checkpoint governs
landing and nothing else, and a replayed batch overwrites its own folder.

Draining meets the pending rows with the memo in one pass and publishes the changes.
Every drain reads the whole memo, whoever landed it: a drain that retries, one
with a raised limit, or one over a newly imported dataset meets answers that
arrived before, as if the stored files were read again. What counts of several
answers to one request depends on their content alone, not on how they arrived.
"""

from __future__ import annotations

import hashlib
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.config import JobConfig
from marquee.operators import incremental
from marquee.operators.pages import join_parsed, one_per_key, parsed_responses, with_lookup_key
from marquee.schemas import PAGE_FIELDS
from marquee.session import materialise
from marquee.sources.datasets import read_or_empty
from marquee.sources.responses import BODY_SCHEMA, FILE_SCHEMA, every_combined_response, named_bodies
from marquee.sources.store import Store

# An answer of the memo; the limit is a folder, so that a drain reads its own limit only.
ANSWER = T.StructType([
    T.StructField("lookup_key", T.StringType()), T.StructField("page", T.StringType()),
    T.StructField("fields", PAGE_FIELDS), T.StructField("reason", T.StringType()),
    T.StructField("landing", T.StringType()), T.StructField("batch", T.LongType()),
    T.StructField("search_limit", T.StringType()),
])


class Drain:
    """One named drain over a store; a restart under the same name continues its stream."""

    def __init__(self, store: Store, name: str, cfg: JobConfig) -> None:
        self.store, self.name, self.cfg = store, name, cfg
        self.memo = f"{store.root}/answers"

    def answers(self) -> DataFrame:
        """(lookup_key, page, fields, reason): the answer that counts of every landed request."""
        rows = read_or_empty(self.store.spark, self.memo, ANSWER)
        asked = rows.filter(F.col("search_limit") == str(self.cfg.search_limit))
        return one_per_key(asked.drop("search_limit", "landing", "batch"))

    def land(self, bodies: DataFrame, batch: int, landing: str) -> None:
        """Parse the responses of a micro-batch and keep their answers."""
        parsed = parsed_responses(every_combined_response(bodies))
        parsed.write.mode("overwrite").partitionBy("search_limit").parquet(
            f"{self.memo}/landing={landing}/batch={batch}")

    def drain(self) -> int:
        """Attempt the pending rows whose answer has landed; the version after it."""
        rows = with_lookup_key(incremental.with_key(self.store.pending()))
        asked = rows.select("pos", "key", "primaryTitle", "startYear", "lookup_key",
                            *incremental.TEXT_CELLS, *incremental.cells_before(rows))
        looked = join_parsed(asked, self.answers(), "pos").filter("has_response")
        decided = incremental.decide(looked, self.store.state(), self.cfg)
        todo = incremental.next_batch(decided, replace(self.cfg, batch_rows=None))
        outcomes = materialise(incremental.outcomes_of(todo, "before"))
        if outcomes.isEmpty():
            return self.store.version()
        return self.store.append(outcomes, self.cfg, source=f"drain:{self.name}")

    def run_stream(self, bodies: DataFrame, landing: str | None = None) -> int:
        """Land a (name, body) stream as far as it goes now, drain, return the version."""
        landing = landing or f"name-{self.name}"
        query = (
            bodies.writeStream.foreachBatch(lambda some, batch: self.land(some, batch, landing))
            .option("checkpointLocation", f"{self.store.root}/landings/{landing}")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return self.drain()

    def run(self, path: str) -> int:
        """Drain a folder of response files, ``checkpoint_rows`` files per batch."""
        files = (
            self.store.spark.readStream.format("text").schema(FILE_SCHEMA)
            .option("wholetext", True).option("maxFilesPerTrigger", self.cfg.checkpoint_rows)
            .load(path)
        )
        return self.run_stream(named_bodies(files), _landing_of(path))

    def run_landed(self, path: str) -> int:
        """Drain a Parquet table of (name, body) rows that others append to."""
        bodies = (
            self.store.spark.readStream.format("parquet").schema(BODY_SCHEMA)
            .option("maxFilesPerTrigger", self.cfg.checkpoint_rows).load(path)
        )
        return self.run_stream(bodies, _landing_of(path))


def _landing_of(path: str) -> str:
    """One landing per source folder: drains of any name share what it has parsed."""
    return "path-" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]
