"""SimHash near-duplicates linked through a generalised pigeonhole search.

A text's fingerprint is the bitwise majority of its shingles' hashes. Two
fingerprints link when at most ``distance`` bits differ. The 64 bits are dealt
into partitions of correlated bits, and each partition gets its own threshold
t so that the thresholds sum to distance - partitions + 1: then linked
fingerprints agree within t bits in one partition at least. Layout and
thresholds come from a dynamic programme over candidate counts estimated on a
bounded sample; any choice finds every link, the sample only decides the cost.

Equal fingerprints are one class before the search. A bucket with more than
``bucket_limit`` classes emits no pairs: its fingerprints meet at every value
one bit away (two fingerprints within two bits share such a value), and each
such meeting is a star to its least member.

Defined results: null or word-free text has fingerprint 0 and links like any
other; fewer words than the shingle length form one shingle; a null doc_id
gets a fingerprint and the least id of its component; repeated rows stay
repeated; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import materialise, small_batches, texts_of
from marquee.llm.components import components

BITS = 64
CHUNK = 65_536
_RESULT = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bitwise majority of the XXH64 (seed 42) values of a text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=42)
    total = len(words) - shingle + 1
    value = map(partial(xxhash.xxh64_intdigest, seed=42),
                map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    ones = np.zeros(BITS, np.int64)
    left = total
    while left:
        some = np.fromiter(value, "<u8", min(left, CHUNK))
        left -= len(some)
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one signed 64-bit fingerprint per row of ``docs``."""
    small_batches(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            values = np.fromiter((fingerprint(t, shingle) for t in texts_of(part.column(1))),
                                 np.uint64, part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(values.view(np.int64))], schema=_RESULT)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, fp long")


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _mask(members: list[int]) -> int:
    return sum(1 << b for b in members)


def correlated_partitions(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits into ``parts`` equal partitions, each bit to its most correlated one."""
    bits = _bits(sample).astype(np.float64)
    spread = bits.std(axis=0)
    scaled = (bits - bits.mean(axis=0)) / np.where(spread > 0, spread, 1)
    alike = np.abs(scaled.T @ scaled) / max(1, len(sample))
    order = np.argsort(-alike.sum(axis=0), kind="stable")
    room = [BITS // parts + (i < BITS % parts) for i in range(parts)]
    groups: list[list[int]] = [[] for _ in range(parts)]
    for place, bit in enumerate(order):
        if place < parts:
            best = place
        else:
            best = max((g for g in range(parts) if len(groups[g]) < room[g]),
                       key=lambda g: (alike[bit, groups[g]].mean(), -g))
        groups[best].append(int(bit))
    return [sorted(g) for g in groups]


def _estimates(sample: np.ndarray, mask: int, most: int, total: int) -> list[float]:
    """Candidate pairs expected among ``total`` values within 0..most bits of a partition."""
    near = np.zeros(most + 1)
    own = sample & np.uint64(mask)
    for at in range(1, len(own)):
        apart = np.bitwise_count(own[at:] ^ own[:-at])
        near += [np.count_nonzero(apart <= t) for t in range(most + 1)]
    pairs = max(1, len(own) * (len(own) - 1) / 2)
    width = bin(mask).count("1")
    chance = [sum(_choose(width, i) for i in range(t + 1)) / 2.0 ** width for t in range(most + 1)]
    # A sample without a hit says little about rare ones; independent bits are the floor.
    return [max(n / pairs, c) * total * total / 2 for n, c in zip(near, chance)]


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds (-1 skips a partition) of least cost that sum to ``budget``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (sofar, picks) in best.items():
            for t in range(-1, len(cost)):
                price = sofar + (cost[t] if t >= 0 else 0.0)
                if spent + t not in step or price < step[spent + t][0]:
                    step[spent + t] = (price, [*picks, t])
        best = step
    return best[budget]


def plan_partitions(sample: np.ndarray, total: int, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of every partition to probe, the cheapest layout found."""
    found = None
    for parts in range(1, distance + 3):
        groups = correlated_partitions(sample, parts)
        costs = []
        for group in groups:
            # Each probe is a row as well; deeper than one bit is left to wider layouts.
            near = _estimates(sample, _mask(group), min(1, distance), total)
            costs.append([e + total * sum(_choose(len(group), i) for i in range(t + 1))
                          for t, e in enumerate(near)])
        budget = distance - parts + 1
        try:
            price, picks = allocate(costs, budget)
        except KeyError:
            continue
        if found is None or price < found[0]:
            found = (price, [(g, t) for g, t in zip(groups, picks) if t >= 0])
    return found[1]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _flips(bits: list[int]) -> Column:
    return F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << b)).cast("long") for b in bits))


def _around(part: int, value: Column):
    """Key of a partition's value with one bit flipped."""
    return lambda flip: F.struct(F.lit(part).alias("part"), value.bitwiseXOR(flip).alias("value"))


def links(classes: DataFrame, distance: int, sample_size: int = 2048,
          bucket_limit: int = 64) -> DataFrame:
    """(u, v) linking distinct fingerprints ``fp``; their components are those of all links.

    ``sample_size`` bounds the fingerprints read to choose the layout.
    """
    if distance != 2:
        raise ValueError("large buckets meet one bit away, which finds links of two bits")
    total = classes.count()
    drawn = classes.orderBy(F.xxhash64("fp"), "fp").limit(sample_size).collect()
    sample = np.array([r.fp for r in drawn], np.int64).view(np.uint64)
    if total < 2:
        return classes.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    plan = plan_partitions(sample, total, distance)
    index, probe = [], []
    for part, (bits, t) in enumerate(plan):
        own = F.col("fp").bitwiseAND(F.lit(_signed(_mask(bits))).cast("long"))
        index.append(F.struct(F.lit(part).alias("part"), own.alias("value")))
        probe.append(F.transform(_flips(bits if t else []), _around(part, own)))
    stored = classes.select("fp", F.explode(F.array(*index)).alias("key")).select("fp", "key.*")
    probes = classes.select("fp", F.explode(F.concat(*probe)).alias("key")).select("fp", "key.*")
    sizes = stored.groupBy("part", "value").agg(F.count("*").alias("n"))
    probed = probes.groupBy("part", "value").agg(F.count("*").alias("m"))
    met = materialise(sizes.join(probed, ["part", "value"]).where("m > 1"))
    small = met.where(F.col("m") <= bucket_limit).select("part", "value")
    large = met.where(F.col("m") > bucket_limit).select("part", "value")
    near = (stored.join(small, ["part", "value"])
            .join(probes.withColumnRenamed("fp", "other"), ["part", "value"])
            .where("fp != other")
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance)
            .select(F.col("fp").alias("u"), F.col("other").alias("v")))
    crowd = probes.join(large, ["part", "value"]).select("fp").distinct()
    around = crowd.select("fp", F.explode(_flips(list(range(BITS)))).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("meet"))
    hubs = around.groupBy("meet").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1")
    stars = around.join(hubs, "meet").where("fp != v").select(F.col("fp").alias("u"), "v")
    return near.union(stars).distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per document: doc_id, fp (signed 64-bit), component_id.

    component_id is the smallest doc_id reachable over links; null only where a
    whole component has no id.
    """
    rows = materialise(fingerprints(docs, shingle))
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes.select("fp"), distance)).select(
        F.col("node").alias("fp"), "root")
    placed = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    members = placed.join(ids, "root").select("fp", "component_id")
    return rows.join(members, "fp").select("doc_id", "fp", "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: of each group the smallest doc_id stays.

    Of rows that share the kept id in one group the least by a digest of the row
    stays; rows of one id in different groups are kept apart. Rows without an id are
    matched like any other and come after all that have one.
    """
    number = F.col("doc_id").cast("long")
    keyed = materialise(docs.withColumn("__none", number.isNull())
                        .withColumn("__id", F.coalesce(number, F.lit(0)))
                        .withColumn("__text", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
                        .withColumn("__row", F.xxhash64(*docs.columns)))
    prints = materialise(fingerprints(
        keyed.dropDuplicates(["__text"]).select(F.col("__text").alias("doc_id"), "text"), shingle)
        .withColumnRenamed("doc_id", "__text"))
    roots = components(links(prints.select("fp").distinct(), distance)).select(
        F.col("node").alias("fp"), "root")
    row = ["__none", "__id", "__text", "__row"]
    best = keyed.groupBy("__text").agg(F.min(F.struct(*row)).alias("least"))
    kept = (best.join(prints, "__text").join(roots, "fp", "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("least"))
            .select("least.*"))
    return keyed.join(kept, row, "left_semi").dropDuplicates(row).select(docs.columns)
