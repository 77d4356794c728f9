"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Scratch paths by application, so that the end of a job can remove them.
_scratch: dict[str, list[str]] = {}

# Runtime settings the plans rely on; a cluster's own sizing stays untouched.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    name: str = "marquee", cpus: str = "8", memory: str = "8g", **extra: str
) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**ENGINE_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rsplit("/", 1)[0]
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="marquee-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession) -> str:
    """A new path below the shared folder, gone after ``drop_scratch``."""
    path = f"{shared_dir(spark)}/marquee-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote for itself; for the end of a job."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _scratch.pop(spark.sparkContext.applicationId, []):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back.

    Survives executor loss, cuts the lineage and, unlike a checkpoint, tells
    the optimiser how big the table is.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
