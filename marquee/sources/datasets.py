"""The delivered dataset as CSV, its profile as JSON, the failure state."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.config import JobConfig
from marquee.functions.numbers import float_text
from marquee.functions.text import list_text
from marquee.operators.profiling import profile_document
from marquee.schemas import DATASET, DATASET_COLUMNS, PROFILE, STATE
from marquee.session import materialise

_CSV = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows when the path does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# ---- dataset -----------------------------------------------------------------
def dataset_text(dataset: DataFrame) -> DataFrame:
    """The thirteen columns as CSV text; missing cells are empty."""
    cells = []
    for field in DATASET:
        cell = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            cell = list_text(cell)
        elif isinstance(field.dataType, T.DoubleType):
            cell = float_text(cell)
        cells.append(F.coalesce(cell.cast("string"), F.lit("")).alias(field.name))
    return dataset.select(*cells)


def write_dataset_csv(dataset: DataFrame, path: str, order: str | None = None) -> None:
    """Export in ``order``; part files continue each other."""
    ordered = dataset.orderBy(order) if order else dataset
    (
        dataset_text(ordered).write.mode("overwrite").options(**_CSV)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_dataset_csv(spark: SparkSession, path: str) -> DataFrame:
    """All-string dataset rows plus ``pos`` = file order."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in DATASET_COLUMNS])
    rows = spark.read.schema(schema).options(**_CSV).option("multiLine", True).csv(path)
    return rows.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in DATASET_COLUMNS],
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
    )


def typed_dataset(text: DataFrame) -> DataFrame:
    """Native types from the all-string form; empty text cells stay empty."""
    cells = []
    for field in DATASET:
        cell = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            cell = F.coalesce(F.from_json(cell, field.dataType), F.array().cast(field.dataType))
        elif not isinstance(field.dataType, T.StringType):
            cell = cell.try_cast(field.dataType)
        cells.append(cell.alias(field.name))
    return text.select(*cells, *[c for c in ("pos",) if c in text.columns])


def write_profile(dataset: DataFrame, cfg: JobConfig, path: str) -> None:
    """Counters, settings and per-column profile as one JSON document."""
    document = profile_document(dataset.select(*DATASET_COLUMNS), cfg)
    document.write.mode("overwrite").json(path)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROFILE).option("multiLine", True).json(path)


# ---- failure state -----------------------------------------------------------
_STATE_BODY = T.StructType([
    T.StructField("failed_rows", T.MapType(T.StringType(), T.StructType(STATE.fields[1:]))),
])


# The layout in which state files are written, two spaces per level: what ends an entry,
# what stands before the first and the following ones, and what is left after the last.
# A line break never stands inside JSON text, so these only ever match the layout.
_ENTRY_END = "\n    }"
_FIRST_ENTRY = r'^\{\n  "failed_rows" ?: \{\n    "'
_NEXT_ENTRY = ',\n    "'
_AFTER_ENTRIES = r"^\n  \}\n\}\s*$"


def read_state_json(spark: SparkSession, path: str) -> DataFrame:
    """State rows of JSON state files; absent or unreadable files mean no failures.

    A file in the layout that state files are written in is read by its entries, so
    that one large file is parsed by as many tasks as it has splits. It counts
    where every piece is an entry, between one beginning and one end; any other
    file is read as a whole document.
    """
    try:
        pieces = spark.read.text(path, lineSep=_ENTRY_END)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE)
    value = F.col("value")
    first, after = value.rlike(_FIRST_ENTRY), value.rlike(_AFTER_ENTRIES)
    body = F.when(first, F.expr("substring(value, instr(value, '{\n    \"') + 1)")).when(
        value.startswith(_NEXT_ENTRY), F.expr("substring(value, 2)"))
    one = F.from_json(F.concat(F.lit("{"), body, F.lit("}}")), _STATE_BODY["failed_rows"].dataType)
    marked = pieces.select(F.col("_metadata.file_path").alias("file"), first.alias("first"), after.alias("after"),
                           one.alias("entry"))
    fits = (F.count_if("first") == 1) & (F.count_if("after") == 1) & (
        F.count_if(~F.col("after") & (F.coalesce(F.size("entry"), F.lit(0)) != 1)) == 0)
    judged = materialise(marked.groupBy("file").agg(fits.alias("fits")))
    by_entry = marked.join(judged.filter("fits"), "file", "left_semi").filter(~F.col("after")).select(
        F.explode("entry").alias("key", "entry"))
    # As many names as files, which the driver lists for every scan anyway.
    rest = [r.file for r in judged.filter("not fits").select("file").collect()]
    if rest:
        whole = spark.read.text(rest, wholetext=True).select(
            F.explode(F.from_json("value", _STATE_BODY)["failed_rows"]).alias("key", "entry"))
        by_entry = by_entry.unionByName(whole)
    return by_entry.select("key", "entry.*")


def read_state_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).json(path)


def write_state_lines(state: DataFrame, path: str) -> None:
    """State export, one JSON object per failed row."""
    state.select(*STATE.names).write.mode("overwrite").json(path)
