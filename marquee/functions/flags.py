"""Row flags and the shared notion of a missing value."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.text import non_empty


def is_missing(value: Column, kind: T.DataType) -> Column:
    """NULL, empty text, an empty list (native or ``[]``) or NaN."""
    if isinstance(kind, T.ArrayType):
        return value.isNull() | (F.size(value) == 0)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    if isinstance(kind, T.StringType):
        return value.isNull() | value.isin("", "[]")
    return value.isNull()


def is_enriched() -> Column:
    """Any page-backed text column filled."""
    return non_empty(F.col("plot")) | non_empty(F.col("Language")) | non_empty(F.col("Country"))


def is_pending() -> Column:
    """The opposite of ``is_enriched``, in a form file scans can evaluate."""
    def blank(name: str) -> Column:
        return F.col(name).isNull() | (F.col(name) == "")

    return blank("plot") & blank("Language") & blank("Country")


def is_core_complete() -> Column:
    """All page-backed text columns filled."""
    return non_empty(F.col("plot")) & non_empty(F.col("Language")) & non_empty(F.col("Country"))
