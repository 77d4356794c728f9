"""Rounding and number text that agree with binary round-half-even."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Two decimals of the exact binary value; ``round``/``bround`` differ on ties."""
    return F.call_function("format_number", value, F.lit("0.00")).try_cast("double")


def float_text(value: Column) -> Column:
    """Plain digits up to 1e16, as a CSV reader outside the JVM expects them."""
    plain = F.regexp_replace(
        value.cast("string").try_cast("decimal(38,18)").cast("string"), r"(\.[0-9]+?)0+$", "$1"
    )
    size = F.abs(value)
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when((size >= 1e7) & (size < 1e16), plain)
        .when((size < 1e-3) & (size >= 1e-4), plain)
        .otherwise(value.cast("string"))
    )
