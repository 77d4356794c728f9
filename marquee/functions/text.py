"""Cleaning of raw catalogue cells and construction of keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Characters the source tables count as white space, as text and as a class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_SET = r"\s\p{Z}\x0B\x1c-\x1f\x85"
# White space that does not end a line.
INLINE_SPACE = r"[\t\x1f\p{Zs}]"
# Everything that ends a line.
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1c-\x1e\x85\x{2028}\x{2029}]"
# Spellings of a missing cell.
MISSING_WORDS = ["", "\\N", "N/A"]
# Accepted shapes of a real number, after commas are gone.
NUMBER_SHAPE = (
    r"^[+-]?(?:[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?|\.[0-9]+(?:_[0-9]+)*)"
    r"(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?$"
)
NAN_SHAPE = r"(?i)^[+-]?nan$"
INFINITY_SHAPE = r"(?i)^[+-]?inf(?:inity)?$"
DIGIT_RUN = r"[0-9][0-9,]*"
KEY_UNSAFE = r"[^A-Za-z0-9_.-]+"
KEY_LENGTH = 120
QUOTED_CELL = r'(?s)^"((?:[^"]++|"")*+)"(?!")(.*)$'
# -----------------------------------------------------------------------------


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as often as needed."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def present(value: Column) -> Column:
    """True unless the cell is NULL or one of the missing spellings."""
    return value.isNotNull() & ~value.isin(MISSING_WORDS)


def non_empty(value: Column) -> Column:
    return F.coalesce(value != "", F.lit(False))


def clean_int(value: Column) -> Column:
    """First run of digits as bigint; text without digits or too large: NULL."""
    digits = F.replace(F.regexp_extract(value, DIGIT_RUN, 0), F.lit(","))
    return digits.try_cast("bigint")


def clean_float(value: Column) -> Column:
    """Whole-cell real number; ``nan`` and ``inf`` are numbers, ``5d`` is not."""
    cell = strip(F.replace(value, F.lit(",")))
    infinity = F.when(cell.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (
        F.when(cell.rlike(NUMBER_SHAPE), F.replace(cell, F.lit("_")).try_cast("double"))
        .when(cell.rlike(NAN_SHAPE), F.lit(float("nan")))
        .when(cell.rlike(INFINITY_SHAPE), infinity)
    )


def list_field(value: Column) -> Column:
    """Comma list as ``array<string>``: items trimmed, blanks gone, never NULL."""
    items = F.filter(F.transform(F.split(value, ","), strip), lambda item: item != "")
    return F.when(present(value), items).otherwise(F.array().cast("array<string>"))


def list_text(items: Column) -> Column:
    """JSON text of a string list with ``", "`` between the items."""
    def quoted(item: Column) -> Column:
        return bind(F.to_json(F.array(item)), lambda j: F.substring(j, F.lit(2), F.length(j) - 2))

    return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))


def first_value(value: Column) -> Column:
    """Trimmed text before the first comma; missing gives the empty string."""
    head = strip(F.split_part(value, F.lit(","), F.lit(1)))
    return F.when(value.isNull() | (value == "N/A"), F.lit("")).otherwise(head)


def safe_name(value: Column) -> Column:
    return F.substring(F.regexp_replace(value, KEY_UNSAFE, "_"), 1, KEY_LENGTH)


def search_key(title: Column, year: Column) -> Column:
    """Key of a search response; a missing or zero year is left out."""
    shown = F.when(year != 0, year).cast("string")
    return safe_name(F.concat_ws(" ", title, shown, F.lit("film")))


def combined_key(title: Column, year: Column) -> Column:
    """Key of a combined response; a missing year leaves an empty slot."""
    shown = F.coalesce(year.cast("string"), F.lit(""))
    return safe_name(F.concat(title, F.lit(" "), shown, F.lit(" film")))


def row_key(tconst: Column, title: Column, year: Column) -> Column:
    """Dataset row identity: the id, or title and year where the id is missing."""
    blank = F.lit("")
    spelled = F.concat(
        F.coalesce(title, blank), F.lit(":"), F.coalesce(year.cast("string"), blank)
    )
    return F.when(non_empty(tconst), tconst).otherwise(spelled)


def fold_case(value: Column) -> Column:
    """Caseless form for ordering: ``ß`` sorts as ``ss``, final sigma as sigma.

    Dotless i has no caseless partner, so it is parked during the upper step.
    The translations also keep the optimiser from merging the case steps.
    """
    parked = F.translate(F.lower(value), "\u0131", "\ue0ff")
    upper = F.translate(F.upper(parked), "\u03a3", "\u03c3")
    return F.translate(F.lower(upper), "\ue0ff", "\u0131")


def unquote(value: Column) -> Column:
    """Cell text without its enclosing double quotes, doubled quotes halved.

    Only a quote that also closes inside the cell is taken as one; anything
    after the closing quote is kept as it is.
    """
    inner = F.replace(F.regexp_extract(value, QUOTED_CELL, 1), F.lit('""'), F.lit('"'))
    rest = F.regexp_extract(value, QUOTED_CELL, 2)
    return F.when(value.rlike(QUOTED_CELL), F.concat(inner, rest)).otherwise(value)
