"""Dollar amounts in free text, as millions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.markup import clean_markup
from marquee.functions.numbers import round2
from marquee.functions.text import bind

# An amount with its optional unit, and the plain-dollar limit.
AMOUNT = r"(?i)(?:US\$|\$|USD\s*)\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*(billion|million|m)?"
PLAIN_DOLLARS_ABOVE = 10000


def _in_millions(digits: Column, unit: Column) -> Column:
    """Scale one amount: its unit decides, else its size or its commas do."""
    number = F.replace(digits, F.lit(",")).try_cast("double")
    word = F.lower(unit)
    spelled_out = digits.contains(",") | (number > PLAIN_DOLLARS_ABOVE)
    return (
        F.when(word == "billion", number * 1000)
        .when((word != "million") & spelled_out, number / 1_000_000)
        .otherwise(number)
    )


def money_millions(value: Column) -> Column:
    """Mean of all dollar amounts in the text; NULL where there is none."""
    def mean_of(text: Column) -> Column:
        found = F.zip_with(
            F.regexp_extract_all(text, F.lit(AMOUNT), 1),
            F.regexp_extract_all(text, F.lit(AMOUNT), 2),
            _in_millions,
        )
        mean = bind(found, lambda a: F.when(
            F.size(a) > 0,
            F.aggregate(a, F.lit(0.0), lambda total, one: total + one) / F.size(a),
        ))
        return F.when(~text.contains("N/A"), round2(mean))

    return F.when(value != "", bind(clean_markup(value), mean_of))
