"""Plain text from wiki markup, as one chain of built-in expressions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import SPACE_SET, bind

_SPACE = f"[{SPACE_SET}]"

# Fixed values: (pattern, replacement) in the order they must be applied, grouped
# by a marker without which no pattern of the group can match.
# ``(?d)`` limits ``.`` to stop at a line feed only; ``(?u)`` folds case as Unicode.
MARKUP_STEPS = [
    ("<", [
        (r"(?s)<!--.*?-->", ""),
        (r"(?is)<ref[^>]*>.*?</ref>", ""),
        (r"(?i)<ref[^/]*/>", ""),
        (rf"(?i)<br{_SPACE}*/?>", ", "),
        (r"<[^>]+>", ""),
    ]),
    ("{{", [
        (r"(?iu)\{\{(?:ubl|plainlist|plain list|unbulleted list)\|", ""),
        (r"\{\{nowrap\|([^{}]+)\}\}", "$1"),
        (r"(?d)\{\{flag\|([^{}|]+).*?\}\}", "$1"),
        (r"(?id)\{\{convert\|([^{}|]+)\|([^{}|]+)\|?.*?\}\}", "$1 $2"),
        (r"(?iu)\{\{(?:lang|native name|small|abbr)[^{}]*\}\}", ""),
        (r"\{\{[^{}]+\}\}", ""),
        (r"\{\{[^{}]*", ""),
    ]),
    ("|group", [
        (rf"\|group{_SPACE}*={_SPACE}*[^}}|]+", ""),
    ]),
    ("[", [
        (r"\[\[[^|\]]+\|([^\]]+)\]\]", "$1"),
        (r"\[\[([^\]]+)\]\]", "$1"),
        (rf"\[[a-z]+://[^\]{SPACE_SET}]+{_SPACE}+([^\]]+)\]", "$1"),
    ]),
    ("''", [
        (r"'{2,}", ""),
    ]),
]
LITERAL_STEPS = [("}}", ""), ("&nbsp;", " "), ("\xa0", " "), ("*", ", ")]
SPACE_RUN = f"{_SPACE}+"
EDGE_CHARS = " ,|"


def _apply_group(value: Column, group: tuple) -> Column:
    """Run the group's patterns only on text that holds their marker."""
    marker, steps = group
    return bind(value, lambda v: F.when(
        v.contains(marker), reduce(lambda w, step: F.regexp_replace(w, *step), steps, v)
    ).otherwise(v))


def clean_markup(value: Column) -> Column:
    """Markup-free, single-spaced text without separators at either end."""
    bare = reduce(_apply_group, MARKUP_STEPS, value)
    for old, new in LITERAL_STEPS:
        bare = F.replace(bare, F.lit(old), F.lit(new))
    return F.btrim(F.regexp_replace(bare, SPACE_RUN, " "), F.lit(EDGE_CHARS))
