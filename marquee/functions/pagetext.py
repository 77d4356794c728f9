"""Fields of one wiki page: infobox cells and the plot section.

The page is cut with split patterns, so work stays linear in its length, and
only the wanted cells go through the markup chain.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.markup import clean_markup
from marquee.functions.text import INLINE_SPACE, LINE_BREAK, bind, first_value, non_empty, strip
from marquee.schemas import PAGE_FIELDS

# ---------------------------------------------------------------- fixed values
# Page field -> dataset column.
WANTED_KEYS = {"budget": "budget", "gross": "BoxOffice", "language": "Language", "country": "Country"}
# Only these columns keep just the first item of a list.
SINGLE_VALUED = ("Language", "Country")
PLOT_HEADINGS = "Plot|Synopsis|Premise"
PLOT_SKIPPED_STARTS = r"\{\{|\||\[\[File:|\[\[Image:"
PLOT_LENGTH = 2000
NO_INDEX = 999
NO_RESULT = "no Wikipedia search result"
NO_FIELDS = "no usable Wikipedia fields in candidates: "
UNTITLED = "unknown page"
LISTED_TITLES = 5
# -----------------------------------------------------------------------------

_GAP = f"{INLINE_SPACE}*"
# A line break before a line that opens with a bar and holds an equals sign.
_CELL_START = rf"\n(?={_GAP}\|[^\n]*=)"
_CLOSING_LINE = rf"\n{_GAP}\}}\}}[^\n]*"
_LINE_END = rf"{_GAP}(?=\n|\z)"
_PLOT_START = rf"(?iu)\n{_GAP}=={_GAP}(?:{PLOT_HEADINGS}){_GAP}=={_LINE_END}"
_SECTION_START = rf"\n{_GAP}==[^=\n][^\n]*=={_LINE_END}"
_SKIPPED_LINE = rf"\n{_GAP}(?:{PLOT_SKIPPED_STARTS})[^\n]*"


def _page_lines(content: Column) -> Column:
    """Page text with one kind of line break and a break before the first line."""
    return F.concat(F.lit("\n"), F.regexp_replace(content, LINE_BREAK, "\n"))


def _wanted_cells(lines: Column) -> Column:
    """All cells with a wanted key as ``struct(key, text)``, in page order."""
    wanted = rf"(?i)^{_GAP}\|{_GAP}(?:{'|'.join(WANTED_KEYS)}){_GAP}="
    cells = F.filter(F.split(lines, _CELL_START), lambda c: c.rlike(wanted))
    return F.transform(cells, lambda c: F.struct(
        strip(F.lower(F.regexp_extract(c, rf"^{_GAP}\|([^=]*)=", 1))).alias("key"),
        c.alias("text"),
    ))


def _cell_value(cell: Column) -> Column:
    """Raw value of one cell, continuation lines included."""
    value = F.regexp_replace(F.regexp_replace(cell, "^[^=]*=", ""), _CLOSING_LINE, "")
    return F.array_join(F.transform(F.split(value, "\n"), strip), " ")


def _infobox_values(lines: Column) -> Column:
    """Raw values in WANTED_KEYS order; the last cell of a key wins, even if empty."""
    keys = F.array(*[F.lit(k) for k in WANTED_KEYS])
    return bind(_wanted_cells(lines), lambda cells: F.transform(keys, lambda key: _cell_value(
        F.try_element_at(F.filter(cells, lambda c: c["key"] == key), F.lit(-1))["text"]
    )))


def _plot_value(lines: Column) -> Column:
    """Raw text of the first plot-like section; NULL without one."""
    after = F.get(F.split(lines, _PLOT_START, 2), F.lit(1))
    body = F.get(F.split(after, _SECTION_START, 2), F.lit(0))
    return F.replace(F.regexp_replace(body, _SKIPPED_LINE, ""), F.lit("\n"), F.lit(" "))


def _plot_text(cleaned: Column) -> Column:
    return F.coalesce(strip(F.substring(cleaned, 1, PLOT_LENGTH)), F.lit(""))


def _infobox_columns(texts: Column) -> list[Column]:
    out = []
    for at, column in enumerate(WANTED_KEYS.values()):
        text = F.get(texts, F.lit(at))
        if column in SINGLE_VALUED:
            text = F.when(text.isNotNull(), first_value(text))
        out.append(text.alias(column))
    return out


def infobox_fields(content: Column) -> Column:
    """Struct of the four infobox cells; NULL where the page has no such cell."""
    values = _infobox_values(_page_lines(content))
    return bind(F.transform(values, clean_markup), lambda t: F.struct(*_infobox_columns(t)))


def plot_section(content: Column) -> Column:
    """Text of the first plot-like section, at most 2000 characters, else ``''``."""
    return _plot_text(clean_markup(_plot_value(_page_lines(content))))


def page_fields(content: Column) -> Column:
    """All five page fields as one struct; NULL for a page without text."""
    values = bind(_page_lines(content), lambda lines: F.concat(
        _infobox_values(lines), F.array(_plot_value(lines))
    ))
    fields = bind(F.transform(values, clean_markup), lambda t: F.struct(
        *_infobox_columns(t), _plot_text(F.get(t, F.lit(len(WANTED_KEYS)))).alias("plot")
    ))
    return F.when(non_empty(content), fields)


def usable(fields: Column) -> Column:
    """True when plot, language or country has text."""
    return non_empty(fields["plot"]) | non_empty(fields["Language"]) | non_empty(fields["Country"])


def pages_in_order(pages: Column) -> Column:
    """Pages by their search index; ties keep the order of the answer."""
    return F.array_sort(F.transform(pages, lambda p, at: F.struct(
        F.coalesce(p["index"], F.lit(NO_INDEX)).alias("index"),
        at.alias("at"),
        F.coalesce(p["title"], F.lit("")).alias("title"),
        F.coalesce(p["content"], F.lit("")).alias("content"),
    )))


def first_usable_page(pages: Column) -> Column:
    """``struct(title, fields)`` of the first usable page, fields NULL if none.

    Works inside the response row and stops parsing at the first hit.
    """
    chosen_type = f"struct<title:string,fields:{PAGE_FIELDS.simpleString()}>"
    nothing = F.struct(
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast(PAGE_FIELDS).alias("fields"),
    ).cast(chosen_type)

    def step(chosen: Column, page: Column) -> Column:
        def keep(fields: Column) -> Column:
            hit = F.struct(page["title"].alias("title"), fields.alias("fields")).cast(chosen_type)
            return F.when(usable(fields), hit).otherwise(chosen)

        return F.when(chosen["fields"].isNotNull(), chosen).otherwise(
            bind(page_fields(page["content"]), keep)
        )

    return F.aggregate(pages_in_order(pages), nothing, step)


def miss_reason(pages: Column) -> Column:
    """Why a response without a usable page counts as a miss."""
    titles = F.transform(
        F.slice(pages_in_order(pages), 1, LISTED_TITLES),
        lambda p: F.when(p["title"] == "", F.lit(UNTITLED)).otherwise(p["title"]),
    )
    return F.when(F.coalesce(F.size(pages), F.lit(0)) <= 0, F.lit(NO_RESULT)).otherwise(
        F.concat(F.lit(NO_FIELDS), F.array_join(titles, ", "))
    )
