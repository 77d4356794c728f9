"""Linking rows to stored page responses.

A response row is one stored answer: ``(lookup_key, pages)``. Pages are parsed
inside that row, before any shuffle, so joins move a few parsed cells instead
of page text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.money import money_millions
from marquee.functions.pagetext import first_usable_page, miss_reason, page_fields
from marquee.functions.text import bind, combined_key, non_empty, safe_name, search_key
from marquee.operators.joins import HOT_ROWS, keep_keys, lookup_join
from marquee.schemas import PAGE_FIELDS
from marquee.session import materialise


def parsed_responses(responses: DataFrame) -> DataFrame:
    """(lookup_key, page, fields, reason); ``fields`` is NULL for a miss.

    The answer leaves through a generator, so later filters and projections on
    it cannot make the optimiser parse a page twice.
    """
    answer = bind(first_usable_page(F.col("pages")), lambda hit: F.struct(
        hit["title"].alias("page"),
        hit["fields"].alias("fields"),
        F.when(
            F.coalesce(hit["fields"].isNull(), F.lit(True)), miss_reason(F.col("pages"))
        ).alias("reason"),
    ))
    asked = [c for c in ("search_limit", "lookup_key") if c in responses.columns]
    return responses.select(*asked, F.inline(F.array(answer)))


def one_per_key(parsed: DataFrame) -> DataFrame:
    """One parsed response per key where a request was stored more than once.

    A usable answer wins over a miss; among equals the choice follows the
    content, so a rerun makes the same one.
    """
    answer = F.struct("page", "fields", "reason")
    return parsed.groupBy("lookup_key").agg(F.min_by(answer, answer_order()).alias("a")).select(
        "lookup_key", "a.*")


def answer_order() -> Column:
    """Which of several answers to one request counts: the least by this order."""
    answer = F.to_json(F.struct("page", "fields", "reason"))
    return F.struct(F.col("fields").isNull().alias("miss"), F.xxhash64(answer).alias("digest"))


def with_money(rows: DataFrame) -> DataFrame:
    """Replace ``fields`` by the five dataset cells, amounts parsed to millions."""
    amounts = F.transform(F.array("fields.budget", "fields.BoxOffice"), money_millions)
    parsed = rows.withColumn("_amounts", amounts)
    return parsed.select(
        *[c for c in rows.columns if c != "fields"],
        F.col("fields.Language").alias("page_Language"),
        F.col("fields.Country").alias("page_Country"),
        F.col("_amounts")[0].alias("page_budget"),
        F.col("_amounts")[1].alias("page_BoxOffice"),
        F.col("fields.plot").alias("page_plot"),
    )


def with_lookup_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("lookup_key", combined_key(F.col("primaryTitle"), F.col("startYear")))


def join_parsed(
    keyed: DataFrame, parsed: DataFrame, row_id: str, at_most: int | None = None
) -> DataFrame:
    """Keyed rows left-joined to parsed responses, ``has_response`` always set.

    Many rows may share one key, so without a row bound hot keys are spread.
    """
    known = parsed.withColumn("has_response", F.lit(True))
    if at_most is None:
        joined = lookup_join(keyed, known, "lookup_key", row_id)
    else:
        joined = keyed.join(known, "lookup_key", "left")
    return joined.withColumn("has_response", F.coalesce("has_response", F.lit(False)))


def lookup_combined(
    rows: DataFrame, responses: DataFrame, row_id: str = "tconst", at_most: int | None = None
) -> DataFrame:
    """Rows left-joined to their response on the combined key.

    ``at_most`` bounds the row count where a limit has set one; then only the
    responses those rows ask for are parsed. Without a bound every response is
    parsed, once. A request stored several times counts once.
    """
    keyed = with_lookup_key(rows)
    if at_most is not None:
        responses = keep_keys(responses, keyed, "lookup_key", at_most)
    return join_parsed(keyed, one_per_key(parsed_responses(responses)), row_id, at_most)


def lookup_two_call(
    rows: DataFrame, searches: DataFrame, parses: DataFrame, at_most: int | None = None,
    row_id: str = "tconst", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows left-joined to page fields through a search and a parse response.

    ``searches`` is (lookup_key, page); ``parses`` is (page_key, content).
    ``fields`` is NULL for rows without a page. Of a search or a page stored
    several times the least counts, so that there is one row per row asked.

    ``at_most`` bounds the row count where a limit has set one. Without a bound many
    rows may ask one search, and many searches may name one page: the hot keys of both
    joins are spread, and a page is parsed once however many ask for it.
    """
    keyed = rows.withColumn("lookup_key", search_key(F.col("primaryTitle"), F.col("startYear")))
    named = keep_keys(searches, keyed, "lookup_key", at_most).groupBy("lookup_key").agg(
        F.min("page").alias("page"))
    # At most one row per row asked: written once, it serves the filter and the join.
    found = materialise(named.withColumn("page_key", safe_name(F.col("page"))))
    texts = keep_keys(parses, found, "page_key", at_most).filter(non_empty(F.col("content")))
    one = texts.groupBy("page_key").agg(F.min("content").alias("content"))
    fields = one.select("page_key", page_fields(F.col("content")).alias("fields"))
    if at_most is None:
        # Searches meet pages first, each search once; then rows meet their search.
        answers = lookup_join(found, materialise(fields), "page_key", "lookup_key", hot_rows)
        joined = lookup_join(keyed, answers, "lookup_key", row_id, hot_rows)
    else:
        joined = keyed.join(found, "lookup_key", "left").join(fields, "page_key", "left")
    return joined.drop("page_key").withColumn("fields", F.col("fields").cast(PAGE_FIELDS))
