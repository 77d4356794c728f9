"""Stored page responses: one JSON file per request, named after its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.text import non_empty
from marquee.schemas import COMBINED_BODY, PARSE_BODY, SEARCH_BODY

# File names of the three response kinds.
COMBINED_NAME = r"^wiki_combined_([0-9]+)_(.*)\.json$"
SEARCH_NAME = r"^wiki_search_(.*)\.json$"
PARSE_NAME = r"^wiki_parse_(.*)\.json$"

# Layout of a response file read whole, and of a table of named bodies.
FILE_SCHEMA = "value string"
BODY_SCHEMA = "name string, body string"


def named_bodies(files: DataFrame) -> DataFrame:
    """(name, body) from whole-text files."""
    return files.select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("body"))


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    return named_bodies(spark.read.text(path, wholetext=True))


def _named(bodies: DataFrame, pattern: str) -> DataFrame:
    """Responses of one kind; a body that is not a filled JSON object is no
    response at all, wherever it was read from."""
    named = bodies.filter(F.col("name").rlike(pattern))
    return named.filter(F.size(F.json_object_keys("body")) > 0)


def _page_content(page: Column) -> Column:
    first = F.get(page["revisions"], F.lit(0))
    return F.coalesce(first["slots"]["main"]["content"], F.lit(""))


def every_combined_response(bodies: DataFrame) -> DataFrame:
    """(search_limit, lookup_key, pages) of the combined responses, whatever limit they were asked with."""
    parsed = _named(bodies, COMBINED_NAME).select(
        F.regexp_extract("name", COMBINED_NAME, 1).alias("search_limit"),
        F.regexp_extract("name", COMBINED_NAME, 2).alias("lookup_key"),
        F.from_json("body", COMBINED_BODY).alias("b"),
    )
    return parsed.select("search_limit", "lookup_key", F.transform("b.query.pages", lambda p: F.struct(
        p["index"].alias("index"), p["title"].alias("title"), _page_content(p).alias("content"),
    )).alias("pages"))


def combined_responses(bodies: DataFrame, search_limit: int) -> DataFrame:
    """(lookup_key, pages) of the combined responses asked with that limit."""
    every = every_combined_response(bodies)
    return every.filter(F.col("search_limit") == str(search_limit)).drop("search_limit")


def candidate_pages(responses: DataFrame) -> DataFrame:
    """One row per candidate page: (lookup_key, index, title, content)."""
    rows = responses.select("lookup_key", F.inline("pages"))
    return rows.withColumns({
        "index": F.coalesce("index", F.lit(999)), "title": F.coalesce("title", F.lit("")),
    })


def search_responses(bodies: DataFrame) -> DataFrame:
    """(lookup_key, page): first non-empty title of each search response."""
    parsed = _named(bodies, SEARCH_NAME).select(
        F.regexp_extract("name", SEARCH_NAME, 1).alias("lookup_key"),
        F.from_json("body", SEARCH_BODY).alias("b"),
    )
    named = F.filter("b.query.search", lambda r: non_empty(r["title"]))
    return parsed.select("lookup_key", F.get(named, F.lit(0))["title"].alias("page"))


def parse_responses(bodies: DataFrame) -> DataFrame:
    """(page_key, content) of the parse responses that carry text and no error."""
    good = _named(bodies, PARSE_NAME).filter(
        ~F.array_contains(F.json_object_keys("body"), "error")
    )
    parsed = good.select(
        F.regexp_extract("name", PARSE_NAME, 1).alias("page_key"),
        F.from_json("body", PARSE_BODY)["parse"]["wikitext"]["*"].alias("content"),
    )
    return parsed.filter(non_empty(F.col("content")))


def land(table: DataFrame, path: str) -> DataFrame:
    """Keep a response table as Parquet: small files are read only once."""
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.parquet(path)
