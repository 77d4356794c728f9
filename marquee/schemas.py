"""Table layouts shared by sources, operators and sinks."""

from pyspark.sql import types as T

# Column order of the delivered dataset.
DATASET_COLUMNS = [
    "tconst", "primaryTitle", "startYear", "genres", "lead_actors_ids",
    "runtimeMinutes", "averageRating", "Language", "Country", "numVotes",
    "budget", "BoxOffice", "plot",
]

DATASET = T.StructType([
    T.StructField("tconst", T.StringType()),
    T.StructField("primaryTitle", T.StringType()),
    T.StructField("startYear", T.IntegerType()),
    T.StructField("genres", T.ArrayType(T.StringType())),
    T.StructField("lead_actors_ids", T.ArrayType(T.StringType())),
    T.StructField("runtimeMinutes", T.IntegerType()),
    T.StructField("averageRating", T.DoubleType()),
    T.StructField("Language", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("numVotes", T.LongType()),
    T.StructField("budget", T.DoubleType()),
    T.StructField("BoxOffice", T.DoubleType()),
    T.StructField("plot", T.StringType()),
])

STATE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("retry_search_limit", T.IntegerType()),
])

_MISSING = T.StructType([
    T.StructField("missing_count", T.LongType()),
    T.StructField("missing_percent", T.DoubleType()),
])
PROFILE = T.StructType([
    T.StructField("movie_count", T.LongType()),
    T.StructField("team_letter", T.StringType()),
    T.StructField("target_movie_count", T.LongType()),
    T.StructField("candidate_pool_size", T.LongType()),
    T.StructField("require_wikipedia_page", T.BooleanType()),
    T.StructField("wikipedia_enrich_limit", T.LongType()),
    T.StructField("wikipedia_enriched_count", T.LongType()),
    T.StructField("wikipedia_core_complete_count", T.LongType()),
    T.StructField("missing", T.StructType([T.StructField(c, _MISSING) for c in DATASET_COLUMNS])),
])

# Parsed page cells; a NULL cell means the page never named that field.
PAGE_FIELDS = T.StructType([
    T.StructField("budget", T.StringType()),
    T.StructField("BoxOffice", T.StringType()),
    T.StructField("Language", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("plot", T.StringType()),
])

# One lookup answer after normalisation: at most ``search_limit`` pages.
RESPONSE_PAGES = T.ArrayType(T.StructType([
    T.StructField("index", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
]))

# Raw JSON bodies of the three response kinds.
COMBINED_BODY = T.StructType([
    T.StructField("query", T.StructType([
        T.StructField("pages", T.ArrayType(T.StructType([
            T.StructField("index", T.IntegerType()),
            T.StructField("title", T.StringType()),
            T.StructField("revisions", T.ArrayType(T.StructType([
                T.StructField("slots", T.StructType([
                    T.StructField("main", T.StructType([
                        T.StructField("content", T.StringType()),
                    ])),
                ])),
            ]))),
        ]))),
    ])),
])
SEARCH_BODY = T.StructType([
    T.StructField("query", T.StructType([
        T.StructField("search", T.ArrayType(T.StructType([
            T.StructField("title", T.StringType()),
        ]))),
    ])),
])
PARSE_BODY = T.StructType([
    T.StructField("parse", T.StructType([
        T.StructField("wikitext", T.StructType([
            T.StructField("*", T.StringType()),
        ])),
    ])),
])
