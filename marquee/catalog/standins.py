"""Stand-in tables: the catalogue's inputs derived from the driver tables.

The driver tables hold no titles and no wiki pages, so every input is derived
from them, row by row and over whole tables. Variants picked by a remainder
only choose how a cell is *spelled*; they never drop rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.config import JobConfig
from marquee.functions.numbers import round2
from marquee.functions.text import combined_key
from marquee.operators.candidates import project_titles

# Settings of every registered query: STANDARD parts play the wanted type.
CONFIG = JobConfig(
    letter="L", target_rows=12, pool_rows=20, enrich_limit=8,
    title_type="STANDARD", actor_category="A",
)
RUN = JobConfig(batch_rows=250, search_limit=8)
RETRY = JobConfig(batch_rows=150, search_limit=8, retry_failed=True)


# Columns the stand-ins read; a declared schema needs no footer job per query.
TABLES = {
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_returnflag string",
    "documents": "doc_id bigint, text string",
    "pages": "page_id bigint, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed titles: typed and trimmed, so filters reach the scan."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as tconst",
        "p_type as titleType",
        "p_name as primaryTitle",
        "1980 + p_size as startYear",
        "50 + 6 * p_size as runtimeMinutes",
        "array(p_brand, p_type) as genres",
    )


def raw_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string titles with messy cells."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as tconst",
        "p_type as titleType",
        "case p_partkey % 7 when 0 then concat('  ', p_name, chr(9)) when 1 then upper(p_name) "
        "else p_name end as primaryTitle",
        "case p_partkey % 11 when 0 then '\\\\N' when 1 then 'N/A' when 2 then '' "
        "when 3 then concat('c. ', 1980 + p_size) else string(1980 + p_size) end as startYear",
        "case p_partkey % 9 when 0 then '\\\\N' when 1 then concat(50 + 6 * p_size, ' min') "
        "when 2 then concat('0,', 50 + 6 * p_size, ',') else string(50 + 6 * p_size) end "
        "as runtimeMinutes",
        "case p_partkey % 5 when 0 then '\\\\N' when 1 then concat(' ', p_brand, ' , ,', p_type) "
        "else concat(p_brand, ',', p_type) end as genres",
    )


def typed_raw_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_titles(raw_titles(spark, sf_dir))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per part; parts without a deep-discount return have no votes."""
    votes = F.count_if((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.08))
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        round2(F.avg("l_quantity")).alias("averageRating"), votes.alias("_votes"),
    ).select(
        F.col("l_partkey").cast("string").alias("tconst"),
        "averageRating",
        F.nullif("_votes", F.lit(0)).alias("numVotes"),
    )


def repeated_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as one rating record of its part, in order-line order."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_partkey as string) as tconst",
        "l_quantity as averageRating",
        "cast(l_extendedprice as bigint) as numVotes",
        "(l_orderkey * 10 + l_linenumber) * 1000000 + l_suppkey as ordering",
    )


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_partkey as string) as tconst",
        "l_returnflag as category",
        "concat('nm', l_suppkey) as nconst",
        "l_orderkey * 10 + l_linenumber as ordering",
    )


_HEAD = "concat('{{Infobox film', chr(10), '| name = ', p_name, chr(10))"
_PLOT = "concat('}}', chr(10), 'Lead.', chr(10), '== Plot ==', chr(10), body, chr(10), '== Cast ==')"
# Page text by spelling variant; column ``v`` picks one.
_CONTENT = f"""case v
 when 0 then ''
 when 1 then concat({_HEAD}, '| language = {{{{plainlist|', chr(10), '* ', p_brand, chr(10),
   '* Other', chr(10), '}}}}', chr(10), '| country = [[', n_name, ']]', chr(10), {_PLOT})
 when 2 then concat({_HEAD}, '| Country = [[', n_name, ' (state)|', n_name, ']], Other', chr(10),
   '| language = [[', p_brand, ' language]]<ref name="a">r</ref>', chr(10),
   '| budget = $', p_size, ' million', chr(10), '| other = x', chr(10), {_PLOT})
 when 3 then concat({_HEAD}, '| budget = US$', p_size + 1, ',250,000<br />est.', chr(10),
   '| country = ', n_name, chr(10), 'and more', chr(10), '| x = y', chr(10), {_PLOT})
 when 4 then concat({_HEAD}, '| gross = $', p_size, '.5 billion', chr(10), {_PLOT})
 when 5 then concat({_HEAD}, '| budget = $', p_size, ' million – $', p_size + 7, ' million',
   chr(10), '| language = {{{{ubl|', p_brand, '|Other}}}}', chr(10), '| x =', chr(10), {_PLOT})
 when 6 then concat({_HEAD}, '| country = ', n_name, chr(10), '| country = ', chr(10),
   '| language = ', repeat(chr(39), 3), p_brand, repeat(chr(39), 3), ', Other', chr(10),
   '| x =', chr(10), {_PLOT})
 when 7 then concat({_HEAD}, '| language = {{{{nowrap|', p_brand, '}}}} <!-- note -->', chr(10),
   '| x =', chr(10), '}}}}', chr(10), body)
 when 8 then concat('{{{{Infobox film| country = ', n_name, chr(10), '  | language = N/A', chr(10),
   '| x =', chr(10), '}}}}', chr(13), chr(10), ' == SYNOPSIS ==', chr(10), '{{{{long}}}}', chr(10),
   body, chr(10), '=== Sub ===', chr(10), 'More.', chr(10), '==End==', chr(10), 'Gone')
 else concat({_HEAD}, '| budget = USD ', p_size, 'm', chr(10), '}}}}', chr(10), body)
end"""


def _page_rows(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    part = table(spark, sf_dir, "part") if part is None else part
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Texts are the large side and parsing them is the work: join by shuffle, so
    # it is spread by id instead of following the splits of the part file.
    documents = table(spark, sf_dir, "documents").select("doc_id", "text").hint("merge")
    return (
        part.select("p_partkey", "p_name", "p_brand", "p_size")
        .join(nation, F.expr("p_partkey % 25 = n_nationkey"))
        .join(documents, F.expr("p_partkey = doc_id"), "left")
        .withColumn("body", F.coalesce("text", F.concat(F.lit("Story of "), "p_name")))
    )


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per part and slot 1..3: (part, slot, content)."""
    return (
        _page_rows(spark, sf_dir)
        .withColumn("slot", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .withColumn("v", F.expr("(p_partkey + slot) % 10"))
        .select(F.col("p_partkey").alias("part"), "slot", F.expr(_CONTENT).alias("content"))
    )


# One response: no page or three, in and out of index order, one without a title.
_PAGES = f"""transform(
  if(p_partkey % 10 = 0, cast(array() as array<int>), array(1, 2, 3)),
  slot -> named_struct(
    'index', case p_partkey % 4 when 0 then 4 - slot
             when 1 then if(slot = 1, null, slot) else slot end,
    'title', if(p_partkey % 10 = 3 and slot = 2, '', concat(p_name, ' (', slot, ')')),
    'content', transform(array((p_partkey + slot) % 10), v -> {_CONTENT})[0]))"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lookup_key, pages): one response per key with the pages of all parts that ask for it."""
    key = combined_key(F.col("p_name"), F.expr("1980 + p_size"))
    own = _page_rows(spark, sf_dir).select(
        key.alias("lookup_key"), "p_partkey", F.expr(_PAGES).alias("pages"))
    parts = F.sort_array(F.collect_list(F.struct("p_partkey", "pages")))
    return own.groupBy("lookup_key").agg(F.flatten(
        F.transform(parts, lambda p: p["pages"])).alias("pages"))


def repeated_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lookup_key, pages): every part stores the answer to its own request.

    Parts that share a key have asked several times, and been answered differently.
    """
    key = combined_key(F.col("p_name"), F.expr("1980 + p_size"))
    return _page_rows(spark, sf_dir).select(
        key.alias("lookup_key"), F.expr(_PAGES).alias("pages"))


def combined_bodies(answers: DataFrame) -> DataFrame:
    """Responses as named JSON bodies, one per stored request."""
    body = F.expr(
        "to_json(named_struct('batchcomplete', true, 'query', named_struct('pages', "
        "transform(pages, p -> named_struct('index', p.index, 'title', p.title, 'revisions', "
        "array(named_struct('slots', named_struct('main', named_struct('content', p.content)))))))))"
    )
    return answers.select(
        F.concat(F.lit(f"wiki_combined_{RUN.search_limit}_"), "lookup_key", F.lit(".json")
                 ).alias("name"),
        body.alias("body"),
    )


def two_call_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search and parse responses as named JSON bodies.

    A search answers with a blank and a real title, or with none; the parse
    response holds the first page, or an error where there is none.
    """
    answers = responses(spark, sf_dir)
    found = F.expr(
        "to_json(named_struct('query', named_struct('search', if(size(pages) = 0, "
        "cast(array() as array<struct<title:string>>), array(named_struct('title', ''), "
        "named_struct('title', concat('Page ', lookup_key)))))))"
    )
    parsed = F.expr(
        "if(size(pages) = 0, '{\"error\": {\"code\": \"missingtitle\"}}', "
        "to_json(named_struct('parse', named_struct('wikitext', named_struct('*', pages[0].content)))))"
    )
    searches = answers.select(
        F.concat(F.lit("wiki_search_"), "lookup_key", F.lit(".json")).alias("name"),
        found.alias("body"))
    parses = answers.select(
        F.concat(F.lit("wiki_parse_Page_"), "lookup_key", F.lit(".json")).alias("name"),
        parsed.alias("body"))
    return searches.unionByName(parses)


def dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a dataset row in order ``pos``; some already have fields."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as pos",
        "if(p_type = 'MEDIUM', '', string(p_partkey)) as tconst",
        "if(p_type = 'MEDIUM', concat(p_name, ' ', p_partkey), p_name) as primaryTitle",
        "1980 + p_size as startYear",
        "if(p_size = 9, array(), array(p_brand, p_type)) as genres",
        "cast(array() as array<string>) as lead_actors_ids",
        "50 + 6 * p_size as runtimeMinutes",
        "if(p_size = 3, double('NaN'), cast(p_size as double)) as averageRating",
        "if(p_type = 'LARGE', 'French', '') as Language",
        "if(p_type = 'LARGE' and p_size > 20, 'France', '') as Country",
        "p_partkey + 1 as numVotes",
        "if(p_size < 15, p_size * 1.5D, null) as budget",
        "cast(null as double) as BoxOffice",
        "case when p_type = 'SMALL' and p_size > 25 then 'Known story' "
        "when p_type = 'LARGE' and p_size > 40 then 'Old story' else '' end as plot",
    )


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known failures: the promo parts, small and medium ones up to a size."""
    rows = table(spark, sf_dir, "part").filter(
        "p_type = 'PROMO' or (p_type in ('SMALL', 'MEDIUM') and p_size <= 12)"
    )
    return rows.selectExpr(
        "if(p_type = 'MEDIUM', concat(p_name, ' ', p_partkey, ':', 1980 + p_size), "
        "string(p_partkey)) as key",
        "p_name as title",
        "string(1980 + p_size) as year",
        "'earlier miss' as reason",
        "if(p_size = 7, null, p_size % 9) as retry_search_limit",
    )
