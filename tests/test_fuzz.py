"""Random wikitext through the Spark expressions and through the line-based SQL."""

import random

import duckdb
import pytest
from compare import canonical
from pyspark.sql import functions as F

from marquee.catalog import oracles
from marquee.functions.markup import clean_markup
from marquee.functions.money import money_millions
from marquee.functions.pagetext import page_fields

TOKENS = [
    "{{", "}}", "{{{", "}", "{", "[[", "]]", "[", "]", "|", "||", "=", "==", "===", "<", ">", "<ref>",
    "<ref name=a>", "<REF name='b'/>", "</ref>", "<br>", "<BR />", "<!--", "-->", "<b>", "</b>",
    "''", "'''", "'", "*", "&nbsp;", "\xa0", " ", "  ", "\t", " ", "\x1f", ",", ".", "/", "N/A",
    "nowrap|", "flag|", "convert|", "ubl|", "plainlist|", "plain list|", "lang|", "Small|", "efn|",
    "|group = n", "File:", "http://x.org ", "$", "US$", "USD", "10", "1,500", "2.5", "20000",
    "million", " billion", "m", "–", "India", "France", "word", "é", "字",
]
LINES = [
    "| country = ", "|country=", "  | Country  = ", "| language = ", "|LANGUAGE =", "| budget = ",
    "| gross = ", "| name = x", "| no equals", "|=", "| = a", "}}", " }} tail", "== Plot ==",
    "==Synopsis==  ", " == premise ==", "== Plot summary ==", "=== Plot ===", "== Cast ==",
    "==x==", "====", "== ==", "{{Infobox film", "{{long}}", "[[File:a.png]]", "[[Image:b]]",
    "[[file:c]]", "", " ", "text",
]
BREAKS = ["\n", "\n", "\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", " "]


def tokens(rng, most):
    return "".join(rng.choice(TOKENS) for _ in range(rng.randrange(most)))


def page(rng):
    out = []
    for _ in range(rng.randrange(25)):
        out.append(rng.choice(LINES) + (tokens(rng, 8) if rng.random() < 0.6 else ""))
        out.append(rng.choice(BREAKS))
    return "".join(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    return [page(rng) for _ in range(1500)] + [tokens(rng, 40) for _ in range(1500)]


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "part long, content string")


@pytest.fixture(scope="module")
def connection(texts):
    import pandas as pd

    con = duckdb.connect()
    pages = pd.DataFrame({"part": range(len(texts)), "slot": 1, "content": texts})
    con.register("pages_in", pages)
    con.sql("create table fuzz as select * from pages_in")
    return con


def agree(df, result):
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    theirs = canonical(result.columns, result.fetchall())
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert a == b


def test_markup(frame, connection):
    cleaned = frame.select("part", clean_markup(F.col("content")).alias("c"))
    agree(cleaned, connection.sql(f"select part, {oracles.clean('content')} as c from fuzz"))
    for row in cleaned.collect():
        assert "  " not in row.c and "&nbsp;" not in row.c and "*" not in row.c
        assert row.c == row.c.strip(" ,|")


def test_money(frame, connection):
    parsed = frame.select("part", money_millions(F.col("content")).alias("m"))
    found = oracles.money("c")
    agree(parsed, connection.sql(
        f"select part, {found} as m from (select part, {oracles.clean('content')} as c from fuzz)"))


def test_page_fields(frame, connection, monkeypatch):
    monkeypatch.setitem(
        oracles.CTES, "page_texts", ([], "select part, slot, content from fuzz"))
    sql = oracles.query(["page_box", "page_plot"], """select part, budget, BoxOffice, Language,
      Country, plot from page_box join page_plot using (part, slot) where part in (
      select part from fuzz where content <> '')""")
    fields = frame.filter("content <> ''").select(
        "part", F.inline(F.array(page_fields(F.col("content")))))
    agree(fields, connection.sql(sql))
