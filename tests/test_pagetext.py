"""Infobox cells, plot section and page choice on small wikitext pages."""

from pyspark.sql import functions as F

from marquee.functions.money import money_millions
from marquee.functions.pagetext import (
    first_usable_page, infobox_fields, miss_reason, page_fields, plot_section,
)
from marquee.schemas import RESPONSE_PAGES

PAGE_A = """{{Infobox film
| name = X
| country = [[India]]
| language = {{plainlist|
* Hindi
* English
}}
| budget = $5 million
| gross = $20 million<ref>x</ref>
}}
Lead text, more.
== Plot ==
{{long plot}}
Hero '''wins'''.
=== Act 2 ===
More [[text|words]].
== Cast ==
Z
"""


def read(spark, pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, c string")
    return [r.f for r in df.select("i", page_fields(F.col("c")).alias("f")).orderBy("i").collect()]


def test_page_a(spark):
    (f,) = read(spark, [PAGE_A])
    assert (f.Country, f.Language, f.budget) == ("India", "Hindi", "$5 million")
    assert f.BoxOffice == (
        "$20 million Lead text, more. == Plot == Hero wins. === Act 2 === More words. == Cast == Z")
    assert f.plot == "Hero wins. === Act 2 === More words."
    df = spark.createDataFrame([(f.BoxOffice,)], "v string")
    assert df.select(money_millions(F.col("v"))).first()[0] == 20.0


def test_all_line_breaks_and_edges(spark):
    pages = [PAGE_A.replace("\n", b) for b in
             ["\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]]
    want = read(spark, [PAGE_A])[0]
    assert all(f == want for f in read(spark, pages))
    got = read(spark, [
        "{{Infobox film| country = X",
        "| country = A\n| country =",
        "| country = USA, UK",
        "| country = A\n| other = z\nmore",
        "  | COUNTRY  = A=B\n| a\n  }} gone\nc",
        "| country = N/A",
        "",
        None,
        "|country=A\n\n|no equals\n| language = |B",
        "== plot ==\n\n  {{x\nyes\n | no\n[[File:a]]\n[[Image:b]]\n[[file:c]] == d ==\n==e==\nf",
        "== Plot summary ==\nx\n== Premise ==\nP\n== Plot ==\nQ",
        "text\n ==  SYNOPSIS==  \nonly\n==\n== x\n====\n==== y ====\n== ==\nno",
        "== Plot ==",
        "== Plot ==\n" + "ab " * 1500,
    ])
    assert got[0].Country is None and got[0].plot == ""
    assert got[1].Country == ""
    assert got[2].Country == "USA"
    assert got[3].Country == "A"
    assert got[4].Country == "A=B | a c"
    assert got[5].Country == ""
    assert got[6] is None and got[7] is None
    assert (got[8].Country, got[8].Language) == ("A |no equals", "B")
    assert got[9].plot == "yes file:c == d =="
    assert got[10].plot == "P"
    assert got[11].plot == "only == == x ==== ==== y ===="
    assert got[12].plot == ""
    assert got[13].plot == ("ab " * 1500)[:2000].strip()


def test_single_field_readers(spark):
    df = spark.createDataFrame([(PAGE_A,)], "c string")
    row = df.select(infobox_fields(F.col("c")).alias("b"), plot_section(F.col("c")).alias("p")).first()
    assert (row.b.Country, row.p) == ("India", "Hero wins. === Act 2 === More words.")


def test_long_page_is_linear(spark):
    filler = "x" * 80 + "\n"
    page = "{{Infobox film\n| country = India\n" + "| k = v\n" * 2000 + "}}\n" + " " * 20000 + "\n" \
        + filler * 5000 + "== Plot ==\n" + filler * 5000
    (f,) = read(spark, [page])
    assert f.Country == "India" and len(f.plot) == 1999 + 1


def choose(spark, pages):
    df = spark.createDataFrame([(pages,)], "pages " + RESPONSE_PAGES.simpleString())
    return df.select(first_usable_page(F.col("pages")).alias("hit"),
                     miss_reason(F.col("pages")).alias("why")).first()


def test_first_usable_page(spark):
    good = "| country = {}"
    row = choose(spark, [(2, "B", good.format("two")), (1, "A", ""), (None, "C", good.format("x"))])
    assert (row.hit.title, row.hit.fields.Country) == ("B", "two")
    row = choose(spark, [(1, "A", good.format("one")), (1, "B", good.format("two"))])
    assert row.hit.title == "A"
    row = choose(spark, [(2, "T2", "x"), (1, None, None), (3, "T3", "| budget = $1"),
                         (4, "", ""), (5, "T5", ""), (6, "T6", "")])
    assert row.hit.fields is None
    assert row.why == ("no usable Wikipedia fields in candidates: "
                       "unknown page, T2, T3, unknown page, T5")
    for nothing in ([], None):
        row = choose(spark, nothing)
        assert row.why == "no Wikipedia search result"
        assert row.hit is None or row.hit.fields is None
