"""Scalar expressions against hand-derived expectations."""

import math

from pyspark.sql import functions as F

from marquee.functions import numbers, text
from marquee.functions.markup import clean_markup
from marquee.functions.money import money_millions


def apply(spark, expression, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").repartition(2)
    return [r[0] for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i")
            .select("out").collect()]


def check(spark, expression, pairs):
    got = apply(spark, expression, [p[0] for p in pairs])
    assert got == [p[1] for p in pairs]


def test_clean_int(spark):
    check(spark, text.clean_int, [
        ("1994", 1994), ("\\N", None), ("N/A", None), ("", None), (None, None), ("12.7", 12),
        ("about 90 min", 90), ("1,234", 1234), ("-5", 5), ("abc", None), ("19 94", 19),
        ("9" * 30, None),
    ])


def test_clean_float(spark):
    check(spark, text.clean_float, [
        ("7.5", 7.5), ("1,234.5", 1234.5), ("abc", None), ("5d", None), ("\\N", None),
        ("N/A", None), ("", None), (None, None), (" 8 ", 8.0), ("1_000", 1000.0), ("1e3", 1000.0),
        (".5", 0.5), ("5.", 5.0), ("+3", 3.0), ("-inf", -math.inf), ("Infinity", math.inf),
        ("1__0", None), ("0x10", None), ("1e", None),
    ])
    assert math.isnan(apply(spark, text.clean_float, ["nan"])[0])


def test_list_field(spark):
    check(spark, lambda c: text.list_text(text.list_field(c)), [
        ("Drama,Comedy", '["Drama", "Comedy"]'), (" a , ,b", '["a", "b"]'), ("\\N", "[]"),
        ("N/A", "[]"), (None, "[]"), ("", "[]"), (",", "[]"), ("é\"x", '["é\\"x"]'),
    ])


def test_first_value(spark):
    check(spark, text.first_value, [
        ("English, French", "English"), ("N/A", ""), (",x", ""), ("A|B, C", "A|B"), (None, ""),
        ("", ""), (" \xa0a　", "a"),
    ])


def test_keys(spark):
    check(spark, text.safe_name, [
        ("M (1931) film", "M_1931_film"), ("Mé & x", "M_x"), ("a" * 130, "a" * 120),
        ("x.y-z_0", "x.y-z_0"),
    ])
    rows = [("Mé", 1931), ("M", None), ("M", 0)]
    df = spark.createDataFrame(rows, "t string, y int")
    got = df.select(text.search_key(F.col("t"), F.col("y")),
                    text.combined_key(F.col("t"), F.col("y"))).collect()
    assert [tuple(r) for r in got] == [
        ("M_1931_film", "M_1931_film"), ("M_film", "M_film"), ("M_film", "M_0_film")]
    keys = spark.createDataFrame(
        [("t1", "M", "1931"), ("", "M", "1931"), (None, None, None)], "i string, t string, y string")
    assert [r[0] for r in keys.select(
        text.row_key(F.col("i"), F.col("t"), F.col("y"))).collect()] == ["t1", "M:1931", ":"]


def test_strip_covers_every_space(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert sorted(text.WHITESPACE) == sorted(spaces)
    check(spark, text.strip, [(s + "x" + s, "x") for s in spaces])
    check(spark, clean_markup, [(f"a{s}b", "a b") for s in spaces])


def test_round2_is_exact_binary(spark):
    values = [k / 1000 for k in range(-3000, 30000, 7)] + [1.005, 2.675, 72.9522, 0.125, 0.375]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(numbers.round2(F.col("v"))).collect()]
    assert got == [round(v, 2) for v in values]


def test_float_text(spark):
    values = [8.3, 10.0, 12345678.9, 1e15, 1e16, 0.0, 0.001, 0.00025, 2923.71, 1.0e7]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    got = [r[0] for r in df.select(numbers.float_text(F.col("v"))).collect()]
    assert [float(g) for g in got] == values
    assert got[:4] == ["8.3", "10.0", "12345678.9", "1000000000000000.0"]


MONEY = [
    ("$10 million", 10.0), ("US$1.5 billion", 1500.0), ("$2,500,000", 2.5), ("$500", 500.0),
    ("$10000", 10000.0), ("$20000", 0.02), ("$10,000", 0.01), ("$1,200 million", 1200.0),
    ("$12m", 12.0), ("$1,200m", 0.0), ("$5 million – $10 million", 7.5), ("$5–10 million", 5.0),
    ("$1.8 million (est. $2 million)", 1.9), ("A$5 million", 5.0), ("USD 3 million", 3.0),
    ("usd3 BILLION", 3000.0), ("$1.005 million", 1.0), ("₹500 million", None), ("£3 million", None),
    ("10 million", None), ("$5 million (N/A)", None), ("{{US$|10 million}}", None),
    ("{{nowrap|$10 million}}", 10.0), ("", None), (None, None),
]


def test_money(spark):
    check(spark, money_millions, MONEY)


def test_clean_markup(spark):
    check(spark, clean_markup, [
        ("'''Bold''' and ''it''", "Bold and it"),
        ("[[United States|American]]", "American"),
        ("[[French language]]", "French language"),
        ('A<ref name="x"/> B <ref>c</ref> D', "A D"),
        ("A<ref name=x /> B", "A B"),
        ("English<br />French", "English, French"),
        ("{{ubl|English|French}}", "English|French"),
        ("{{plainlist| * English * French", "English , French"),
        ("{{nowrap|$10 million}}", "$10 million"),
        ("{{Nowrap|$10 million}}", ""),
        ("{{flag|India|name=X}}", "India"),
        ("{{convert|100|km|mi}}", "100 km"),
        ("{{hlist|English|Hindi}}", ""),
        ("{{small|{{nowrap|x}}}}", ""),
        ("{{plainlist|{{flag|US}}}}", "US"),
        ("x {{unclosed text", "x"),
        ("[https://x.org site]", "site"),
        ("<!-- x -->India", "India"),
        ("<!-- x\ny -->India", "India"),
        ("a&nbsp;b", "a b"),
        (", |a,b| ,", "a,b"),
        ("Drama|group = x|y", "Drama|y"),
        ("{{flag|a\nb}}\n{{flag|c}}", "a b c"),
        ("", ""),
        (None, None),
    ])
