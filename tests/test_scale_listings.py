"""Listings and texts: what is computed once, and what travels through a shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from lexspark.functions.text import is_blank, normalize_text, strip, unescape
from lexspark.sources.landed import parse_listing

KEYS = ["doc"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_listing_is_split_once(spark):
    df = spark.createDataFrame([
        (1, '<ul><li title="item"><a href="u?a=1&amp;b=&eacute;">x</a><li title="stream_name"> n </li></li>'
            '<li title="item">no address</li><li title="item"><a href="v">x</a></li></ul>'),
        (2, ""), (3, None), (4, "no item"),
    ], "doc int, html string")
    out = parse_listing(df, "html", KEYS)
    assert plan(out).count("split(") == 1
    assert [tuple(r) for r in out.orderBy("doc", "pos").collect()] == [(1, 0, "u?a=1&b=é", "n", 999), (1, 2, "v", "", 999)]


def test_items_are_written_behind_the_shuffle(spark, tmp_path):
    line = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, l_returnflag string"
    spark.createDataFrame([
        (1, 2, 7, 1, 1.0, 1.0, "A"), (1, 1, 8, 1, 1.0, 1.0, "R"), (1, 1, 8, 1, 1.0, 1.0, "N"), (1, 3, None, 1, 1.0, 1.0, "N"),
        (None, 7, 9, 1, 1.0, 1.0, None), (2, None, 9, 1, 1.0, 1.0, "A"),
    ], line).write.parquet(f"{tmp_path}/lineitem.parquet")
    df = I.listings(spark, str(tmp_path))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "<li" not in text[text.index("Exchange"):]
    got = {r["doc"]: r["html"] for r in df.collect()}
    names = lambda html: [p.split(" </li>")[0] for p in html.split('stream_name"> ')[1:]]
    assert names(got[1]) == ["1_EN_annexe.html", "1_EN_cover.html", "1_EN_ACT_part1.html"]
    assert names(got[None]) == ["1_EN_cover.html"] and "no link" in got[None]
    assert got[2] == "<html><body><ul></ul></body></html>"


def test_references_are_decoded_once(spark):
    cases = {
        "&amp;lt;": "&lt;", "&lt;&gt;&quot;&apos;&amp;": "<>\"'&", "&amp;amp;": "&amp;", "a&b": "a&b", "&": "&", "&amp": "&amp",
        "&eacute;&lt;": "é<", "&#60;&amp;": "<&", "&nope;&lt;": "&nope;<", "": "", "&amp;#60;": "&#60;", "&AMP;": "&AMP;",
    }
    df = spark.createDataFrame(list(cases.items()), "x string, y string")
    assert [r["x"] for r in df.filter(unescape(F.col("x")) != F.col("y")).collect()] == []


def test_white_space_of_all_kinds(spark):
    wide = "  　 \x1c\x85   "
    df = spark.createDataFrame([(f"{wide}a{wide},b{wide}c​{wide}",)], "x string")
    row = df.select(normalize_text("x").alias("n"), strip(F.col("x")).alias("s"), is_blank(F.lit(wide)).alias("b"), is_blank(F.lit("​")).alias("z")).first()
    assert tuple(row) == ("a, b c​", f"a{wide},b{wide}c​", True, False)
    assert "(?U)" not in plan(df.select(normalize_text("x"), strip(F.col("x"))))
