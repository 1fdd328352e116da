"""An element that holds one text alone is one row of the token table, with the same units as from single tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.functions.markup import loose_tags
from lexspark.functions.text import normalize_text
from lexspark.operators.tokens import html_tokens
from lexspark.operators.units import ALL_TYPES, RECITAL_CLASS, element_table, extract_manual, extract_units, units_from_elements

KEYS = ["doc"]


def pages(spark, rows):
    return spark.createDataFrame([(d, s, ALL_TYPES, h) for d, s, h in rows], "doc int, structure string, want int, html string")


def kinds(spark, html):
    df = pages(spark, [(1, "plain", html)])
    return [(r["kind"], r["tag"], r["text"]) for r in
            html_tokens(df, KEYS, "html", loose=True, alone=F.lit(True)).orderBy("pos").collect()]


def test_leaf_rows(spark):
    assert kinds(spark, '<div><P class="a">x &amp; y</p><p> &nbsp;</p><br/></div>') == [
        ("open", "div", ""), ("leaf", "p", "x & y"), ("leaf", "p", ""), ("void", "br", ""), ("close", "div", "")]
    # a quoted end tag, a text like an attribute, a div and an unbalanced page stay single tokens
    for html in ('<b title=">x</b>">y</b>', "<p>a id=b</p>", "<div>x</div>", "<p>x</p><p>"):
        assert all(k != "leaf" for k, _, _ in kinds(spark, html)), html


def test_same_units_as_from_single_tokens(spark):
    rows = [
        (1, "manual", '<div><p class="li ManualConsidrant"><span class="num">(1)</span> a<b> c</b> <span>(2)</span></p>'
                      '<p class="li ManualConsidrant">(3) no mark</p><p class="Titrearticle">Article 4<br/>T</p><p>x</p><p> </p>'
                      '<p class="Titrearticle"><span>Article 5</span></p><p class="Titrearticle"><span>U</span></p><p>y &lt; z</p>'
                      '<p class="Annexetitre">ANNEX IV</p><p class="NormalCentered"><b>V</b></p><p>w</p></div>'),
        (2, "plain", '<html><p>Whereas out</p><div id="TexteOnly"><p>Whereas in</p><p>Article 1</p><p>a=b</p><p><i>c</i> d</p>'
                     "<p>ANNEX 2</p><p>e</p></div><p>late</p></html>"),
        (3, "standard", '<div><div id="rct_1"><p>a</p><p>b<i>c</i></p></div><div id="art_1"><p class="oj-ti-art">Article 1</p>'
                        '<div class="eli-title"><p>T</p></div><div><p>x</p></div></div><div id="anx_I"><p class="oj-doc-ti">ANNEX I</p>'
                        '<p class="oj-doc-ti">D</p><p>z</p></div></div>'),
        (4, "plain", '<div id="TexteOnly"><p>Whereas open<p>Article 1</p><p>x</p></div>'),
    ]
    docs = pages(spark, rows)
    cols = ["doc", "type", "number", "title", "text"]
    get = lambda df: [tuple(r) for r in df.orderBy("doc", "pos", "type").select(*cols).collect()]
    single = get(units_from_elements(element_table(docs, KEYS, "html", alone=F.lit(False)), KEYS))
    assert get(extract_units(docs, KEYS, "html")) == get(extract_units(docs, KEYS, "html", unique=True)) == single
    assert len(single) == 13 and (1, "recital", "1", None, "(1) a c (2)") in single and (1, "article", "5", "U", "y < z") in single


def test_rows_with_one_key_are_not_fused(spark):
    page = '<div id="TexteOnly"><p>Whereas a</p></div>'
    docs = pages(spark, [(1, "plain", page), (1, "plain", page), (2, "plain", page)])
    before = units_from_elements(element_table(docs, KEYS, "html"), KEYS)
    key = lambda df: sorted(map(tuple, df.select("doc", "type", "number", "text").collect()))
    assert key(extract_units(docs, KEYS, "html")) == key(before)


def test_only_wanted_elements_are_put_together(spark):
    page = '<div><p class="li ManualConsidrant"><span class="num">(1)</span> a</p><p>x</p><p class="Titrearticle">Article 1<br/>T</p></div>'
    docs = pages(spark, [(1, "manual", page)]).withColumn("want", F.lit(1))
    assert [r["el_class"] for r in element_table(docs, KEYS, "html").collect()] == [RECITAL_CLASS]
    got = extract_manual(docs.select("doc", "html"), KEYS, "html", ["recital"]).select("number", "text").collect()
    assert [tuple(r) for r in got] == [("1", "(1) a")]


def test_single_spaces_stay(spark):
    df = spark.createDataFrame([(" a  b  c\td e , f \n",)], "t string")
    assert df.select(normalize_text(F.col("t"))).first()[0] == "a b c d e, f"


def test_a_leaf_text_is_cut_out_once_and_decoded_once(spark):
    df = pages(spark, [(1, "plain", "<p>a &amp; b</p>")])
    plan = html_tokens(df, KEYS, "html", loose=True, alone=F.lit(True))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("substring_index(") == 2  # the text before the end tag, behind the start tag


def test_pages_are_lowered_for_their_tag_names_alone(spark):
    got = lambda html: spark.createDataFrame([(html,)], "h string").select(loose_tags(F.col("h"))).collect()[0][0]
    assert got("<p>É X</P><DIV a='B'></div>") == [] and got("<P>É") == ["p"] and got("<K>x</k>") == [] and got("<i É>É</i><I>") == ["i"]
