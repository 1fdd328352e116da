"""Text units of small pages of each structure."""

import pytest
from pyspark.sql import functions as F

from lexspark.operators.units import extract_manual, extract_plain, extract_standard


def units(spark, extract, *pages, **kw):
    docs = spark.createDataFrame([(f"d{i}", p) for i, p in enumerate(pages)], "doc string, html string")
    rows = extract(docs, ["doc"], "html", **kw).orderBy("doc", "pos").collect()
    return [(r["type"], r["number"], r["title"], r["text"]) for r in rows]


STANDARD = """<html><body>
<div id="rct_1"><p>(1)</p><p>First <b>recital</b>text.</p></div>
<div id="art_1"><p class="oj-ti-art">Article 1</p><div class="eli-title"><p>Subject</p></div>
<div class="oj-normal">This  is text ,right?</div> lost <div></div><p>More</p></div>
<div id="art_1_para_2"><p>no unit</p></div>
<div id="art_2a"><p class="oj-ti-art">Article 2a</p><div><div class="eli-title">Deep</div><p>Body</p></div></div>
<div id="anx_iv"><p class="oj-doc-ti">ANNEX IV</p><p class="oj-doc-ti">Old</p><p class="oj-doc-ti">New title</p><p>Text &amp; more</p></div>
</body></html>"""


def test_standard(spark):
    assert units(spark, extract_standard, STANDARD) == [
        ("recital", "1", None, "(1) First recital text."),
        ("article", "1", "Subject", "This is text, right?  More"),
        ("article", "2a", "Deep", "Deep Body"),
        ("annex", "iv", "New title", "Text & more"),
    ]


def test_standard_type_toggle(spark):
    assert [u[0] for u in units(spark, extract_standard, STANDARD, types=["annex"])] == ["annex"]
    assert units(spark, extract_standard, STANDARD, types=[]) == []


def test_nested_sections_both_get_the_text(spark):
    page = """<html><div><div id="rct_1"><p>outer</p><div id="rct_1.x"><p>inner</p></div><p>end</p></div></div></html>"""
    assert units(spark, extract_standard, page) == [
        ("recital", "1", None, "outer inner end"),
        ("recital", "1.x", None, "inner"),
    ]


def test_article_inside_annex(spark):
    page = """<html><body><div id="anx_I"><p>a</p><div id="art_3"><p>b</p></div></div>
    <div id="art_9"/></body></html>"""
    assert units(spark, extract_standard, page) == [
        ("annex", "I", "", "a b"), ("article", "3", "", "b"), ("article", "9", "", ""),
    ]


def test_first_title_only_and_comment_child(spark):
    page = """<html><body><div id="art_1"><div class="eli-title">One</div><!-- c --><div><div class="eli-title">Two</div>x</div></div></body></html>"""
    assert units(spark, extract_standard, page) == [("article", "1", "One", "Two x")]
    page = """<html><body><div id="art_1"><p>a</p><!-- c --><p>b</p></div></body></html>"""
    assert units(spark, extract_standard, page) == [("article", "1", "", "a  b")]


MANUAL = """<html><body>
<p class="li ManualConsidrant"><span class="num">(29)</span> Whereas this.</p>
<p class="Titrearticle"><span>Article 1 2<br/>The title</span></p>
<p class="Normal">One.</p><p class="Normal">Two</p><table><tr><td>cell</td></tr></table>
<p class="Titrearticle"><span>Article 13</span></p>
<p class="Titrearticle">bare <span>Other</span> <span>title</span></p>
<p class="Normal">Body</p>
<p class="Titrearticle"><span>no number</span></p><p>dropped</p>
<p class="Annexetitre">ANNEX IV of things</p><p>annex a</p><p>annex b</p>
<p class="Annexetitre"><span>ANNEX</span> <span>V</span></p><p class="NormalCentered"><b>Centred</b> lost</p><p>rest</p>
<p class="Annexetitre">no numeral here</p><p>still a row</p>
<p class="Fait">Done at</p><p>after</p>
</body></html>"""


def test_manual(spark):
    assert units(spark, extract_manual, MANUAL) == [
        ("recital", "29", None, "(29) Whereas this."),
        ("article", "12", "The title", "One. Twocell"),
        ("article", "13", "Other title", "Body"),
        ("annex", "IV", "of things", "annex a annex b"),
        ("annex", "V", "Centred", "rest"),
        ("annex", "", "", "still a row"),
    ]


def test_manual_last_heading_stops_its_type(spark):
    page = """<html><body><div><p class="Titrearticle"><span>Article 1</span></p><p>x</p>
    <p class="Titrearticle"><span>Article 2</span></p></div>
    <div><p class="Titrearticle"><span>Article 3</span></p><p>y</p></div></body></html>"""
    assert units(spark, extract_manual, page) == [("article", "1", "", "x")]


PLAIN = """<html><body><p>Article 9 outside</p><div id="TexteOnly">
<p>Whereas one ;</p><p>Article 1 heading text</p><p>a</p><p>Whereas inside</p>
<p>ANNEX II The list</p><p>b</p><p>Article 2</p><p>c</p></div><p>Article 10</p></body></html>"""


def test_plain(spark):
    assert units(spark, extract_plain, PLAIN, types=["recital"]) == [
        ("recital", "1", None, "Whereas one;"), ("recital", "2", None, "Whereas inside"),
    ]
    assert units(spark, extract_plain, PLAIN, types=["article"]) == [
        ("article", "1", "", "a Whereas inside"), ("article", "2", "", "c"),
    ]
    assert units(spark, extract_plain, PLAIN, types=["annex"]) == [
        ("annex", "II", "The list", "b Article 2 c"),
    ]


def test_plain_unclosed_paragraphs(spark):
    page = """<html><body><div id="TexteOnly"><p>Article 1<p>one <b>bold<p>two</div><p>out</body></html>"""
    assert units(spark, extract_plain, page, types=["article"]) == [("article", "1", "", "one bold two")]


@pytest.mark.parametrize("damage", [
    lambda p: p.replace("</p>", ""), lambda p: p.replace("</p>", "</p></i>"), lambda p: p.replace("&amp;", "&"),
    lambda p: p.replace("<b>", "<b><u>"),
])
def test_damaged_xhtml_gives_the_units_of_the_sound_page(spark, damage):
    """Unclosed paragraphs, stray end tags, a bare &, an element closed by its ancestor."""
    from lexspark.plans.dataset import build_text_units

    page = STANDARD.replace(" lost <div></div>", "")
    other = '<html><body><div id="art_9"><p>plain HTML</p></div></body></html>'
    broken = damage(page)
    assert broken != page
    rows = [("32016R0679", "main", "xhtml", broken), ("32016R0679", "main", "html", other), ("32016R0680", "main", "html", page)]
    bodies = spark.createDataFrame(rows, "celex_id string, role string, fmt string, body string")
    got = {}
    for r in build_text_units(bodies.select("celex_id").distinct(), bodies).collect():
        got.setdefault(r["celex_id"], []).append((r["type"], r["number"], r["title"], r["text"]))
    assert len(got["32016R0680"]) == 4 and sorted(got["32016R0679"]) == sorted(got["32016R0680"])
