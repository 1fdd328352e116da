"""Unit extraction: what a window copies, and what an element tells of its own."""

from __future__ import annotations

from lexspark.operators.units import ALL_TYPES, element_table, extract_units

KEYS = ["doc"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def pages(spark, rows):
    return spark.createDataFrame([(d, s, ALL_TYPES, h) for d, s, h in rows], "doc int, structure string, want int, html string")


def test_few_windows_copy_the_tokens(spark):
    assert plan(element_table(pages(spark, [(1, "plain", "<p>x</p>")]), KEYS, "html")).count("Window [") <= 4


def test_marks_and_bodies(spark):
    """The first mark of an element up to its end, also with a second mark, a void one and a nested one; the body of a
    plain page ends with its div, and paragraphs of other levels are no frames."""
    rows = [
        (1, "manual", '<div><p class="li ManualConsidrant"><span class="num">(1)</span> a <span class="num">(2)</span></p>'
                      '<p class="li ManualConsidrant"><span class="num"/>(3) b</p>'
                      '<p class="li ManualConsidrant"><b><span class="num">(<span>4</span>)</span></b> c</p></div>'),
        (2, "plain", '<html><p>Whereas out</p><div><div id="TexteOnly"><p>Whereas in</p><div>x</div></div><p>Whereas late</p>'
                     '<div id="TexteOnly"><p>Whereas second</p></div></div></html>'),
        (3, "plain", "<div><p>Whereas none</p></div>"),
        (4, "standard", '<div><div id="art_1"><div class="eli-title"><p>T</p></div><p>x</p><div class="eli-title">U</div></div>'
                        '<div id="art_2"></div></div>'),
    ]
    out = extract_units(pages(spark, rows), KEYS, "html")
    got = [tuple(r) for r in out.orderBy("doc", "pos").select("doc", "type", "number", "title", "text").collect()]
    assert got == [
        (1, "recital", "1", None, "(1) a (2)"), (1, "recital", "", None, "(3) b"), (1, "recital", "", None, "( 4 ) c"),
        (2, "recital", "1", None, "Whereas in"),
        (4, "article", "1", "T", "x"), (4, "article", "2", "", ""),
    ]
