"""Identifier and text functions on small literal inputs."""

import datetime

import pytest
from pyspark.sql import functions as F

from lexspark.functions import ids as D
from lexspark.functions import markup as M
from lexspark.functions import text as X


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_normalize_text(spark):
    given = ["  a\tb \n c ", "x ,y", "1.5", "))", "a  b", "(1)The", "end .", "a:b;c!d?e"]
    assert apply(spark, X.normalize_text, given) == [
        "a b c", "x, y", "1. 5", ") )", "a b", "(1) The", "end.", "a: b; c! d? e",
    ]


def test_ids(spark):
    ids = ["32016R0679", "02016R0679-20210101", "32016Q0512(01)", "x", "52023PC0533", "32024X1689", "12016DC0001"]
    assert apply(spark, D.is_valid_celex, ids) == [True, True, False, False, True, True, True]
    assert apply(spark, D.is_consolidated, ids) == [False, True, False, False, False, False, False]
    assert apply(spark, D.original_celex, ids[:2]) == ["32016R0679", "32016R0679"]
    assert apply(spark, D.document_type, ids) == [
        "regulation", "consolidated regulation", "Unknown", "Unknown", "proposal", "Unknown",
        "other preparatory document",
    ]
    assert apply(spark, D.normalize_celex, ["\t32016r0679  "]) == ["32016R0679"]
    assert apply(spark, D.resource_url, [" 32016r0679", "bad id"]) == [
        "http://publications.europa.eu/resource/celex/32016R0679", None,
    ]
    assert apply(spark, D.percent_encode, ["a b*c~d/(01)"]) == ["a%20b%2Ac~d%2F%2801%29"]


def test_procedures(spark):
    assert apply(spark, D.is_valid_procedure, ["2023/0202(COD)", "2023/0202/cod", " 2023/0202/COD", "2023/202/COD"]) == [
        True, True, False, False,
    ]
    assert apply(spark, D.normalize_procedure, [" 2023/0202(cod) "]) == ["2023/0202/COD"]


def test_date_from_title(spark):
    given = [
        "Regulation of 13 June 2024 on x", "of 27 April 2016", "5 MAY 2023", "31 June 2020", "1 Smarch 2020",
        "1 Jun 2020", "no date", None,
    ]
    d = datetime.date
    assert apply(spark, X.date_from_title, given) == [
        d(2024, 6, 13), d(2016, 4, 27), d(2023, 5, 5), None, None, None, None, None,
    ]


def test_numbers(spark):
    assert apply(spark, X.recital_number, ["(29)", "29", "a (3) (4)"]) == ["29", "", "3"]
    assert apply(spark, X.article_number, ["Article 1 2", "ARTICLE  7", "Section 3"]) == ["12", "7", ""]
    assert [tuple(r) for r in apply(spark, X.annex_heading, ["see ANNEX iv to this", "none"])] == [
        ("iv", "to this"), ("", ""),
    ]
    assert [tuple(r) for r in apply(spark, X.annex_heading_plain, ["Annex 3: list", "the annex"])] == [
        ("3", ": list"), ("", ""),
    ]
    keys = apply(spark, X.section_key, ["rct_1.x", "art_12a", "art_1_para_2", "anx_iV", "anx_q", ""])
    assert [tuple(k) if k else None for k in keys] == [
        ("recital", "1.x"), ("article", "12a"), None, ("annex", "iV"), None, None,
    ]


def test_unescape(spark):
    given = ["a &amp;lt; b", "&#8364;&#x20AC;&euro;", "&unknown; &", "&#0;", "plain", "&apos;&nbsp;|"]
    assert apply(spark, X.unescape, given) == ["a &lt; b", "€€€", "&unknown; &", "�", "plain", "' |"]


def test_decode_literal(spark):
    xsd = "http://www.w3.org/2001/XMLSchema#"
    rows = [
        ("true", "literal", xsd + "boolean"), ("0", "literal", xsd + "boolean"),
        ("42", "literal", xsd + "positiveInteger"), ("x", "literal", xsd + "integer"),
        ("1.5", "literal", xsd + "decimal"), ("2024-06-13", "literal", xsd + "date"),
        ("2024-06-13T10:00:00Z", "literal", xsd + "dateTime"), ("soon", "literal", xsd + "dateTime"),
        ("2020", "literal", xsd + "gYear"), ("http://x", "uri", None), ("t", "literal", None), (None, None, None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, v string, k string, d string")
    got = df.select("i", X.decode_literal(F.col("v"), F.col("k"), F.col("d")).alias("r")).orderBy("i").collect()
    kinds = [r["r"]["v_kind"] for r in got]
    assert kinds == [
        "boolean", "boolean", "integer", "bad", "double", "date", "timestamp", "string", "year", "string",
        "string", "string",
    ]
    assert got[0]["r"]["v_bool"] is True and got[1]["r"]["v_bool"] is False
    assert got[2]["r"]["v_long"] == 42 and got[4]["r"]["v_double"] == 1.5 and got[8]["r"]["v_long"] == 2020
    assert got[7]["r"]["v_text"] == "soon" and got[11]["r"]["v_text"] == ""


def test_tokens_rebuild_the_page(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    pages += ["a < b <p title='x>y'>t</p><!-- <p> --><script>1<2</script><", "", "<"]
    assert apply(spark, lambda c: F.array_join(M.raw_tokens(c), ""), pages) == pages


def test_parses(spark):
    given = [
        "<a><b/></a>", "<?xml version='1.0'?>\n<!DOCTYPE html><html>x&nbsp;y</html>", "<a>&nbsp;</a>", "<a><p></a>",
        "<a/><b/>", "<a/>tail", "", None, "<a/><p>", "text",
    ]
    assert apply(spark, M.parses, given) == [True, True, False, False, False, False, False, False, False, False]


def test_repaired_pages_read_as_xhtml(spark):
    given = [
        "<a><b/></a>", "<div><p>one<p>two</div>", "<div>x</i></div>", "<div>A & B &nbsp;</div>", "<div>a<br>b</i></div>",
        "<a><img src='x'></a>", '<html><meta http-equiv="Content-Type" content="x"><p>y</html>', "<a><!-- <br> --><p></a>",
        "<a><script>if (a < b) c</script><p></a>", "<a><script>c()</script><p></a>", "<a><style>p > b {}</style><p></a>",
        "<a><colgroup><p></a>", "text", "", None,
    ]
    assert apply(spark, M.reads_as_xhtml, given) == [
        True, True, True, True, False, False, True, True, False, True, True, True, False, False, False,
    ]


def test_flatten_wrappers(spark):
    given = [
        '<b><div class="content">lost<p>a</p>kept<div>x</div></div>lost<p>c</p></b>',
        '<b><div class="content"><div class="content">no<p>a</p></div>no<p>b</p></div></b>',
        '<div class="content"><p>root stays</p></div>',
        '<b><div class="other content">x</div></b>',
        '<b><div class="content"><!-- <div> --><p>a</p></div></b>',
    ]
    assert apply(spark, M.flatten_wrappers, given) == [
        "<b><p>a</p>kept<div>x</div><p>c</p></b>",
        "<b><p>a</p><p>b</p></b>",
        given[2],
        given[3],
        "<b><!-- <div> --><p>a</p></b>",
    ]


def test_structure(spark):
    given = [
        '<html><div id="rct_1"/><p class="Titrearticle"/></html>', "<html><p class='Annexetitre'>x</p></html>",
        '<html><div id="TexteOnly"/></html>', '<html><div id="anx_I"/></html>',
        '<html><!-- <div id="art_1"> --></html>', '<x:div xmlns:x="u" id="art_1"/>',
    ]
    assert apply(spark, M.structure_of, given) == ["standard", "manual", "plain", None, None, "standard"]


def test_long_and_broken_tags_do_not_deepen_the_stack(spark):
    attributes = "<html><div " + " ".join(f'a{i}="{i}"' for i in range(100_000)) + ' id="rct_1">t</div></html>'
    missing_quote = '<html><p class="b>t</p>' + '<p class="b">t</p>' * 50_000 + '<div id="TexteOnly"></div></html>'
    assert apply(spark, lambda c: F.array_join(M.raw_tokens(c), ""), [attributes, missing_quote]) == [attributes, missing_quote]
    assert apply(spark, M.structure_of, [attributes, missing_quote])[0] == "standard"
    assert apply(spark, lambda c: F.size(M.raw_tokens(c)), [missing_quote])[0] > 1000


def test_attributes_as_pages_write_them(spark):
    given = [
        "<html><div id=TexteOnly></div></html>", "<html><DIV ID='TexteOnly'></DIV></html>",
        '<html><div title="a>b" id="rct_1"></div></html>', "<html><p CLASS='Titrearticle'></p></html>",
        '<html><div data-x="rct_1"></div></html>',
    ]
    assert apply(spark, M.structure_of, given) == ["plain", "plain", "standard", "manual", None]
    tags = ["<a id=x>", "<a ID = 'y z'>", '<a id="">', "<a>", '<a id="p>q" b>']
    assert apply(spark, lambda c: M.attribute(c, "id"), tags) == ["x", "y z", "", "", "p>q"]
