"""Graph operators, listing choice and sources on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from lexspark import model as M
from lexspark.operators import graph as G
from lexspark.operators import sets as S
from lexspark.operators.choose import body_choices, select_annex, select_manifestation
from lexspark.operators.filters import between_exclusive, concept_filter, corrigenda_filter, sectors, type_filter
from lexspark.operators.scale import number_rows, salted_join
from lexspark.operators.sequence import number_in_order, section_by_headings
from lexspark.sources.landed import drop_incomplete, notice_fields, parse_listing, read_bindings, read_typed_bindings


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_bindings(spark):
    doc = {"head": {"vars": ["a", "b"]}, "results": {"bindings": [
        {"a": {"type": "literal", "value": "1", "xml:lang": "en"}, "b": {"type": "uri", "value": "u"}},
        {"a": {"type": "literal", "value": "2", "datatype": "x"}},
    ]}}
    df = spark.createDataFrame([(1, json.dumps(doc)), (2, "{}"), (3, "broken")], "id int, js string")
    got = read_bindings(df, "js", ["a", "b"], keep=["id"])
    assert rows(got, "id", "pos", "a", "b") == [(1, 0, "1", "u"), (1, 1, "2", None)]
    assert drop_incomplete(got, ["a", "b"]).count() == 1
    typed = read_typed_bindings(df, "js", "a", keep=["id"])
    assert rows(typed.filter("pos = 0"), "value", "lang") == [("1", "en")]


def test_contains_join_few_and_many_agree(spark):
    labels = spark.createDataFrame([("Economic policy",), ("blue ring",), ("x",), ("",), (None,)], "label string")
    few = ["ECON", "ring", "zzz", "o"]
    many = few + [f"none{i}" for i in range(100)]
    expected = [("Economic policy", "ECON"), ("Economic policy", "o"), ("blue ring", "ring")]
    assert rows(G.match_keywords(labels, few), "label", "keyword") == expected
    assert rows(G.match_keywords(labels, many), "label", "keyword") == expected
    assert G.match_keywords(labels, []).count() == 0
    # an empty needle is in every text but not in NULL, whatever the number of needles
    for needles in ([""], [""] + many):
        assert G.match_keywords(labels, needles).filter("keyword = ''").count() == 4


def test_labels(spark):
    pref = spark.createDataFrame([("k", "u1", "b"), ("k", "u1", "a"), ("k", "u1", "a")], "keyword string, uri string, label string")
    alt = spark.createDataFrame([("k", "u1", "c"), ("k", "u2", "d"), ("l", "u3", "e")], "keyword string, uri string, label string")
    merged = G.merge_labels(pref, alt).orderBy("keyword", "uri").collect()
    assert [(r[0], r[1], list(r[2])) for r in merged] == [
        ("k", "u1", ["a", "b", "c"]), ("k", "u2", ["d"]), ("l", "u3", ["e"]),
    ]
    assert rows(G.concept_counts(pref.unionByName(alt)), "keyword", "n_concepts") == [("k", 2), ("l", 1)]


def test_maps_are_split_not_cut(spark):
    rel = spark.createDataFrame([("s", f"t{i}", "cites", i) for i in range(50)] + [("q", "t", "amends", 1)],
                                "celex_source string, celex_target string, relation_type string, pos int")
    bags = G.relation_map(rel, span=10)
    parts = [r["relations"]["cites"] for r in bags.filter("celex_source = 's'").orderBy("part").collect()]
    assert parts == [[f"t{i}" for i in range(a, a + 10)] for a in range(0, 50, 10)]  # parts follow each other by pos
    flat = bags.select("celex_source", F.explode("relations").alias("k", "v")).select("celex_source", F.explode("v"))
    assert flat.count() == 51
    whole = G.relation_map(rel).filter("celex_source = 's'").collect()
    assert whole[0]["part"] == 0 and whole[0]["relations"]["cites"][:3] == ["t0", "t1", "t2"]


def test_pivot_last_wins(spark):
    p = spark.createDataFrame([("a", "title", "old", 1), ("a", "title", "new", 5), ("a", "date", "d", 2), ("a", "cites", "x", 9)],
                              "celex_id string, data_type string, value string, pos int")
    assert rows(G.pivot_properties(p), "celex_id", "title", "date") == [("a", "new", "d")]
    single, rel = G.property_bag(p)
    assert rows(rel, "celex_source", "celex_target") == [("a", "x")]


def test_procedures(spark):
    dossiers = spark.createDataFrame([
        ("http://p/2023/0202/COD", "52023PC0348"), ("http://p/2023/0323/COD", "52023PC0533"),
        ("http://p/2023/0323/COD", "52023PC0533(01)"), ("http://p/2023/0323/COD", "52023SC0001"),
    ], "ref string, proposal string")
    adopts = spark.createDataFrame([("32025R2518", "52023PC0348"), ("32000R0001", "52000PC0001")], "work string, proposal string")
    got = G.resolve_procedures(dossiers, adopts, ["2023/0202/COD", "2023/0323/COD", "1999/0001/COD"])
    assert rows(got, "celex_id") == [("32025R2518",), ("52023PC0533",)]


def test_relation_hop_and_language(spark):
    t = [("w1", M.CDM + "work_cites_work", "w2"), ("w2", M.P_CELEX, "B"), ("w1", M.P_DATE, "2020-01-01"),
         ("e1", M.P_EXPRESSION_OF, "w1"), ("e1", M.P_TITLE, "T"), ("e1", M.P_LANGUAGE, "l/ENG"),
         ("e2", M.P_EXPRESSION_OF, "w1"), ("e2", M.P_TITLE, "F"), ("e2", M.P_LANGUAGE, "l/FRA")]
    df = spark.createDataFrame(t, "s string, p string, o string")
    assert rows(G.relation_hop(df), "s", "relation_type", "value") == [("w1", "cites", "B")]
    assert rows(G.all_properties(df), "s", "data_type", "value") == [
        ("w1", "cites", "B"), ("w1", "date", "2020-01-01"), ("w1", "title", "T"),
    ]


def test_original_relations_keep_duplicates(spark):
    rel = spark.createDataFrame([("32016R0679", "x", "cites"), ("32016R0679", "x", "cites")], "celex_source string, celex_target string, relation_type string")
    works = spark.createDataFrame([("02016R0679-20200101",), ("02016R0679-20210101",), ("32016R0679",)], "celex_id string")
    assert G.relations_with_original(rel, works).count() == 2 + 2 * 2


def test_salted_join_is_exact_on_a_hot_key(spark):
    many = spark.range(1000).select(F.when(F.col("id") < 700, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    other = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("999", "c")], "k string, v string")
    plain = rows(many.join(other, "k"), "k", "id", "v")
    assert rows(salted_join(many, other, "k", ["id"], rows_per_salt=50), "k", "id", "v") == plain
    left = rows(many.join(other, "k", "left").na.fill("-"), "k", "id", "v")
    assert rows(salted_join(many, other, "k", ["id"], how="left", rows_per_salt=50).na.fill("-"), "k", "id", "v") == left


def test_number_rows(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 500).alias("v"))
    got = number_rows(df, ["k", "v"]).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 501))
    assert [(r["k"], r["v"]) for r in got] == sorted((r["k"], r["v"]) for r in got)
    assert number_rows(df.limit(0), ["k"]).count() == 0


LISTING = """<ul><li title="item"><ul><li title="url"><a href="http://x/1">a</a></li>
<li title="stream_name">L_1_EN_annexe.html</li><li title="stream_order">1</li></ul></li>
<li title="item"><ul><li><a href="http://x/2?a=1&amp;b=2">b</a></li><li title="stream_name"> EN_ACT.html </li></ul></li>
<li title="item"><ul><li title="stream_name">no link</li></ul></li></ul>"""


def test_listing(spark):
    items = parse_listing(spark.createDataFrame([(1, LISTING)], "doc int, html string"), "html", ["doc"])
    assert rows(items, "pos", "url", "stream_name", "stream_order") == [
        (0, "http://x/1", "L_1_EN_annexe.html", 1), (1, "http://x/2?a=1&b=2", "EN_ACT.html", 999),
    ]
    assert rows(select_manifestation(items, "doc"), "url") == [("http://x/2?a=1&b=2",)]
    assert rows(select_annex(items, "doc"), "url") == [("http://x/1",)]
    only = items.filter("pos = 0")
    assert rows(select_manifestation(only, "doc"), "url") == [("http://x/1",)]  # all excluded: first listed


def test_notices(spark):
    ok = "<NOTICE><EXPRESSION><EXPRESSION_TITLE><VALUE> T </VALUE></EXPRESSION_TITLE></EXPRESSION><WORK><DATE_DOCUMENT><YEAR>2024</YEAR><MONTH>06</MONTH><DAY>13</DAY></DATE_DOCUMENT></WORK></NOTICE>"
    deep = f"<X><Y>{ok}</Y></X>"
    bad = ok.replace("06", "13")
    df = spark.createDataFrame([(0, ok), (1, deep), (2, bad), (3, "<broken"), (4, "<N/>"), (5, None)], "i int, x string")
    got = [(r["notice_title"], str(r["notice_date"])) for r in notice_fields(df, "x").orderBy("i").collect()]
    assert got == [(" T ", "2024-06-13"), (" T ", "2024-06-13"), (" T ", "None"), (None, "None"), (None, "None"), (None, "None")]


def test_filters(spark):
    import datetime
    df = spark.createDataFrame([("a", datetime.date(2020, 1, 1), "R"), ("b(01)", datetime.date(2020, 1, 2), "L")],
                               "celex_id string, date date, type string")
    assert rows(between_exclusive(df, "date", datetime.date(2020, 1, 1)), "celex_id") == [("b(01)",)]
    assert between_exclusive(df, "date", datetime.date(2020, 1, 1), datetime.date(2020, 1, 2)).count() == 0
    assert type_filter(df, []).count() == 2 and type_filter(df, ["R"]).count() == 1
    assert corrigenda_filter(df).count() == 1 and corrigenda_filter(df, include=True).count() == 2
    assert sectors(True, True, True) == ["3", "5", "0", "7"]
    tags = spark.createDataFrame([("a", "u1"), ("a", "u2"), ("b(01)", "u3")], "celex_id string, uri string")
    assert rows(concept_filter(df, tags, ["u1", "u2"]), "celex_id") == [("a",)]
    assert concept_filter(df, tags, []).count() == 2
    uris = spark.createDataFrame([("u3",)], "uri string")
    assert rows(concept_filter(df, tags, uris), "celex_id") == [("b(01)",)]
    assert concept_filter(df, tags, uris.limit(0)).count() == 2  # an empty table is an empty list


def test_review(spark):
    f = spark.createDataFrame([("a",), ("b",)], "uri string")
    r = spark.createDataFrame([("b",), ("c",), ("",)], "uri string")
    assert rows(S.review_diff(f, r), "uri", "status") == [("a", "removed"), ("b", "kept"), ("c", "added")]
    assert rows(S.apply_review(f, r), "uri") == [("b",), ("c",)]
    assert rows(S.apply_review(f, None), "uri") == [("a",), ("b",)]
    assert S.apply_review(f, r.limit(0)).count() == 0


def test_body_choices(spark):
    std = '<html><div id="rct_1"><p>x</p></div></html>'
    m = spark.createDataFrame([
        ("a", "main", "xhtml", std), ("a", "main", "html", std),
        ("b", "main", "xhtml", "<html><br><div id='rct_1'><p></html>"), ("b", "main", "html", std),
        ("f", "main", "xhtml", "<html><div id='rct_1'><p>A & B</i></html>"), ("f", "main", "html", std),
        ("c", "main", "xhtml", "<html/>"), ("d", "main", "xhtml", "<html/>"), ("d", "main", "html", "<p>none"),
        ("e", "main", "xhtml", "  "),
    ], M.MANIFESTATIONS)
    got = {r["celex_id"]: (tuple(r["own"]) if r["own"] else None, tuple(r["lent"]) if r["lent"] else None)
           for r in body_choices(m).collect()}
    assert got == {
        "a": (("xhtml", "standard"), ("xhtml", "standard")),
        "b": (("html", "standard"), ("html", "standard")),
        "f": (("xhtml", "standard"), ("xhtml", "standard")),  # repaired
        "c": (None, ("xhtml", None)),
        "d": (("html", None), ("html", None)),
    }


def test_running_sum_spreads_a_hot_key(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 5 + 1).alias("k"), "id")
    got = section_by_headings(df.repartition(4), ["k"], "id", F.col("id") % 3 == 0).collect()
    for k in range(6):
        seen, expected = sorted((r["id"], r["section"]) for r in got if r["k"] == k), 0
        for i, section in seen:
            expected += i % 3 == 0
            assert section == expected
    assert len(got) == 2000
    numbers = number_in_order(df, ["k"], "id").filter("k = 0").orderBy("id").collect()
    assert [r["number"] for r in numbers] == list(range(1, 1501))
