"""A build from graph facts alone, and the gram index of needles."""

import datetime

from pyspark.sql import functions as F

from lexspark import model as M
from lexspark.operators import graph as G
from lexspark.plans.dataset import build_dataset, select_ids
from lexspark.plans.graph_inputs import inputs_from_graph
from lexspark.spec import DiscoverSpec, JobSpec, ListSpec

DAY = datetime.date


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def facts():
    by_name = {v: k for k, v in M.RELATION_PREDICATES.items()}
    works = {"w1": ("32016R0001", "R", "3"), "w2": ("52015PC0002", "PC", "5"), "w3": ("32010L0003", "L", "3"), "w4": (None, "R", "3")}
    out = []
    for s, (celex, kind, sector) in works.items():
        out += [(s, M.P_TYPE, kind, None), (s, M.P_SECTOR, sector, None)]
        if celex:
            out.append((s, M.P_CELEX, celex, None))
    out += [("w1", M.P_DATE, "2016-05-01", None), ("w1", M.P_DATE, "2016-05-03", None), ("w2", M.P_DATE, "2015-01-01", None),
            ("w3", M.P_DATE, "not a date", None), ("w4", M.P_DATE, "2016-05-01", None)]
    for e, w, title, lang in (("e1", "w1", "Title b", "x/ENG"), ("e2", "w1", "Title a", "x/ENG"), ("e3", "w1", "Titre z", "x/FRA"),
                              ("e4", "w2", "Vorschlag", "x/DEU")):
        out += [(e, M.P_EXPRESSION_OF, w, None), (e, M.P_TITLE, title, None), (e, M.P_LANGUAGE, lang, None)]
    out += [("w1", by_name["cites"], "w3", None)] * 2
    out += [("w1", by_name["cites"], "w4", None), ("w4", by_name["cites"], "w1", None), ("w1", by_name["adopts"], "w2", None)]
    out += [("w1", M.P_CONCEPT, "u1", None), ("w3", M.P_CONCEPT, "u2", None), ("w4", M.P_CONCEPT, "u1", None)]
    out += [("w2", M.P_DOSSIER, "d1", None), ("d1", M.P_REFERENCE, "http://x/2015/0001/COD", None), ("d2", M.P_REFERENCE, "none", None)]
    out += [("u1", M.P_PREF_LABEL, "Data protection", "en"), ("u1", M.P_ALT_LABEL, "privacy", "en-GB"), ("u2", M.P_PREF_LABEL, "Daten", "de"),
            ("u1", M.P_IN_SCHEME, "s1", None)]
    return out


def inputs(spark):
    triples = spark.createDataFrame(facts(), "s string, p string, o string, lang string").repartition(3)
    return inputs_from_graph(triples, spark.createDataFrame([], M.MANIFESTATIONS), scheme="s1")


def test_inputs_from_graph(spark):
    got = inputs(spark)
    assert sorted(map(str, rows(got.properties, "celex_id", "title", "date", "type", "sector"))) == sorted(map(str, [
        ("32010L0003", None, None, "L", "3"),
        ("32016R0001", "Title b", DAY(2016, 5, 1), "R", "3"), ("32016R0001", "Title b", DAY(2016, 5, 3), "R", "3"),
        ("52015PC0002", None, DAY(2015, 1, 1), "PC", "5"),
    ]))
    assert rows(got.relations, "celex_source", "celex_target", "relation_type") == [
        ("32016R0001", "32010L0003", "cites"), ("32016R0001", "52015PC0002", "adopts")]
    assert rows(got.tags, "celex_id", "uri") == [("32010L0003", "u2"), ("32016R0001", "u1")]
    assert rows(got.dossiers, "ref", "proposal") == [("http://x/2015/0001/COD", "52015PC0002")]
    assert rows(got.adopts, "work", "proposal") == [("32016R0001", "52015PC0002")]
    assert rows(got.labels.filter("uri = 'u1'"), "label", "lang", "scheme", "kind") == [
        ("Data protection", "en", "s1", "pref"), ("privacy", "en-GB", "s1", "alt")]


def test_build_from_graph_only(spark):
    got = inputs(spark)
    by_number = JobSpec(data=ListSpec(procedure_numbers=frozenset({"2015/0001/COD"}), celex_ids=frozenset({"52015PC0002"})))
    tables = build_dataset(got, by_number)
    assert rows(tables["works"], "celex_id", "title", "date_adopted") == [
        ("32016R0001", "Title b", DAY(2016, 5, 3)), ("52015PC0002", "[Unavailable]", DAY(2015, 1, 1))]
    assert tables["relations"].count() == 2 and tables["text_units"].count() == 0
    # any of a work's dates lets it in
    between = DiscoverSpec(DAY(2016, 4, 1), DAY(2016, 5, 2), filter_keywords=frozenset({"PRIVACY"}))
    assert rows(select_ids(got, JobSpec(data=between)), "celex_id") == [("32016R0001",)]


def test_star_is_one_shuffle(spark):
    triples = spark.createDataFrame(facts(), "s string, p string, o string, lang string")
    plan = G.star_facts(triples)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_empty_graph(spark):
    triples = spark.createDataFrame([], "s string, p string, o string")
    got = inputs_from_graph(triples, spark.createDataFrame([], M.MANIFESTATIONS))
    assert build_dataset(got, JobSpec(data=ListSpec(celex_ids=frozenset({"32016R0001"}))))["relations"].count() == 0
    assert got.labels.count() == got.tags.count() == got.dossiers.count() == 0


def test_many_needles_are_a_table(spark):
    needles = [f"needle {i:06d} end" for i in range(100_000)] + ["", "ab", "İx", "Straße", "a"]
    texts = ["x NEEDLE 000123 END and Needle 099999 end", "needle 100000 end", "AB", "i̇X", "STRASSE", "straße", "", None, "needle 000123 en", "ab"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = G.contains_join(df, "t", needles, "needle", ignore_case=True)
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 100_000
    fold = {n: n.lower() for n in needles}
    want = sorted((i, n) for i, t in enumerate(texts) if t is not None for n in needles if fold[n] in t.lower())
    assert rows(got, "id", "needle") == want and len(want) > 15
    table = spark.createDataFrame([(n,) for n in needles[:200] + needles[-5:]] + [(None,), ("ab",)], "w string")
    want = sorted((i, n) for i, t in enumerate(texts) if t is not None for n in needles[:200] + needles[-5:] if n in t)
    assert rows(G.contains_join(df, "t", table, "needle"), "id", "needle") == want


def test_repeated_rows_stay(spark):
    df = spark.createDataFrame([("abc abc",), ("abc abc",)], "t string")
    assert rows(G.contains_join(df, "t", ["abc", "bc a"], "n"), "n") == [("abc",), ("abc",), ("bc a",), ("bc a",)]
