"""What a build reads more than once is computed once, and made inputs are spread."""

from __future__ import annotations

import datetime
import glob
import time

from pyspark.sql import functions as F

from catalog import inputs as I
from lexspark import model as M
from lexspark.operators.resolve import html_titles
from lexspark.operators.scale import CLEAN_SHUFFLES, materialize
from lexspark.plans.dataset import Inputs, build_dataset, unit_sources
from lexspark.plans.graph_inputs import inputs_from_graph
from lexspark.spec import JobSpec, ListSpec

PAGE = '<html><body><div id="rct_1"><p>a</p></div></body></html>'


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def orders(spark, tmp_path, n=20):
    spark.range(n).select(
        F.col("id").alias("o_orderkey"), F.lit(1).cast("bigint").alias("o_custkey"),
        F.lit(datetime.datetime(2001, 2, 3)).alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_bodies_are_parsed_once_for_all_choices(spark):
    ids = ["32001R0001", "02001R0001-20020101", "52001PC0002"]
    bodies = spark.createDataFrame(
        [(i, role, fmt, PAGE) for i in ids for role in ("main", "annex") for fmt in ("xhtml", "html")],
        "celex_id string, role string, fmt string, body string",
    )
    found = unit_sources(spark.createDataFrame([(i,) for i in ids], "celex_id string"), bodies)
    assert "body" not in plan(found)
    assert sorted((r["celex_id"], r["src_id"], r["role"], r["want"]) for r in found.collect()) == [
        ("02001R0001-20020101", "02001R0001-20020101", "main", 6), ("02001R0001-20020101", "32001R0001", "main", 1),
        ("32001R0001", "32001R0001", "main", 7), ("52001PC0002", "52001PC0002", "annex", 4), ("52001PC0002", "52001PC0002", "main", 3),
    ]


def test_notices_and_facts_are_read_once_by_a_build(spark):
    at = F.col("id").cast("string")
    notices = spark.range(2).select(
        F.concat(F.lit("32001R000"), at).alias("celex_id"), F.concat(F.lit("Notice "), at).alias("notice_title"),
        F.lit(datetime.date(2001, 1, 2)).alias("notice_date"),
    )
    facts = spark.range(1, 3).select(
        F.concat(F.lit("32001R000"), at).alias("celex_id"), F.when(F.col("id") == 1, "Graph").alias("title"),
        F.lit(datetime.date(2001, 3, 4)).alias("date"),
    )
    bodies = spark.createDataFrame([("32001R0002", "main", "html", PAGE)], "celex_id string, role string, fmt string, body string")
    ids = spark.createDataFrame([(f"32001R000{i}",) for i in range(3)], "celex_id string")
    job = JobSpec(data=ListSpec(celex_ids=frozenset({"32001R0001"})))
    works = build_dataset(Inputs(manifestations=bodies, properties=facts, notices=notices), job, ids)["works"]
    assert "Range" not in plan(works)
    assert [tuple(r) for r in works.orderBy("celex_id").select("title", "date_adopted").collect()] == [
        ("Notice 0", datetime.date(2001, 1, 2)), ("Graph", datetime.date(2001, 3, 4)), ("[Unavailable]", datetime.date(2001, 3, 4))]


def test_notices_are_spread(spark, tmp_path):
    found = I.notices(spark, orders(spark, tmp_path))
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found.count() == 20


def test_bodies_are_listed_behind_the_join_with_the_pages(spark, tmp_path):
    found = I.manifestations(spark, orders(spark, tmp_path))
    assert plan(found).index("Generate inline") < plan(found).index("Join ")
    assert found.groupBy("celex_id", "role", "fmt").count().filter("count > 1").isEmpty() and found.count() == 15 + 16 + 3


def test_shuffles_of_a_written_step_are_gone(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    before, set_before = files(), spark.conf.get(CLEAN_SHUFFLES)
    counted = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    written = materialize(counted)
    until = time.time() + 30
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(CLEAN_SHUFFLES) == set_before
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, counted.collect())) == [(k, 143 if k < 6 else 142) for k in range(7)]


def test_pages_are_pruned_before_they_are_shuffled(spark):
    page = '<html><body><div class="eli-main-title"><p>Act {}</p></div></body></html>'
    pages = spark.createDataFrame([(f"32001R000{i}", "main", "xhtml", page.format(i)) for i in range(4)], M.MANIFESTATIONS)
    wanted = spark.createDataFrame([("32001R0002",), ("32001R0002",), (None,), ("32001R0009",)], "celex_id string")
    found = html_titles(pages, wanted)
    assert "LeftSemi" not in plan(found)
    assert [tuple(r) for r in found.collect()] == [("32001R0002", "Act 2")]


def test_pages_are_shuffled_by_no_key_of_their_own(spark, tmp_path):
    found = I.manifestations(spark, orders(spark, tmp_path))
    assert plan(found).count("RepartitionByExpression") == 1
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    one = found.filter("celex_id = '31950R0003' and fmt = 'html'").collect()
    assert [(r["role"], r["body"][:46]) for r in one] == [("main", '<html><body><div class="eli-main-title"><p>Pag')]


def test_titles_are_written_once_by_a_build(spark):
    facts = spark.createDataFrame([("32001R0001", None, None)], "celex_id string, title string, date date")
    page = '<html><body><div class="eli-main-title"><p>Act of 3 March 2001</p></div></body></html>'
    bodies = spark.createDataFrame([("32001R0001", "main", "xhtml", page)], M.MANIFESTATIONS)
    job = JobSpec(data=ListSpec(celex_ids=frozenset({"32001R0001"})))
    works = build_dataset(Inputs(manifestations=bodies, properties=facts), job)["works"]
    assert "Generate" not in plan(works) and "Window" not in plan(works)
    assert [tuple(r) for r in works.select("title", "date_adopted").collect()] == [("Act of 3 March 2001", datetime.date(2001, 3, 3))]


def test_relations_of_a_graph_are_written_once(spark):
    by_name = {v: k for k, v in M.RELATION_PREDICATES.items()}
    ids = {"a": "32001R0001", "b": "32001R0001", "c": "32001R0002", "d": None}
    facts = [(s, M.P_CELEX, i) for s, i in ids.items() if i] + [("d", M.P_TYPE, "R")]
    edges = [("a", "c", "cites"), ("b", "c", "cites"), ("a", "c", "cites"), ("a", "c", "amends"), ("c", "d", "cites"), ("d", "c", "cites"), ("c", "b", "adopts")]
    triples = spark.createDataFrame(facts + [(s, by_name[r], o) for s, o, r in edges], "s string, p string, o string")
    got = inputs_from_graph(triples, spark.createDataFrame([], M.MANIFESTATIONS))
    assert "Join" not in plan(got.relations)
    assert sorted(map(tuple, got.relations.collect())) == [
        ("32001R0001", "32001R0002", "amends"), ("32001R0001", "32001R0002", "cites"), ("32001R0002", "32001R0001", "adopts")]
