"""Which bodies are read, shuffled and cut, and who owns the rows of a stream."""

import dataclasses
import re

import pytest
from pyspark.sql import functions as F

from lexspark import model as M
from lexspark.operators import scale
from lexspark.operators.resolve import html_titles, resolve_html
from lexspark.plans.dataset import build_dataset, build_text_units
from lexspark.spec import JobSpec, ListSpec, OutputSpec, RelationSpec
from lexspark.streaming.incremental import build_incremental, current, stream_manifestations, write_batch
from tests.test_dataset import BODIES, LISTED, bodies, inputs, page, unit_rows  # noqa: F401


def test_key_filter_loses_nothing_and_drops_most(spark):
    rows = spark.range(40000).select(F.concat(F.lit("k"), "id").alias("a"), (F.col("id") % 7).alias("b"), F.lit("wide").alias("body"))
    keys = rows.filter("cast(substring(a, 2, 9) as int) % 20 = 0").select("a", "b")
    got = scale.may_have_key(rows, keys)
    assert got.columns == rows.columns
    assert keys.join(got, ["a", "b"], "left_anti").count() == 0
    assert 2000 <= got.count() <= 2050
    assert scale.may_have_key(rows, keys.limit(0)).count() == 0
    assert scale.may_have_key(rows, rows.select("a")).count() == 40000


def test_a_full_map_only_lets_more_through(spark, monkeypatch):
    monkeypatch.setattr(scale, "FILTER_BITS", 8)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("a"))
    assert scale.may_have_key(rows, rows.limit(500)).count() >= 500
    assert scale.may_have_key(rows, rows).count() == 1000


def exchanges_with_body(df):
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    parts = re.findall(r"\n\(\d+\) (Exchange|ReusedExchange)\n(?:Output|Input) \[\d+\]: \[([^\]]*)\]", plan)
    return [kind for kind, cols in parts if re.search(r"\b(body|html|_html|text)#", cols)]


def test_one_shuffle_of_bodies_for_any_number_of_ids(spark, bodies):
    many = spark.range(200_000).select(F.format_string("3%04dR%04d", (F.col("id") / 10000 + 1990).cast("int"), (F.col("id") % 10000).cast("int")).alias("celex_id"))
    ids = many.unionByName(bodies.select("celex_id"))
    assert exchanges_with_body(build_text_units(ids, bodies)) == ["Exchange"]
    assert exchanges_with_body(html_titles(bodies, ids)) == ["Exchange"]
    assert exchanges_with_body(resolve_html(bodies, ids)) == ["Exchange"]


def test_repeated_bodies_count_once(spark, bodies):
    ids = bodies.select("celex_id").distinct()
    once = unit_rows(build_text_units(ids, bodies))
    assert unit_rows(build_text_units(ids, bodies.unionByName(bodies).unionByName(bodies))) == once
    raw = resolve_html(bodies.unionByName(bodies), ids).collect()
    assert len(raw) == len({r[0] for r in raw}) == 5
    title = spark.createDataFrame(
        [("32016R0001", "main", "xhtml", '<html><div class="eli-main-title"><p>A title</p></div></html>')] * 2, M.MANIFESTATIONS)
    assert [tuple(r) for r in html_titles(title).collect()] == [("32016R0001", "A title")]


def test_of_different_bodies_of_one_key_one_counts_everywhere(spark, bodies):
    other = spark.createDataFrame([("32016R0001", "main", "xhtml", page("rct_4", "art_4")), ("32016R0001", "main", "xhtml", "")], M.MANIFESTATIONS)
    both = bodies.unionByName(other)
    got = [r for r in unit_rows(build_text_units(bodies.select("celex_id").distinct(), both)) if "0001" in r[0]]
    recitals = {r[0]: r[2] for r in got if r[1] == 0}
    articles = {r[0]: r[2] for r in got if r[1] == 1}
    assert recitals["32016R0001"] == recitals["02016R0001-20200101"] == articles["32016R0001"]
    raw = {r[0]: r[1] for r in resolve_html(both).collect()}
    assert f"text of art_{articles['32016R0001']}" in raw["32016R0001"]


def test_an_act_with_many_versions_is_dealt_over_salts(spark, monkeypatch):
    monkeypatch.setattr(scale.hot_keys, "__defaults__", (5,))
    rows = [("32016R0001", "main", "xhtml", page("rct_1", "rct_2", "art_1"))]
    rows += [(f"02016R0001-2020{m:02d}{d:02d}", "main", "html", page("rct_9", "art_7")) for m in range(1, 5) for d in range(1, 9)]
    df = spark.createDataFrame(rows, M.MANIFESTATIONS)
    got = unit_rows(build_text_units(df.select("celex_id"), df))
    assert len(got) == 3 + 32 * 3
    assert {r[2] for r in got if r[0].startswith("0") and r[1] == 0} == {"1", "2"}


OWNED = RelationSpec(include_original_act_relations=True)


@pytest.mark.parametrize("split, listed", [
    (["celex_id LIKE '3%'", "celex_id NOT LIKE '3%'"], LISTED),
    (["celex_id NOT LIKE '3%'", "celex_id LIKE '3%'"], LISTED),
    (["true", "celex_id LIKE '3%'"], ListSpec(celex_ids=frozenset({"02016R0001-20200101"}))),
])
def test_stream_relations_equal_batch_in_every_order(spark, inputs, bodies, tmp_path, split, listed):
    landing, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    spec = JobSpec(data=listed, relations=OWNED)
    empty = dataclasses.replace(inputs, manifestations=inputs.manifestations.limit(0))
    for part in split:
        bodies.filter(part).coalesce(1).write.mode("append").parquet(landing)
        build_incremental(stream_manifestations(spark, landing), empty, spec, out, cp).awaitTermination()
    whole = build_dataset(dataclasses.replace(inputs, manifestations=bodies), spec)["relations"]
    got = current(spark, out, "relations")
    assert got.columns == whole.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect())) and whole.count() >= 2
    write_batch(bodies.filter(split[-1]), len(split) - 1, empty, spec, out)
    assert current(spark, out, "relations").count() == whole.count()


def test_relations_of_a_document_built_again_are_withdrawn(spark, inputs, bodies, tmp_path):
    out = str(tmp_path / "out")
    spec = JobSpec(data=LISTED, relations=OWNED)
    write_batch(bodies, 0, inputs, spec, out)
    fewer = dataclasses.replace(inputs, relations=inputs.relations.filter("celex_target <> 'X'"))
    write_batch(bodies.filter("celex_id LIKE '0%'"), 1, fewer, spec, out)
    # the act itself was not built again, so its own row stays; the rows its version took over are gone
    assert sorted(map(tuple, current(spark, out, "relations").collect())) == [
        ("02016R0001-20200101", "32016R0001", "consolidates"), ("32016R0001", "X", "cites")]


def test_raw_text_of_the_build_is_unique(spark, inputs, bodies):
    twice = dataclasses.replace(inputs, manifestations=bodies.unionByName(bodies))
    spec = JobSpec(data=LISTED, output=OutputSpec(include_raw_full_text=True))
    works = [r[0] for r in build_dataset(twice, spec)["works"].collect()]
    assert len(works) == len(set(works)) == 3
