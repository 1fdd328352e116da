"""Whole builds: selection, units with borrowed parts, sinks, the stream."""

import dataclasses
import datetime

import pytest
from pyspark.sql import functions as F

from lexspark import model as M
from lexspark.operators import tables as T
from lexspark.operators.units import extract_units
from lexspark.plans.dataset import Inputs, build_dataset, build_text_units
from lexspark.sources.landed import read_manifestation_files, read_manifestations
from lexspark.spec import DiscoverSpec, ExtractionSpec, JobSpec, ListSpec, Metadata, OutputSpec, RelationSpec
from lexspark.streaming.incremental import build_incremental, current, stream_manifestations, write_batch


def page(*units):
    return "<html><body>" + "".join(f'<div id="{u}"><p>text of {u}</p></div>' for u in units) + "</body></html>"


BODIES = [
    ("32016R0001", "main", "xhtml", page("rct_1", "art_1", "anx_I")),
    ("02016R0001-20200101", "main", "html", page("rct_9", "art_7")),
    ("02016R0002-20200101", "main", "html", page("rct_5", "art_5")),  # original has no body
    ("52020PC0003", "main", "xhtml", page("rct_2", "anx_II")),
    ("52020PC0003", "annex", "xhtml", page("art_8", "anx_III")),
    ("32016R0004R(01)", "main", "xhtml", page("rct_1")),  # not a valid id
]


@pytest.fixture
def bodies(spark):
    return spark.createDataFrame(BODIES, M.MANIFESTATIONS)


def unit_rows(df):
    return sorted((r["celex_id"], r["type_rank"], r["number"], r["text"]) for r in df.collect())


def test_units_are_borrowed(spark, bodies):
    ids = bodies.select("celex_id").distinct()
    got = unit_rows(build_text_units(ids, bodies))
    assert got == [
        ("02016R0001-20200101", 0, "1", "text of rct_1"),
        ("02016R0001-20200101", 1, "7", "text of art_7"),
        ("02016R0002-20200101", 0, "5", "text of rct_5"),
        ("02016R0002-20200101", 1, "5", "text of art_5"),
        ("32016R0001", 0, "1", "text of rct_1"),
        ("32016R0001", 1, "1", "text of art_1"),
        ("32016R0001", 2, "I", "text of anx_I"),
        ("52020PC0003", 0, "2", "text of rct_2"),
        ("52020PC0003", 2, "III", "text of anx_III"),
    ]


def test_unit_types_off(spark, bodies):
    ids = bodies.select("celex_id").distinct()
    only = build_text_units(ids, bodies, ExtractionSpec(include_recitals=False, include_annexes=False))
    assert {r["type"] for r in only.collect()} == {"article"}
    assert build_text_units(ids, bodies, ExtractionSpec(False, False, False)).count() == 0


def test_bodies_are_shuffled_once_and_tokens_never(spark, bodies):
    docs = bodies.select("celex_id", F.lit("standard").alias("structure"), F.lit(7).alias("want"), "body")
    plan = extract_units(docs, ["celex_id"], "body")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    below = plan[plan.index("Exchange"):]
    assert "Generate" not in below and "Window" not in below
    assert plan.count("Window") > 5 and "BatchEvalPython" not in plan


PROPS = [
    ("32016R0001", "Graph title", datetime.date(2016, 5, 1), "R", "3"),
    ("02016R0001-20200101", None, None, "R", "0"),
    ("52020PC0003", None, None, "PC", "5"),
    ("32016R0004R(01)", "Corrigendum", datetime.date(2016, 5, 2), "R", "3"),
]
REL = [("32016R0001", "X", "cites"), ("32016R0001", "", "cites"), ("02016R0001-20200101", "32016R0001", "consolidates")]


@pytest.fixture
def inputs(spark, bodies):
    notices = spark.createDataFrame(
        [("52020PC0003", "Proposal of 3 March 2020", None)], "celex_id string, notice_title string, notice_date date"
    )
    return Inputs(
        manifestations=bodies,
        properties=spark.createDataFrame(PROPS, "celex_id string, title string, date date, type string, sector string"),
        relations=spark.createDataFrame(REL, "celex_source string, celex_target string, relation_type string"),
        notices=notices,
        tags=spark.createDataFrame([("32016R0001", "u1")], "celex_id string, uri string"),
        labels=spark.createDataFrame(
            [("u1", "Data protection", "en", "1"), ("u2", "x", "en", "1"), ("u2", "data", "fr", "1"), ("u2", "data", "en-GB", "2")],
            "uri string, label string, lang string, scheme string",
        ),
        scheme="1",
    )


LISTED = ListSpec(celex_ids=frozenset({" 32016r0001", "02016R0001-20200101", "52020PC0003"}))


def test_build_listed(spark, inputs):
    spec = JobSpec(data=LISTED, relations=RelationSpec(include_original_act_relations=True),
                   output=OutputSpec(include_raw_full_text=True))
    tables = build_dataset(inputs, spec)
    works = {r["celex_id"]: r for r in tables["works"].collect()}
    assert len(works) == 3
    assert works["32016R0001"]["title"] == "Graph title"
    consolidated = works["02016R0001-20200101"]
    assert consolidated["date_adopted"] == datetime.date(2016, 5, 1)  # of the original act
    assert consolidated["title"] == "[Unavailable]"
    assert consolidated["document_type"] == "consolidated regulation"
    assert works["52020PC0003"]["date_adopted"] == datetime.date(2020, 3, 3)  # out of the title
    assert works["52020PC0003"]["full_text_html"].startswith("<html>")
    rel = sorted(tuple(r) for r in tables["relations"].collect())
    assert rel == [
        ("02016R0001-20200101", "32016R0001", "consolidates"),
        ("32016R0001", "X", "cites"), ("32016R0001", "X", "cites"),
    ]


def test_build_discovered(spark, inputs):
    spec = JobSpec(data=DiscoverSpec(datetime.date(2016, 1, 1), datetime.date(2017, 1, 1), filter_keywords=frozenset({"DATA"})))
    tables = build_dataset(inputs, spec)
    assert [r["celex_id"] for r in tables["works"].collect()] == ["32016R0001"]
    assert tables["works"].collect()[0]["full_text_html"] is None
    assert tables["text_units"].count() == 3
    # no concept found is no concept filter, as without keywords
    between = (datetime.date(2016, 1, 1), datetime.date(2017, 1, 1))
    no_match = JobSpec(data=DiscoverSpec(*between, filter_keywords=frozenset({"zzz"})))
    assert build_dataset(inputs, no_match)["works"].count() == build_dataset(inputs, JobSpec(data=DiscoverSpec(*between)))["works"].count()


def test_missing_inputs_are_errors(inputs):
    keywords = JobSpec(data=DiscoverSpec(datetime.date(2016, 1, 1), datetime.date(2017, 1, 1), filter_keywords=frozenset({"data"})))
    numbers = JobSpec(data=ListSpec(procedure_numbers=frozenset({"2016/0001/COD"})))
    for spec, gone in ((keywords, "labels"), (keywords, "tags"), (numbers, "dossiers"), (numbers, "adopts")):
        with pytest.raises(ValueError):
            build_dataset(dataclasses.replace(inputs, **{gone: None}), spec)


def test_works_stay_unique(spark, inputs):
    twice = dataclasses.replace(
        inputs, properties=inputs.properties.unionByName(inputs.properties.withColumn("date", F.date_add("date", 1)))
    )
    ids = [r["celex_id"] for r in build_dataset(twice, JobSpec(data=LISTED))["works"].collect()]
    assert len(ids) == len(set(ids))


def test_export_and_append(spark, inputs, tmp_path):
    tables = build_dataset(inputs, JobSpec(data=LISTED))
    tables["text_units"] = T.with_ids(tables["text_units"], ["celex_id", "type_rank", "pos"]).select(
        "id", "type", "number", "title", "text", "celex_id"
    )
    tables["relations"] = T.with_ids(tables["relations"], ["celex_source", "celex_target", "relation_type"])
    written = T.export_dataset(tables, str(tmp_path / "out"))
    assert len(written) == 6
    for name, n in (("works", 3), ("text_units", 7), ("relations", 2)):
        for fmt in ("csv", "parquet"):
            assert T.read_table(spark, str(tmp_path / "out" / fmt / name), fmt).count() == n
    assert "full_text_html" not in T.read_table(spark, written[-1].replace("relations", "works"), "parquet").columns
    ids = [r["id"] for r in T.read_table(spark, written[-1].replace("relations", "text_units"), "parquet").orderBy("id").collect()]
    assert ids == list(range(1, 8))
    violations = T.check_constraints(tables).filter("n_violations > 0")
    assert violations.count() == 0
    path = str(tmp_path / "store")
    T.append(tables["relations"], path)
    T.append(tables["relations"].limit(0), path)
    T.append(tables["relations"], path)
    assert spark.read.parquet(path).count() == 4
    assert T.orphans(tables["text_units"], tables["works"]).count() == 0


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([('a "q", x\ny',)], "t string")
    T.write_table(df, str(tmp_path / "c"), "csv")
    assert T.read_table(spark, str(tmp_path / "c"), "csv").collect()[0]["t"] == 'a "q", x\ny'


def test_stats_without_works(spark):
    empty = spark.createDataFrame([], "celex_id string")
    assert tuple(T.dataset_stats(empty, empty, empty).collect()[0]) == (0, 0, 0, 0.0, 0.0)


@pytest.mark.parametrize("split", [
    ["celex_id LIKE '3%' OR celex_id LIKE '5%'", "celex_id NOT LIKE '5%'"],  # the rest, with one document again
    ["role = 'main' AND celex_id LIKE '0%'", "role = 'annex'", "role = 'main'"],  # original and main body last
])
def test_stream_equals_batch_in_any_split(spark, inputs, bodies, tmp_path, split):
    landing, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    spec = JobSpec(data=LISTED)
    empty = dataclasses.replace(inputs, manifestations=inputs.manifestations.limit(0))
    for part in split:
        bodies.filter(part).coalesce(1).write.mode("append").parquet(landing)
        build_incremental(stream_manifestations(spark, landing), empty, spec, out, cp).awaitTermination()
    whole = build_dataset(dataclasses.replace(inputs, manifestations=bodies), spec)
    for name, table in whole.items():
        got = current(spark, out, name).select(*table.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, table.collect())), name
    # a replayed batch changes nothing
    write_batch(bodies.filter(split[-1]), len(split) - 1, empty, spec, out)
    assert current(spark, out, "text_units").count() == whole["text_units"].count()


def test_read_files(spark, tmp_path):
    (tmp_path / "32016R0001.main.xhtml").write_text("<html>\nx</html>")
    (tmp_path / "32016R0001.annex.html").write_text("<p>a")
    (tmp_path / "readme.txt").write_text("no")
    got = read_manifestation_files(spark, str(tmp_path / "*"))
    assert sorted((r["celex_id"], r["role"], r["fmt"], r["body"]) for r in got.collect()) == [
        ("32016R0001", "annex", "html", "<p>a"), ("32016R0001", "main", "xhtml", "<html>\nx</html>"),
    ]
    got.write.parquet(str(tmp_path / "p"))
    assert read_manifestations(spark, str(tmp_path / "p")).count() == 2


def test_specs():
    day = datetime.date
    ok = ListSpec(celex_ids=frozenset({"32016r0679 "}), procedure_numbers=frozenset({"2023/0202(cod)"}))
    assert ok.celex_ids == {"32016R0679"} and ok.procedure_numbers == {"2023/0202/COD"}
    for bad in (
        lambda: ListSpec(), lambda: ListSpec(celex_ids=frozenset({"nope"})),
        lambda: ListSpec(procedure_numbers=frozenset({" 2023/0202/COD"})),
        lambda: DiscoverSpec(day(2020, 2, 1), day(2020, 1, 1)),
        lambda: DiscoverSpec(day(2020, 2, 1), day.today()),
        lambda: DiscoverSpec(day(2020, 1, 1), day(2020, 2, 1), document_types=frozenset({"x"})),
        lambda: DiscoverSpec("2020-01-01", day(2020, 2, 1)),
        lambda: OutputSpec(formats=frozenset({"xlsx"})),
    ):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(ValueError, match="AAA, BBB"):
        ListSpec(celex_ids=frozenset({"bbb", "aaa"}))
    assert DiscoverSpec(day(2020, 1, 1), day(2020, 1, 1)).type_codes == ["R", "L", "D"]
    assert JobSpec(data=ok).mode == "list" and JobSpec(data=ok).output.formats == {"csv", "parquet"}
    assert Metadata().version == "1.0"
