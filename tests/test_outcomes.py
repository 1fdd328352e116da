"""Outcomes of the documents of a build, and exports that are whole or not there."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from lexspark.operators import tables as T
from lexspark.plans.dataset import build_dataset, checked_dataset
from lexspark.spec import JobSpec, ListSpec, OutputSpec, RelationSpec
from tests.test_dataset import LISTED, bodies, inputs  # noqa: F401


def test_one_bad_document_does_not_stop_the_build(spark, inputs):
    listed = dataclasses.replace(LISTED, celex_ids=LISTED.celex_ids | {"02016R0002-20200101"})  # has no date anywhere
    spec = JobSpec(data=listed, relations=RelationSpec(include_original_act_relations=True), output=OutputSpec(include_raw_full_text=True))
    more = spark.createDataFrame([("32016R0002", "Y", "cites"), ("02016R0002-20200101", "Z", "cites")], inputs.relations.schema)
    given = dataclasses.replace(inputs, relations=inputs.relations.unionByName(more))
    whole, got = build_dataset(given, spec), checked_dataset(given, spec)
    assert sorted(map(tuple, got["outcomes"].collect()), key=str) == [
        ("02016R0001-20200101", "successful", None), ("02016R0002-20200101", "failed", "no date"),
        ("32016R0001", "successful", None), ("52020PC0003", "successful", None)]
    assert [(r["celex_id"], r["reason"]) for r in got["rejected"].collect()] == [("02016R0002-20200101", "no date")]
    for name in ("works", "text_units"):
        assert got[name].columns == whole[name].columns
        assert sorted(map(str, got[name].collect())) == sorted(map(str, whole[name].filter("celex_id <> '02016R0002-20200101'").collect()))
    # neither its own relations nor those it takes over from its act
    assert got["relations"].filter("celex_target in ('Y', 'Z')").count() == 0
    assert got["relations"].count() == whole["relations"].count() - 2
    counts = {r["status"]: r["n"] for r in T.outcome_counts(got["outcomes"]).collect()}
    assert counts == {"successful": 3, "failed": 1}


def test_a_build_of_nothing_has_no_outcomes(spark, inputs):
    got = checked_dataset(inputs, JobSpec(data=LISTED), inputs.properties.limit(0))
    assert all(df.count() == 0 for df in got.values())


def counted(spark, tables):
    """The tables with a count of the rows that their plans made."""
    made = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    return {k: df.mapInArrow(note, df.schema) for k, df in tables.items()}, made


@pytest.mark.parametrize("formats", [{"csv", "parquet"}, {"csv"}])
def test_an_export_builds_every_table_once(spark, inputs, tmp_path, formats):
    tables = build_dataset(inputs, JobSpec(data=LISTED))
    tables, made = counted(spark, {k: tables[k] for k in T.EXPORTED})
    out = str(tmp_path / "out")
    T.export_dataset(tables, out, OutputSpec(formats=frozenset(formats)))
    assert made.value == 3 + 7 + 2
    for fmt in formats:
        assert [T.exported(spark, out, name, fmt).count() for name in T.EXPORTED] == [3, 7, 2]
    with pytest.raises(ValueError):
        T.exported(spark, out, "works", "parquet" if formats == {"csv"} else "orc")


def test_an_export_cut_short_shows_no_table(spark, inputs, tmp_path):
    tables = build_dataset(inputs, JobSpec(data=LISTED))
    broken = tables["relations"].withColumn("celex_target", F.raise_error(F.lit("lost")).cast("string"))
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="lost"):
        T.export_dataset({**tables, "relations": broken}, out)
    for name in T.EXPORTED:
        with pytest.raises(ValueError, match="no finished export"):
            T.exported(spark, out, name, "parquet")
