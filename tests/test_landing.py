"""Bodies as bytes: what cannot be decoded gives way to the next format."""

from pyspark.sql import functions as F

from lexspark.operators.resolve import resolve_html
from lexspark.plans.dataset import build_text_units
from lexspark.sources.landed import read_manifestation_files, read_manifestations
from tests.test_dataset import page, unit_rows

BAD = page("rct_1").replace("text", "teét").encode("latin-1")
GOOD = page("rct_2", "art_3").encode()


def test_files_that_are_not_utf8_give_way(spark, tmp_path):
    (tmp_path / "32016R0001.main.xhtml").write_bytes(BAD)
    (tmp_path / "32016R0001.main.html").write_bytes(GOOD)
    (tmp_path / "32016R0004R(01) x.main.html").write_bytes("é".encode())
    (tmp_path / "32016R0005.main.xhtml").write_bytes(b"")
    (tmp_path / "note.txt").write_bytes(b"\xff")
    got = read_manifestation_files(spark, str(tmp_path / "*"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("32016R0001", "main", "html", GOOD.decode()), ("32016R0001", "main", "xhtml", None),
        ("32016R0004R(01) x", "main", "html", "é")], key=str)
    ids = got.select("celex_id").distinct()
    assert [r[:3] for r in unit_rows(build_text_units(ids, got))] == [("32016R0001", 0, "2"), ("32016R0001", 1, "3")]
    assert {r[0]: r[1] for r in resolve_html(got).collect()}["32016R0001"] == GOOD.decode()


def test_parquet_bodies_of_bytes(spark, tmp_path):
    rows = spark.createDataFrame([("a", "main", "xhtml", bytearray(BAD)), ("a", "main", "html", bytearray(GOOD)), ("b", "main", "html", None)],
                                 "celex_id string, role string, fmt string, body binary")
    rows.write.parquet(str(tmp_path / "p"))
    got = {(r[0], r[2]): r[3] for r in read_manifestations(spark, str(tmp_path / "p")).collect()}
    assert got == {("a", "xhtml"): None, ("a", "html"): GOOD.decode(), ("b", "html"): None}
    assert read_manifestations(spark, str(tmp_path / "p")).filter(F.col("celex_id") == "a").count() == 2
