"""The mixing stage beside columns of its own names, and sources without tokens."""

from lexspark.llm import mixing


def test_columns_named_like_its_own_stay(spark):
    rows = [(i, "some words of a text", "ab"[i % 2], 90 + i, "b", i * 10) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int, block string, place int")
    got = mixing.mixed(docs, mixing.Target(repetition=1.0))
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == sorted(rows)


def test_a_source_without_tokens_is_left_out_of_any_budget(spark):
    for budget, epochs in ((None, 1.0), (5, 0.0), (10, 0.0), (500, 0.0)):
        plans = mixing.plans_for({"a": 10, "empty": 0}, mixing.Target(repetition=1.0), budget)
        assert {p.source: p.epochs for p in plans}["empty"] == epochs
