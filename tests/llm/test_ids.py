"""Document ids stay exact beside nulls, in one batch of one task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm import bbit_minhash, jaccard_join, quality_rules, suffix_dedup, token_files
from lexspark.llm.language_id import LanguageModel, identify
from lexspark.llm.quality_model import ByteNet, score
from lexspark.llm.q_tokens import vocabulary
from lexspark.llm.token_counts import count_tokens
from lexspark.llm.url_filter import Rules, UrlFilter, judge

BIG = 2**53 + 1
IDS = [BIG, None, BIG + 2, -BIG, 7]
TEXTS = ["the first text of some words", "a text without an id", "the first text of some words", None, ""]


def langs():
    return LanguageModel.fit([b"the text of words", b"le texte des mots", b"der Text und Worte", b"el texto de palabras"] * 3, ["en", "fr", "de", "es"] * 3)


OPERATORS = {
    "op1": lambda d: suffix_dedup.removal_report(d),
    "op1_texts": lambda d: suffix_dedup.deduplicated(d),
    "op2": lambda d: token_files.token_digest(d, vocabulary()),
    "op3": lambda d: score(d, ByteNet.fit([b"good text", b"#!$ bad"] * 4, np.array([1, 0] * 4))),
    "op5": lambda d: quality_rules.judged(d),
    "op6": lambda d: judge(d.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://a.org/"), "text").alias("url")),
                           UrlFilter.fit(Rules.of((("org", "/", "allow"),)), [("http://b.com/x", "allow"), ("http://c.com/y", "block")] * 20)
                           ).withColumnRenamed("page_id", "doc_id"),
    "op7": lambda d: jaccard_join.near_duplicates(d),
    "op9": lambda d: identify(d, langs()),
    "op10": lambda d: count_tokens(d, vocabulary()),
    "op13": lambda d: bbit_minhash.near_duplicates(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_stay_exact_beside_nulls(spark, name):
    docs = spark.createDataFrame(list(zip(IDS, TEXTS)), "doc_id long, text string").coalesce(1)
    got = OPERATORS[name](docs)
    assert got.schema["doc_id"].dataType.simpleString() == "bigint"
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted(IDS, key=str)
    if "component_id" in got.columns:
        assert {r["component_id"] for r in got.filter(F.col("doc_id") == BIG + 2).collect()} == {BIG}
