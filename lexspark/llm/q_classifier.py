"""Query of the quality network. A learned score has no SQL form; tests hold it against held-out labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.llm.common import crc_of_id, read
from lexspark.llm.quality_model import ByteNet, score, training_rows
from lexspark.llm.queries import query

PER_CLASS = 1200
THRESHOLD = 0.7


@query("op3_quality_classifier")
def op3(spark, sf_dir):
    """A row without an id is neither held out nor learned from."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_of_id() % 4 == 2
    texts, labels, shift = training_rows(docs, read(spark, sf_dir, "labels"), "quality", ~held_out, PER_CLASS)
    return score(docs, ByteNet.fit(texts, labels, shift=shift)).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
