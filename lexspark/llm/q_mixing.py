"""Query of source mixing. The bisected exponent has no SQL form; tests hold the draw against brute force."""

from __future__ import annotations

from lexspark.llm.common import read
from lexspark.llm.mixing import Target, mixture
from lexspark.llm.queries import query

TARGET = Target(repetition=1.5)


@query("op4_mixing")
def op4(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    drawn = mixture(docs, TARGET).apply(docs.select("doc_id", "source"))
    return drawn
