"""Query of suffix-array deduplication. It has no SQL form; tests hold it against brute force."""

from __future__ import annotations

from lexspark.llm.common import read
from lexspark.llm.queries import query
from lexspark.llm.suffix_dedup import removal_report


@query("op1_suffix_dedup")
def op1(spark, sf_dir):
    return removal_report(read(spark, sf_dir, "documents"))
