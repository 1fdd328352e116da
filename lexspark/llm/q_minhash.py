"""Query of the b-bit MinHash. Components have no SQL form; tests hold it against brute force."""

from __future__ import annotations

from lexspark.llm.bbit_minhash import near_duplicates
from lexspark.llm.common import read
from lexspark.llm.queries import query


@query("op13_minhash")
def op13(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))
