"""Query of the n-gram Jaccard join. Components have no SQL form; tests hold it against brute force."""

from __future__ import annotations

from lexspark.llm.common import read
from lexspark.llm.jaccard_join import near_duplicates
from lexspark.llm.queries import query


@query("op7_jaccard_join")
def op7(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))
