"""Query of language identification. A learned prediction has no SQL form; tests hold it against labelled rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.llm.common import crc_of_id, read
from lexspark.llm.language_id import fit_languages, identify
from lexspark.llm.queries import query


@query("op9_language_id")
def op9(spark, sf_dir):
    """A row without an id is neither held out nor learned from."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_of_id() % 5 == 0
    model = fit_languages(docs, ~held_out)
    return identify(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
