"""Query of the spelling variants. The checksums in it have no SQL form; tests hold it against brute force."""

from __future__ import annotations

from lexspark.llm.common import read
from lexspark.llm.queries import query
from lexspark.llm.spelling import spelling_variants


@query("op11_spelling_variants")
def op11(spark, sf_dir):
    return spelling_variants(read(spark, sf_dir, "documents"))
