"""Query of benchmark decontamination. Its look-behind patterns have no form in the checking SQL; tests use brute force."""

from __future__ import annotations

from lexspark.llm.common import read
from lexspark.llm.decontamination import leaks
from lexspark.llm.queries import query


@query("op8_benchmark_decontamination")
def op8(spark, sf_dir):
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
