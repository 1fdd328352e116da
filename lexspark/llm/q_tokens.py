"""Queries of token counts and of the token files. Neither has an SQL form; tests hold them against the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.llm.common import read
from lexspark.llm.queries import query
from lexspark.llm.token_counts import count_tokens
from lexspark.llm.token_files import token_digest

VOCABULARY = "byte_bpe_50k.json"
MAX_TOKENS = 512


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_token_counts")
def op10(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return count_tokens(docs, vocabulary()).withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


@query("op2_token_files")
def op2(spark, sf_dir):
    return token_digest(read(spark, sf_dir, "documents"), vocabulary())
