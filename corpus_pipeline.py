"""The corpus pipeline: documents in, token files out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. The
caller (here run) writes each result as Parquet and hands the reread table to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexspark.llm.common import read, written
from lexspark.llm.decontamination import clean_documents
from lexspark.llm.jaccard_join import one_of_each
from lexspark.llm.mixing import mixed
from lexspark.llm.q_mixing import TARGET
from lexspark.llm.q_tokens import vocabulary
from lexspark.llm.quality_rules import kept_documents
from lexspark.llm.token_files import token_digest


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ledger's current policy rejects go."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked shingle sets stays: the one with the least id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the temperature mixture takes it, at least once."""
    return mixed(docs, TARGET)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids written to bit-plane files and read back: place, length and checksum of every document."""
    return token_digest(docs, vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_output),
]

#: Connected components, the bisected exponent and the tokenizer have no SQL form; tests hold the operators against brute force, not yet run() as a whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
