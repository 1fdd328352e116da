"""Connected components of an edge table by alternating star steps (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import written


def _large(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(e: DataFrame) -> DataFrame:
    """e has b < a; every a hands its smaller neighbours, and itself, to the least of them."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.filter("a <> b").unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b), root the least node of its component. Each step is written to the
    shared folder; a hot node is combined before its shuffle and its join is split by adaptive execution. Repeated edges
    and loops do no harm; no edges give no rows."""
    top, low = F.greatest("a", "b"), F.least("a", "b")
    now = written(edges.filter("a <> b").select(top.alias("a"), low.alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).collect()[0]
        if tuple(mark) == seen or mark["n"] == 0:
            break
        seen = tuple(mark)
        now = written(_small(_large(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
