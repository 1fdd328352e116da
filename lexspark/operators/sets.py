"""Set operations on ids and concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_ids(df: DataFrame, col: str = "celex_id") -> DataFrame:
    return df.select(col).distinct()


def union_ids(listed: DataFrame, resolved: DataFrame, col: str = "celex_id") -> DataFrame:
    return listed.select(col).union(resolved.select(col)).distinct()


def apply_review(fetched: DataFrame, reviewed: DataFrame | None) -> DataFrame:
    """The reviewed table replaces the fetched one; without a review
    (automated mode) the fetched concepts stay as they are."""
    return distinct_ids(fetched if reviewed is None else reviewed.filter(F.length("uri") > 0), "uri")


def review_diff(fetched: DataFrame, reviewed: DataFrame) -> DataFrame:
    """(uri, status): kept, removed or added by the review."""
    tag = lambda df, bit: df.select("uri").filter(F.length("uri") > 0).distinct().withColumn("bit", F.lit(bit))
    both = tag(fetched, 1).unionByName(tag(reviewed, 2)).groupBy("uri").agg(F.sum("bit").alias("bits"))
    return both.select(
        "uri",
        F.when(F.col("bits") == 3, "kept").when(F.col("bits") == 1, "removed").otherwise("added").alias("status"),
    )
