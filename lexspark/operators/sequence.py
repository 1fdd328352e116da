"""Ordered work inside a document, and small ordered previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexspark.operators.scale import materialize


def running(keys: Sequence[str], order: str):
    """From the start of the document up to this row."""
    return (
        Window.partitionBy(*keys).orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def latest(value: Column, w) -> Column:
    return F.last(value, ignorenulls=True).over(w)


def join_ordered(order: str, text: Column, sep: str) -> Column:
    """Aggregate: texts of a group joined in order; NULL texts are left out."""
    pairs = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct(F.col(order), text.alias("t")))))
    return F.array_join(F.transform(pairs, lambda x: x["t"]), sep)


def concat_ordered(
    df: DataFrame, keys: Sequence[str], order: str, text: str, sep: str = " ", name: str = "text"
) -> DataFrame:
    return df.groupBy(*keys).agg(join_ordered(order, F.col(text), sep).alias(name))


def running_sum(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """Sum of ``value`` from the first row of the key to this one; ``order`` is
    unique within a key.

    A key of any size is spread over tasks: the rows are range-sorted by
    (keys, order), summed within (partition, key), and each partition adds what
    earlier partitions hold of the key it begins with. Only that one key can
    reach over a partition's edge, so the table of carried sums has at most one
    row per partition and is safe to broadcast. The sorted rows are written once
    (checkpoint), so all steps see the same partitions.
    """
    placed = materialize(
        df.withColumn("_v", value.cast("bigint")).orderBy(*keys, order)
        .withColumn("_part", F.spark_partition_id())
    )
    local = F.sum("_v").over(running(["_part", *keys], order))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy("_part", *keys).agg(F.sum("_v").alias("_s"))
        .withColumn("_carry", F.sum("_s").over(earlier))
        .filter(F.col("_carry").isNotNull()).drop("_s")
    )
    return (
        placed.withColumn(name, local)
        .join(F.broadcast(carried), ["_part", *keys], "left")
        .withColumn(name, F.col(name) + F.coalesce("_carry", F.lit(0)))
        .drop("_part", "_v", "_carry")
    )


def number_in_order(df: DataFrame, keys: Sequence[str], order: str, name: str = "number") -> DataFrame:
    return running_sum(df, keys, order, F.lit(1), name)


def section_by_headings(
    rows: DataFrame, keys: Sequence[str], order: str, boundary: Column, name: str = "section"
) -> DataFrame:
    """Number of the latest boundary row at or before each row; 0 in front of
    the first boundary."""
    return running_sum(rows, keys, order, F.when(boundary, 1).otherwise(0), name)


def first_in_group(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    best = F.min_by(F.struct(*values), F.col(order))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def with_next(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """Values of the next row within a document (a document is one body)."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({f"next_{c}": F.lead(c).over(w) for c in cols})


def preview_ids(df: DataFrame, n: int = 10, col: str = "celex_id") -> DataFrame:
    """The first n ids in order, each with the number of ids left out."""
    ids = df.select(col).distinct()
    more = F.greatest(ids.agg(F.count(F.lit(1))).scalar() - n, F.lit(0))
    return ids.orderBy(col).limit(n).withColumn("n_more", more)


def preview_concepts(concepts: DataFrame, n: int = 5) -> DataFrame:
    """The first n concepts of each keyword and how many are left out.
    ``row_number <= n`` is cut down before the shuffle."""
    w = Window.partitionBy("keyword").orderBy("label", "uri")
    first = concepts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    counts = concepts.groupBy("keyword").agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("n_more"))
    return first.join(counts, "keyword")
