"""Helpers that keep joins and windows safe on large and uneven data."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
ROWS_PER_SALT = 10_000
ROWS_OUT_PER_SALT = 1_000_000
HOT_KEYS = 10_000
FILTER_BITS = 1 << 26
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash-partition by the keys into ``spark.sql.shuffle.partitions`` parts.
    The number is given on purpose: cutting a page costs far more than its bytes
    suggest, so adaptive merging of small partitions would leave cores idle."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when a bounded count shows the table is small;
    otherwise the planner is free to shuffle. For narrow key tables only."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def may_have_key(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Wide rows whose key may be among the keys, for any number of keys; the others are dropped in the task that reads
    them. A row may be let through wrongly, none is ever lost, so callers join on the key later.

    The keys set bits of one map of ``FILTER_BITS`` bits, whatever their number; its parts of 4 KB are what is broadcast,
    8 MB at the most. Nothing is counted or collected beforehand."""
    names = keys.columns
    spot = F.pmod(F.xxhash64(*names), F.lit(FILTER_BITS)) + 1
    bits = keys.select(spot.alias("_spot")).groupBy(F.bitmap_bucket_number("_spot").alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_spot")).alias("_bits")
    )
    placed = df.withColumn("_spot", spot).withColumn("_part", F.bitmap_bucket_number("_spot"))
    byte = F.expr("substring(_bits, cast(bitmap_bit_position(_spot) div 8 as int) + 1, 1)")
    held = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(_spot) % 8 as int))"))
    return placed.join(F.broadcast(bits), "_part").filter(held != 0).select(*df.columns)


def hot_keys(rows: DataFrame, keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(keys, _salts) of the keys that hold more than ``rows_per_salt`` rows and more than 1/HOT_KEYS of them all, so
    fewer than HOT_KEYS keys: a table that is safe to broadcast. For narrow rows that are written already."""
    floor = max(rows_per_salt, -(-rows.count() // HOT_KEYS))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > floor)
    return F.broadcast(sizes.select(*keys, F.ceil(F.col("_n") / F.lit(rows_per_salt)).cast("int").alias("_salts")))


def salted_join(
    many: DataFrame,
    other: DataFrame,
    key: str,
    spread: Sequence[str],
    how: str = "inner",
    rows_per_salt: int = ROWS_PER_SALT,
    rows_out: int = ROWS_OUT_PER_SALT,
) -> DataFrame:
    """Inner or left join on ``key`` where one key of ``many`` may hold a large
    share of all rows and ``other`` has several rows per key, so that the result
    of the hot key is many times its input. (Where ``other`` has one row per
    key a plain join will do: adaptive execution splits a hot partition.)

    A key is hot when it holds more than ``rows_per_salt`` rows of ``many`` and
    more than 1/HOT_KEYS of them all, or when its result is more than
    ``rows_out`` rows and more than 1/HOT_KEYS of the whole result; so there
    are never more than 2 * HOT_KEYS hot keys and their table is safe to
    broadcast. Hot keys are split into as many groups as both sizes ask for
    (never more than they have rows), and only their rows of ``other`` are
    repeated; nothing is repeated for the other keys. The group comes from a
    hash of the ``spread`` columns, so a re-run task gives the same groups.
    """
    sizes = many.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).join(
        other.groupBy(key).agg(F.count(F.lit(1)).alias("_k")), key, "left"
    ).withColumn("_made", F.col("_n") * F.coalesce("_k", F.lit(1)))
    sizes = materialize(sizes)  # a few numbers per key, used twice
    total = sizes.agg(F.sum("_n").alias("n"), F.sum("_made").alias("made")).collect()[0]
    floor = lambda least, whole: max(least, -(-(whole or 0) // HOT_KEYS))
    salts = F.least(F.col("_n"), F.greatest(
        F.ceil(F.col("_n") / F.lit(rows_per_salt)), F.ceil(F.col("_made") / F.lit(rows_out))
    ))
    hot = sizes.filter(
        (F.col("_n") > floor(rows_per_salt, total["n"])) | (F.col("_made") > floor(rows_out, total["made"]))
    ).select(key, salts.cast("int").alias("_salts"))
    hot = F.broadcast(hot)  # at most 2 * HOT_KEYS rows, see above
    left = many.join(hot, key, "left").withColumn(
        "_salt",
        F.pmod(F.xxhash64(*spread), F.coalesce("_salts", F.lit(1))).cast("int"),
    ).drop("_salts")
    right = other.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints. A folder of our own is
    used only when none is set and the session is local."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="lexspark-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared checkpoint folder and read them from
    there, where a result is used several times. For narrow tables.

    What was shuffled for it is not read again: those files go when the rows are
    written, not when the driver happens to collect its garbage, so the disk
    holds the shuffles of one step of a build, not of all."""
    spark = df.sparkSession
    checkpoint_folder(spark)
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        # a plan of its own: the setting counts where a plan is made, and later uses of df itself keep their shuffles
        return df.select("*").checkpoint()
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)


def number_rows(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """Consecutive numbers from 1 in the given order, without a global window.

    The rows are range-sorted, so even one hot key is spread over partitions,
    and written once (checkpoint), so both passes see the same partitions.
    Only one count per partition goes through the driver.
    """
    spark = df.sparkSession
    checkpoint_folder(spark)
    placed = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright(F.col("_place"), 33)
    counts = placed.groupBy(part.alias("part")).count().orderBy("part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((int(row["part"]), total))
        total += row["count"]
    table = spark.createDataFrame(offsets or [(0, 0)], "_part long, _offset long")
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(table), "_part")  # one row per partition
        .withColumn(name, F.col("_offset") + within + 1)
        .drop("_part", "_offset", "_place")
    )
