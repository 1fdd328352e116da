"""Incremental build: bodies arrive as files in micro-batches, in any split and order."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark import model
from lexspark.functions.ids import is_consolidated, is_valid_celex, original_celex
from lexspark.functions.text import decode_body
from lexspark.plans.dataset import Inputs, build_dataset, owned_relations, select_ids
from lexspark.spec import JobSpec

TABLES = {"works": "celex_id", "text_units": "celex_id", "relations": "owner"}
BODY_KEYS = ["celex_id", "role", "fmt"]


def stream_manifestations(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Bodies that land in a folder, as a stream; one that is not UTF-8 is NULL."""
    return (
        spark.readStream.schema(model.MANIFESTATIONS)
        .option("maxFilesPerTrigger", files_per_batch).parquet(path)
        .withColumn("body", decode_body(F.col("body")))
    )


def write_batch(batch: DataFrame, batch_id: int, inputs: Inputs, spec: JobSpec, out: str) -> None:
    """Take in the bodies of one micro-batch and rewrite the documents they touch.

    Bodies are kept under ``out/bodies``; of one (id, role, format) the latest
    batch counts. A batch touches its own ids and the consolidated texts whose
    original act arrived; those that the job selects and that have a main body
    are built anew from all bodies so far, ``inputs.manifestations`` included.
    Each batch writes folders of its own (batch=N) in overwrite mode, so a
    replayed batch replaces what it wrote. Every row carries the document that
    owns it (of a relation taken over from an original act the consolidated
    text), and ``versions`` names the documents of each batch: ``current`` reads
    of every owner what its latest batch wrote, so older rows are withdrawn.
    """
    spark = batch.sparkSession
    columns = [*BODY_KEYS, "body"]
    batch.select(*columns).write.mode("overwrite").parquet(f"{out}/bodies/batch={batch_id}")
    landed = spark.read.schema(f"{', '.join(f'{c} string' for c in columns)}, batch int").parquet(f"{out}/bodies")
    landed = landed.filter(F.col("batch") <= batch_id)
    touched = landed.filter(F.col("batch") == batch_id).select("celex_id").distinct()
    # narrow: which ids have a main body, and which batch has the body that counts
    before = inputs.manifestations.select(*columns, F.lit(-1).alias("batch"))
    every = landed.unionByName(before)
    latest = every.groupBy(*BODY_KEYS).agg(F.max("batch").alias("batch"))
    main = latest.filter(F.col("role") == "main").select("celex_id").distinct()
    versions = main.filter(is_consolidated(F.col("celex_id"))).withColumn("_original", original_celex(F.col("celex_id")))
    borrowing = versions.join(touched.withColumnRenamed("celex_id", "_original"), "_original", "left_semi").select("celex_id")
    wanted = select_ids(inputs, spec).select("celex_id").distinct()
    ids = touched.unionByName(borrowing).distinct().join(main, "celex_id", "left_semi").join(wanted, "celex_id", "left_semi")
    ids.write.mode("overwrite").parquet(f"{out}/versions/batch={batch_id}")
    ids = spark.read.schema("celex_id string").parquet(f"{out}/versions/batch={batch_id}")
    # only bodies of these documents and of their original acts are read further
    needed = ids.unionByName(ids.select(original_celex(F.col("celex_id")).alias("celex_id"))).distinct()
    bodies = every.join(needed, "celex_id", "left_semi").join(latest, [*BODY_KEYS, "batch"], "left_semi")
    bodies = bodies.filter(is_valid_celex(F.col("celex_id"))).select(*columns)
    tables = build_dataset(dataclasses.replace(inputs, manifestations=bodies), spec, ids)
    tables["relations"] = owned_relations(ids, inputs.relations, spec)
    for name in TABLES:
        tables[name].write.mode("overwrite").option("compression", "snappy").parquet(f"{out}/{name}/batch={batch_id}")


def current(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The table works, text_units or relations as of the last batch: of every
    document the rows of the latest batch that built it."""
    key = TABLES[name]
    rows = spark.read.option("mergeSchema", "true").parquet(f"{out}/{name}")
    built = spark.read.schema("celex_id string, batch int").parquet(f"{out}/versions")
    latest = built.groupBy(F.col("celex_id").alias(key)).agg(F.max("batch").alias("batch"))
    return rows.join(latest, [key, "batch"], "left_semi").drop("batch", "owner")


def build_incremental(
    stream: DataFrame, inputs: Inputs, spec: JobSpec, out: str, checkpoint: str
):
    """Run over all files that are there now, then stop; call it again (or from
    a schedule) to take in what arrived since."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, n: write_batch(batch, n, inputs, spec, out))
        .start()
    )
