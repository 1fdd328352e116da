"""Helpers that several operators use: the shared folder, text batches as bytes, ragged arrays."""

from __future__ import annotations

import pickle
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"  # what stands between two words


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Only a local session that has none
    (tests) gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lexspark-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows of df, written to the shared folder and read again; cuts the lineage."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Python workers get this many rows at once in the jobs run inside; long texts then need less memory on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def broadcast_object(spark: SparkSession, value: object) -> Callable[[], object]:
    """Send an object of bounded size to the workers; call the result there to get it."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def buckets_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_as_bytes(texts) -> list[bytes]:
    """UTF-8 of each text; null is the empty text. Unpaired surrogates cannot occur in a Spark string."""
    return [b"" if t is None or t != t else t.encode("utf-8") for t in texts]


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive [from, to) runs whose sizes sum to about `most` at the most; a larger item is a run of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indexes starts[0] .. starts[0]+lens[0]-1, then those of the next run, and so on."""
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scrambler of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def crc_of_id(col: str = "doc_id"):
    return F.crc32(F.col(col).cast("string"))
