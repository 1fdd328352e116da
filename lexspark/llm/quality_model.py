"""Byte-level convolutional network for text quality, in numpy.

A text's bytes are cut into chunks of `POSITIONS` filter positions; neighbouring chunks overlap by the filter width less
one, so the chunks cover every window of the whole text. Learned filters run over learned byte embeddings; each chunk
keeps each filter's maximum; mean, maximum and minimum over the chunks enter a small dense layer that gives one
probability. The maximum passes gradients to one window per chunk and filter only, so training steps are cheap.

Training takes at most `per_class` whole texts of each label (a documented bound for fitting only); scoring reads whole
texts. Defined cases: a null or empty text is one chunk of padding and gets a score like any other; without labelled
rows every score is 0.5, with one label it is that label; a row labelled twice counts once (its lower label); repeated
rows are scored alike; extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import broadcast_object, ragged, slices, texts_as_bytes

POSITIONS = 256
WIDTH = 5
EMBED = 6
FILTERS = 24
HIDDEN = 16
PAD = 256
CHUNKS_AT_ONCE = 1024


def chunks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes of all chunks (padded with PAD), and the index of each text's first chunk."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.r_[np.frombuffer(b"".join(texts), np.uint8).astype(np.int16), np.int16(PAD)]
    number = np.maximum(1, -(-np.maximum(lens - WIDTH + 1, 1) // POSITIONS))
    first = np.cumsum(number) - number
    begin = np.cumsum(lens) - lens
    start = np.repeat(begin, number) + ragged(np.zeros(len(texts), np.int64), number) * POSITIONS
    stop = np.repeat(begin + lens, number)
    at = start[:, None] + np.arange(POSITIONS + WIDTH - 1)
    return flat[np.where(at < stop[:, None], at, len(flat) - 1)], first


@dataclass
class ByteNet:
    embed: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    constant: float | None = None

    @classmethod
    def start(cls, seed: int = 3) -> ByteNet:
        r = np.random.default_rng(seed)
        g = lambda *shape, s: r.normal(0, s, shape).astype(np.float32)
        net = cls(
            g(PAD + 1, EMBED, s=0.5), g(WIDTH * EMBED, FILTERS, s=(WIDTH * EMBED) ** -0.5), np.zeros(FILTERS, np.float32),
            g(3 * FILTERS, HIDDEN, s=(3 * FILTERS) ** -0.5), np.zeros(HIDDEN, np.float32), g(HIDDEN, s=HIDDEN ** -0.5), np.zeros(1, np.float32),
        )
        net.embed[PAD] = 0
        return net

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.filter_bias, self.dense, self.dense_bias, self.out, self.out_bias]

    def pooled(self, codes: np.ndarray, where: bool = False):
        """Maximum of each filter in each chunk, and the position that has it."""
        best = np.empty((len(codes), FILTERS), np.float32)
        spot = np.empty((len(codes), FILTERS), np.int64) if where else None
        for a in range(0, len(codes), CHUNKS_AT_ONCE):
            e = self.embed[codes[a:a + CHUNKS_AT_ONCE]]
            n = len(e)
            flat = e.reshape(n, -1)
            windows = np.lib.stride_tricks.as_strided(
                flat, (n, POSITIONS, WIDTH * EMBED), (flat.strides[0], EMBED * flat.strides[1], flat.strides[1]))
            r = (windows.reshape(-1, WIDTH * EMBED) @ self.filters).reshape(n, POSITIONS, FILTERS)
            if where:
                spot[a:a + n] = r.argmax(axis=1)
                best[a:a + n] = np.take_along_axis(r, spot[a:a + n, None, :], 1)[:, 0]
            else:
                best[a:a + n] = r.max(axis=1)
        return np.maximum(best + self.filter_bias, 0), spot

    def head(self, pool: np.ndarray, first: np.ndarray):
        number = np.diff(np.r_[first, len(pool)])
        mean = np.add.reduceat(pool, first) / number[:, None].astype(np.float32)
        x = np.hstack([mean, np.maximum.reduceat(pool, first), np.minimum.reduceat(pool, first)])
        h = np.maximum(x @ self.dense + self.dense_bias, 0)
        return x, h, h @ self.out + self.out_bias[0]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        codes, first = chunks_of(texts)
        z = self.head(self.pooled(codes)[0], first)[2].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def gradients(self, codes: np.ndarray, first: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        pool, spot = self.pooled(codes, where=True)
        x, h, z = self.head(pool, first)
        dz = ((1 / (1 + np.exp(-z)) - y) / len(y)).astype(np.float32)
        dh = np.outer(dz, self.out) * (h > 0)
        dx = dh @ self.dense.T
        number = np.diff(np.r_[first, len(pool)])
        owner = np.repeat(np.arange(len(first)), number)
        d_mean, d_max, d_min = np.split(dx, 3, axis=1)
        dp = d_mean[owner] / number[owner, None].astype(np.float32)
        x_mean, x_max, x_min = np.split(x, 3, axis=1)
        dp += d_max[owner] * (pool == x_max[owner])
        dp += d_min[owner] * (pool == x_min[owner])
        dp *= pool > 0
        near = codes[np.arange(len(codes))[:, None, None], spot[:, :, None] + np.arange(WIDTH)]  # chunk, filter, offset
        e = self.embed[near].reshape(len(codes), FILTERS, WIDTH * EMBED)
        d_filters = np.einsum("ck,ckw->wk", dp, e)
        d_near = (dp[:, :, None] * self.filters.T[None]).reshape(-1, EMBED)
        d_embed = np.zeros_like(self.embed)
        np.add.at(d_embed, near.reshape(-1), d_near)
        d_embed[PAD] = 0
        return [d_embed, d_filters, dp.sum(axis=0), x.T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(keepdims=True)]

    @classmethod
    def fit(cls, texts: list[bytes], labels: np.ndarray, epochs: int = 14, batch: int = 24, rate: float = 0.006, shift: float = 0.0, seed: int = 3) -> ByteNet:
        net = cls.start(seed)
        if len(set(labels.tolist())) < 2:
            net.constant = float(labels[0]) if len(labels) else 0.5
            return net
        rng = np.random.default_rng(seed)
        weights = net.params()
        m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        step, steps = 0, epochs * -(-len(texts) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), batch):
                pick = order[a:a + batch]
                codes, first = chunks_of([texts[i] for i in pick])
                grads = net.gradients(codes, first, labels[pick].astype(np.float32))
                step += 1
                now = rate * (1 - 0.9 * step / steps)
                for w, g, mm, vv in zip(weights, grads, m, v):
                    mm += 0.1 * (g - mm)
                    vv += 0.001 * (g * g - vv)
                    w -= (now * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        net.out_bias = net.out_bias + np.float32(shift)
        return net


def training_rows(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int) -> tuple[list[bytes], np.ndarray, float]:
    """At most per_class labelled texts of each label: those with the least hashes of their id. Last, what to add to a
    logit learned on these rows so that it fits the label shares of all usable rows."""
    rows = (
        labels.filter(usable & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
        .select("doc_id", "y", F.xxhash64(F.col("doc_id").cast("string")).alias("h"))
    )
    limit, wanted, total = 2**63, F.lit(False), {}
    for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect():
        total[r["y"]] = r["n"]
        share = min(1.0, 1.2 * per_class / r["n"])
        wanted = wanted | ((F.col("y") == r["y"]) & (F.col("h") <= F.lit(min(limit - 1, int(-limit + 2 * limit * share)))))
    chosen: dict[int, list] = {}
    for r in sorted(rows.filter(wanted).collect(), key=lambda r: (r["h"], r["doc_id"])):
        mine = chosen.setdefault(r["y"], [])
        if len(mine) < per_class:
            mine.append((r["doc_id"], r["y"]))
    picked = [x for y in sorted(chosen) for x in chosen[y]]
    if not picked:
        return [], np.zeros(0, np.int64), 0.0
    table = docs.sparkSession.createDataFrame(picked, "doc_id long, y int")  # at most per_class rows of each label
    found = docs.select("doc_id", "text").join(F.broadcast(table), "doc_id").collect()
    found.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    ratio = lambda n: float(np.log(max(1, n.get(1, 0)) / max(1, n.get(0, 0))))
    shift = ratio(total) - ratio({y: len(rows) for y, rows in chosen.items()})
    return texts_as_bytes([r["text"] for r in found]), np.array([r["y"] for r in found], np.int64), shift


def score(docs: DataFrame, net: ByteNet, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of each row's whole text."""
    kind = docs.schema[key].dataType  # keys travel as text: pandas would make floats of long ones beside a null
    shared = broadcast_object(docs.sparkSession, net)  # a few thousand weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared()
        for pdf in batches:
            data = texts_as_bytes(pdf["t"])
            for a, b in slices([len(t) + POSITIONS for t in data], 1 << 22):
                yield pd.DataFrame({"k": pdf["k"].iloc[a:b], "score": own.scores(data[a:b])})

    return docs.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInPandas(run, "k string, score double").withColumn("k", F.col("k").cast(kind)).withColumnRenamed("k", key)
