"""N-gram Jaccard join with signature trees.

A text's set is its distinct word shingles as 64-bit hashes; texts with equal sets are one class from the start. Two sets
link if 100 * |A and B| >= 80 * |A or B|. All steps are exact but for equal 64-bit hashes of different shingles or sets:

1. Shared tokens. In hash order, linked sets share at least `EXTRA` percent of the smaller set among their first
   20 + `EXTRA` percent. So only those leading tokens are shuffled, packed per task and bucket, and classes that share
   too few of them with any other class go no further. The same test runs once more, stricter, on the sets left.
2. Clusters. Sets left are routed by their leading tokens; the sets of one token form a signature tree: nodes hold
   OR-combined bitmaps, the size range, and the largest excess of set size over bits. Two nodes cannot hold a link if
   bits in common plus the smaller excess are below the overlap that their least sizes need; a dual traversal drops
   such pairs, and pairs already connected. What remains connects sets into clusters that contain all links.
3. Links. The full sets of a cluster form a tree again; surviving pairs of different components are counted exactly.
   Components of the links are the result; no pair within a component is counted without need, none is emitted.

Hot groups: equal texts are combined per task before a shuffle; a token or cluster with more than `GROUP` sets is dealt
over a grid of cells in which every two of its sets meet once, so a task never holds more than two parts of it.

Defined cases: null text, or text without words: empty set, size 0, linked with nothing; fewer words than a shingle: the
whole sequence is one shingle; repeated rows and equal texts are one class; a component is named by its least doc_id;
a null doc_id is never the
name of a component that has another; extra columns are never read; texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import broadcast_object, mix64, slices, small_batches, texts_as_bytes, written
from lexspark.llm.components import components

SHINGLE = 5
EXTRA = 8  # percent
EXTRA_AGAIN = 30
BITS = 1024
GROUP = 2048
LEAF = 32
FAN = 8
PIECE = 1 << 20
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _letters() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and their inverses."""
    back = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, back, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Shingler:
    """Shingle sets of texts, hashed with arrays."""

    def __init__(self) -> None:
        self.letters = _letters()
        self.up, self.down = _powers(1 << 16)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        out: list[np.ndarray] = []
        for a, b in slices([len(t) + 1 for t in texts], PIECE):
            out += self._piece(texts[a:b])
        return out

    def _piece(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer((b"\n".join(texts) + b"\n").lower(), np.uint8)
        if len(data) > len(self.up):
            self.up, self.down = _powers(len(data) + PIECE)
        gap = _GAP[data]
        edge = np.flatnonzero(np.diff(np.r_[True, gap]))
        starts, ends = edge[::2], edge[1::2]
        sums = np.r_[np.uint64(0), np.cumsum(self.letters[data] * self.up[:len(data)])]
        words = mix64((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * _STEP)
        acc = words[:max(0, len(words) - SHINGLE + 1)].copy()
        for k in range(1, SHINGLE):
            acc = (acc ^ (acc >> np.uint64(29))) * _STEP + words[k:len(words) - SHINGLE + 1 + k]
        acc = mix64(acc)
        lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        stop = np.cumsum(lens)
        first = np.searchsorted(starts, np.r_[0, stop])
        out = []
        for i, j in zip(first[:-1], first[1:]):
            if j - i >= SHINGLE:
                out.append(np.unique(acc[i:j - SHINGLE + 1]))
            elif j > i:
                h = np.uint64(j - i)
                for w in words[i:j]:
                    h = mix64(np.array([h], np.uint64) * _STEP + w)[0]
                out.append(np.array([h], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def class_of(hashes: np.ndarray) -> int:
    """64-bit id of a set; signed, as Spark has it."""
    total = mix64(hashes * np.uint64(_BASE)).sum(dtype=np.uint64, keepdims=True)
    return int(mix64(total + np.array([len(hashes)], np.uint64) * _STEP).view(np.int64)[0])


def leading(hashes: np.ndarray, extra: int) -> np.ndarray:
    """The first tokens of a sorted set: what may differ in a link, one more, and `extra` percent."""
    n = len(hashes)
    return hashes[:n - -(-8 * n // 10) + max(1, -(-extra * n // 100))]


def least_shared(n: Column, extra: int) -> Column:
    """How many leading tokens a set of n must share: `extra` percent of the smallest set that can link to it."""
    return F.greatest(F.lit(1), F.ceil(n * F.lit(8 * extra) / F.lit(1000) - F.lit(1e-9)))


def signature(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, np.uint8)
    bits[(hashes % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.uint64)


class Joined:
    """Union by least root."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.up[at]
        while True:
            s = self.up[r]
            if (s == r).all():
                self.up[at] = r
                return r
            r = s


class SignatureTree:
    """Sets ordered by size, in leaves of LEAF; every node has bits, least and largest size, and largest excess."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray) -> None:
        self.bits, self.sizes = bits, sizes
        starts = np.arange(0, len(sizes), LEAF)
        excess = sizes - np.bitwise_count(bits).sum(axis=1)
        level = (np.bitwise_or.reduceat(bits, starts), np.minimum.reduceat(sizes, starts), np.maximum.reduceat(sizes, starts), np.maximum.reduceat(excess, starts))
        self.levels = [level]
        while len(level[1]) > 1:
            starts = np.arange(0, len(level[1]), FAN)
            level = (np.bitwise_or.reduceat(level[0], starts), np.minimum.reduceat(level[1], starts), np.maximum.reduceat(level[2], starts), np.maximum.reduceat(level[3], starts))
            self.levels.append(level)

    @staticmethod
    def may_link(level, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether nodes a (the larger sizes) and b of a level can hold a link."""
        bits, low, high, excess = level
        ok = 10 * high[b] >= 8 * low[a]
        common = np.zeros(len(a), np.int64)
        for s in range(0, len(a), 1 << 15):
            part = slice(s, s + (1 << 15))
            common[part] = np.bitwise_count(bits[a[part]] & bits[b[part]]).sum(axis=1)
        most = np.minimum(common + np.minimum(excess[a], excess[b]), np.minimum(high[a], high[b]))
        return ok & (9 * most >= 4 * (low[a] + low[b]))

    def leaf_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (a >= b) of leaves that may hold a link, nearest first."""
        a = b = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            ok = self.may_link(self.levels[depth], a, b)
            a, b = a[ok], b[ok]
            if depth:
                n = len(self.levels[depth - 1][1])
                step = np.arange(FAN)
                x = (a[:, None, None] * FAN + step[None, :, None] + 0 * step[None, None, :]).reshape(-1)
                y = (b[:, None, None] * FAN + step[None, None, :] + 0 * step[None, :, None]).reshape(-1)
                ok = (x < n) & (y < n) & (x >= y)
                a, b = x[ok], y[ok]
        order = np.lexsort((a, a - b))
        return a[order], b[order]

    def connect(self, joined: Joined, ids: np.ndarray, linked) -> None:
        """Dual traversal: joins ids of sets that link. linked(i, j) decides a surviving pair of tree positions."""
        n = len(self.sizes)
        own = np.bitwise_count(self.bits).sum(axis=1)
        for x, y in zip(*self.leaf_pairs()):
            i, j = np.arange(x * LEAF, min(n, (x + 1) * LEAF)), np.arange(y * LEAF, min(n, (y + 1) * LEAF))
            ri, rj = joined.roots(ids[i]), joined.roots(ids[j])
            if ri[0] == rj[0] and (ri == ri[0]).all() and (rj == rj[0]).all():
                continue
            common = np.bitwise_count(self.bits[i][:, None] & self.bits[j][None]).sum(axis=2).astype(np.int64)
            si, sj = self.sizes[i][:, None], self.sizes[j][None]
            most = np.minimum(si - own[i][:, None] + common, sj - own[j][None] + common)
            open_ = (9 * most >= 4 * (si + sj)) & (i[:, None] > j[None]) & (ri[:, None] != rj[None])
            score = np.where(open_, most / (si + sj), -1.0)
            while True:
                p, q = np.unravel_index(score.argmax(), score.shape)
                if score[p, q] < 0:
                    break
                if linked(int(i[p]), int(j[q])):
                    joined.join(int(ids[i[p]]), int(ids[j[q]]))
                    ri, rj = joined.roots(ids[i]), joined.roots(ids[j])
                    score[ri[:, None] == rj[None]] = -1
                else:
                    score[p, q] = -1


def _packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.uint64).tobytes()


def _words(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.uint64)


def _spread(tokens: np.ndarray, owners: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of one bucket each."""
    bucket = (tokens % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(np.r_[-1, bucket[order]]))
    for s, e in zip(edges, np.r_[edges[1:], len(order)]):
        yield int(bucket[order[s]]), tokens[order[s:e]], owners[order[s:e]]


def _tokens_by_bucket(sets: Iterator[tuple[list[int], list[np.ndarray]]], extra: int, buckets: int) -> Iterator[pd.DataFrame]:
    for ids, hashes in sets:
        first = {c: h for c, h in zip(ids, hashes) if len(h)}  # equal sets of a batch count once
        if not first:
            continue
        lead = [leading(h, extra) for h in first.values()]
        owners = np.repeat(np.array(list(first), np.int64).view(np.uint64), [len(x) for x in lead])
        rows = list(_spread(np.concatenate(lead), owners, buckets))
        yield pd.DataFrame({"bucket": [r[0] for r in rows], "tokens": [_packed(r[1]) for r in rows], "owners": [_packed(r[2]) for r in rows]})


def _shared_counts(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    """How many tokens of this partition's buckets a class shares with another, packed by a bucket of the classes; in
    bucket -1 the tokens of more than GROUP classes with their numbers of classes."""
    tokens, owners = [], []
    for pdf in batches:
        tokens += [_words(x) for x in pdf["tokens"]]
        owners += [_words(x) for x in pdf["owners"]]
    if not tokens:
        return
    t, o = np.concatenate(tokens), np.concatenate(owners)
    order = np.argsort(t)
    t, o = t[order], o[order]
    starts = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
    shared = np.minimum.reduceat(o, starts) != np.maximum.reduceat(o, starts)
    keep = np.repeat(shared, np.diff(np.r_[starts, len(t)]))
    t, o = t[keep], o[keep]
    if not len(t):
        return
    order = np.lexsort((o, t))
    t, o = t[order], o[order]
    new = np.r_[True, (t[1:] != t[:-1]) | (o[1:] != o[:-1])]
    t, o = t[new], o[new]
    cls, n = np.unique(o, return_counts=True)
    rows = [(k, _packed(c), _packed(m)) for k, c, m in _spread(cls, n.astype(np.uint64), buckets)]
    token, df = np.unique(t, return_counts=True)
    hot = df > GROUP
    if hot.any():
        rows.append((-1, _packed(token[hot]), _packed(df[hot])))
    yield pd.DataFrame(rows, columns=["bucket", "tokens", "owners"])


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(cls, n): totals of the packed counts."""
    got = [pdf for pdf in batches if len(pdf)]
    if got:
        cls = np.concatenate([_words(x) for pdf in got for x in pdf["tokens"]])
        n = np.concatenate([_words(x) for pdf in got for x in pdf["owners"]])
        names, at = np.unique(cls, return_inverse=True)
        yield pd.DataFrame({"cls": names.view(np.int64), "n": np.bincount(at, n).astype(np.int64)})


PACKED = "bucket int, tokens binary, owners binary"


def _buckets(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def class_table(docs: DataFrame) -> DataFrame:
    """(doc_id, n, cls) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for pdf in batches:
            sets = shingler.sets(texts_as_bytes(pdf["text"]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": [len(s) for s in sets], "cls": [class_of(s) for s in sets]})

    # ids travel as text: pandas would make floats of them beside a null
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id string, n long, cls long").withColumn("doc_id", F.col("doc_id").cast("long"))


def sharing(packs: DataFrame, classes: DataFrame, extra: int) -> tuple[DataFrame, DataFrame]:
    """Classes (cls, n, doc_id) that share enough leading tokens, and (token, n) of hot tokens."""
    buckets = _buckets(packs)
    classes_in = max(1, buckets // 4)  # a row per task and bucket of classes: keep them few
    counts = packs.repartition(buckets, "bucket").mapInPandas(lambda rows: _shared_counts(rows, classes_in), PACKED)
    counts = written(counts, "shared")
    per_class = counts.filter("bucket >= 0").repartition(buckets, "bucket").mapInPandas(_sums, "cls long, n long")
    per_class = per_class.withColumnRenamed("n", "_shared")
    kept = classes.join(per_class, "cls").filter(F.col("_shared") >= least_shared(F.col("n"), extra)).drop("_shared")
    hot = counts.filter("bucket < 0").mapInPandas(_unpacked, "token long, n long")
    return kept, hot


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for token, n in zip(pdf["tokens"], pdf["owners"]):
            yield pd.DataFrame({"token": _words(token).view(np.int64), "n": _words(n).view(np.int64)})


def _leading_of_docs(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()

        def sets():
            for pdf in batches:
                texts = texts_as_bytes(pdf["text"])
                for a, b in slices([len(t) for t in texts], 4 * PIECE):
                    found = shingler.sets(texts[a:b])
                    yield [class_of(s) for s in found], found

        yield from _tokens_by_bucket(sets(), EXTRA, buckets)

    return docs.select("text").mapInPandas(run, PACKED)


def _leading_of_sets(sets: DataFrame, extra: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _tokens_by_bucket(((pdf["cls"].tolist(), [_words(x) for x in pdf["hashes"]]) for pdf in batches), extra, buckets)

    return sets.select("cls", "hashes").mapInPandas(run, PACKED)


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, n, hashes) of the wanted classes, read from the text of each class's least document, or of any if none has an
    id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, done = Shingler(), set()
        for pdf in batches:
            rows = []
            for cls, s in zip(pdf["cls"], shingler.sets(texts_as_bytes(pdf["text"]))):
                if class_of(s) == cls and cls not in done:  # rows with one id may differ in text
                    done.add(cls)
                    rows.append((cls, len(s), _packed(s)))
            yield pd.DataFrame(rows, columns=["cls", "n", "hashes"])

    def own_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, done = Shingler(), set()
        for pdf in batches:
            rows = []
            for s in shingler.sets(texts_as_bytes(pdf["text"])):
                if len(s) and (cls := class_of(s)) not in done:
                    done.add(cls)
                    rows.append((cls, len(s), _packed(s)))
            yield pd.DataFrame(rows, columns=["cls", "n", "hashes"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = wanted.select(F.col("doc_id").alias("_least"), "cls")
    keyed = texts.filter("doc_id is not null").join(wanted.filter("_least is not null"), F.col("doc_id") == F.col("_least"))
    # a class without any id is known by its text only; its rows are not joined, so that null is no hot key
    alone = wanted.filter("_least is null").select("cls")
    nameless = texts.filter("doc_id is null").mapInPandas(own_sets, "cls long, n long, hashes binary").join(alone, "cls", "left_semi")
    return keyed.select("text", "cls").mapInPandas(run, "cls long, n long, hashes binary").unionByName(nameless.dropDuplicates(["cls"]))


def _cells(k: np.ndarray, part: np.ndarray) -> list[list[int]]:
    """Grid cells (r, c), r <= c, numbered r * k + c, that hold each part."""
    return [[min(p, c) * n + max(p, c) for c in range(n)] for n, p in zip(k.tolist(), part.tolist())]


def cluster_edges(sets: DataFrame, hot: DataFrame) -> DataFrame:
    """(a, b): classes that the signatures of a shared token's sets connect."""
    buckets = _buckets(sets)
    hot_parts = {r["token"]: int(-(-r["n"] // GROUP)) for r in hot.collect()}  # at most all tokens / GROUP rows
    shared_hot = broadcast_object(sets.sparkSession, hot_parts)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts_of = shared_hot()
        hot_tokens = np.sort(np.array(list(parts_of), np.int64).view(np.uint64))
        for pdf in batches:
            hashes = [_words(x) for x in pdf["hashes"]]
            lead = [leading(h, 0) for h in hashes]
            sizes = np.array([len(h) for h in hashes], np.int64)
            bits = [signature(h) for h in hashes]
            cls = pdf["cls"].to_numpy(np.int64)
            t = np.concatenate(lead) if lead else np.zeros(0, np.uint64)
            who = np.repeat(np.arange(len(lead)), [len(x) for x in lead])
            is_hot = np.isin(t, hot_tokens) if len(hot_tokens) else np.zeros(len(t), bool)
            rows = []
            for bucket, x, w in _spread(t[~is_hot], who[~is_hot].astype(np.uint64), buckets):
                w = w.astype(np.int64)
                used, at = np.unique(w, return_inverse=True)
                rows.append((bucket, 0, _packed(x), at.astype(np.uint32).tobytes(), cls[used].tobytes(), sizes[used].tobytes(), b"".join(bits[i].tobytes() for i in used)))
            for x, w in zip(t[is_hot], who[is_hot]):
                k = parts_of[int(np.array([x]).view(np.int64)[0])]
                part = int(mix64(np.array([cls[w]]).view(np.uint64))[0] % np.uint64(k))
                for cell in _cells(np.array([k]), np.array([part]))[0]:
                    bucket = int(mix64(np.array([x]) + np.array([cell], np.uint64) * _STEP)[0] % np.uint64(1 << 30))
                    rows.append((bucket, cell + 1, _packed(np.array([x])), np.zeros(1, np.uint32).tobytes(), cls[w:w + 1].tobytes(), sizes[w:w + 1].tobytes(), bits[w].tobytes()))
            yield pd.DataFrame(rows, columns=["bucket", "cell", "tokens", "owners", "cls", "sizes", "bits"])

    def connect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [row for pdf in batches for row in pdf.itertuples(index=False)]
        if not got:
            return
        cls = np.concatenate([np.frombuffer(r.cls, np.int64) for r in got])
        sizes = np.concatenate([np.frombuffer(r.sizes, np.int64) for r in got])
        bits = np.concatenate([np.frombuffer(r.bits, np.uint64) for r in got]).reshape(-1, BITS // 64)
        names, first, place = np.unique(cls, return_index=True, return_inverse=True)
        sizes, bits = sizes[first], bits[first]
        shift, token, who = 0, [], []
        for r in got:
            x = _words(r.tokens)
            token.append(x if not r.cell else mix64(x + np.array([r.cell], np.uint64) * _STEP))
            who.append(place[np.frombuffer(r.owners, np.uint32).astype(np.int64) + shift])
            shift += len(r.cls) // 8
        token, who = np.concatenate(token), np.concatenate(who)
        order = np.lexsort((sizes[who], token))
        token, who = token[order], who[order]
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        joined = Joined(len(names))
        for s, e in sorted(zip(starts.tolist(), [*starts[1:].tolist(), len(token)]), key=lambda x: x[0] - x[1]):
            if e - s < 2:
                break
            members = who[s:e]
            r = joined.roots(members)
            if (r == r[0]).all():
                continue
            members = np.unique(members)
            members = members[np.argsort(sizes[members], kind="stable")]
            SignatureTree(bits[members], sizes[members]).connect(joined, members, lambda i, j: True)
        r = joined.roots(np.arange(len(names)))
        moved = r != np.arange(len(names))
        yield pd.DataFrame({"a": names[moved], "b": names[r[moved]]})

    routed = sets.select("cls", "hashes").mapInPandas(
        route, "bucket int, cell int, tokens binary, owners binary, cls binary, sizes binary, bits binary")
    return routed.repartition(buckets, "bucket").mapInPandas(connect, "a long, b long")


def link_edges(sets: DataFrame, clusters: DataFrame) -> DataFrame:
    """(a, b): classes joined by exact links; clusters is (node, root)."""
    sized = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    k = F.ceil(F.col("size") / F.lit(GROUP)).cast("int")
    placed = clusters.join(sized.withColumn("k", k), "root").withColumn("part", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    c = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    placed = placed.withColumn("c", c).select(
        F.col("node").alias("cls"), "root", "part", (F.least("part", "c") * F.col("k") + F.greatest("part", "c")).alias("cell"))

    def connect(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("cls").sort_values(["n", "cls"])
        hashes = [_words(x) for x in pdf["hashes"]]
        sizes = pdf["n"].to_numpy(np.int64)
        names = pdf["cls"].to_numpy(np.int64)
        bits = np.array([signature(h) for h in hashes], np.uint64).reshape(-1, BITS // 64)
        joined = Joined(len(names))

        def linked(i: int, j: int) -> bool:
            common = len(np.intersect1d(hashes[i], hashes[j], assume_unique=True))
            return 100 * common >= 80 * (len(hashes[i]) + len(hashes[j]) - common)

        SignatureTree(bits, sizes).connect(joined, np.arange(len(names)), linked)
        r = joined.roots(np.arange(len(names)))
        moved = r != np.arange(len(names))
        return pd.DataFrame({"a": names[moved], "b": names[r[moved]]})

    return sets.join(placed, "cls").groupBy("root", "cell").applyInPandas(connect, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs."""
    with small_batches(docs.sparkSession):
        table = written(class_table(docs), "classes")
        classes = table.filter("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("doc_id"))
        left, _ = sharing(_leading_of_docs(docs, 4 * _buckets(docs)), classes, EXTRA)
        sets = written(sets_of(docs, left), "sets")
        again, hot = sharing(_leading_of_sets(sets, EXTRA_AGAIN, 4 * _buckets(docs)), sets.select("cls", "n"), EXTRA_AGAIN)
        sets = written(sets.join(again.select("cls"), "cls", "left_semi"), "sets")
        clusters = components(cluster_edges(sets, hot))
        roots = components(link_edges(sets, clusters))
    named = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = named.select("cls", "root").join(least, "root").select("cls", "component_id")
    found = table.join(of_class, "cls", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs with the least id of their component; repeated rows of it once, and all rows without an id."""
    found = near_duplicates(docs.filter("doc_id is not null"))
    keep = found.filter("doc_id = component_id").select("doc_id").distinct()
    kind = docs.schema["doc_id"].dataType
    keep = keep.select(F.col("doc_id").cast(kind).alias("doc_id"))
    one = docs.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return one.unionByName(docs.filter("doc_id is null"))
