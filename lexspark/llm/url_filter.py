"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

The longest rule that fits decides. Urls that no rule fits are judged by boosted trees trained on urls that a rule does
decide (at most `max_rows` of them, those with the least hashes of url and id; a documented bound for fitting only).
Features: lengths, depth, digit ratio, entropy, parameter counts, and how often the host's last labels were blocked in
training. Judging is one pass over the urls, without a shuffle.

Defined cases: a null url, or one without `://`, has empty host and path, fits no rule and is judged by its features;
without labelled urls the trees allow everything; with one verdict in training they give that verdict; repeated rows are
judged alike; columns other than id and url are never read; urls of any length are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import broadcast_object

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
BINS = 32
BLOCK_AT = 0.7  # an open url is blocked only if the trees are that sure
FEATURES = (
    "url_length", "host_length", "path_length", "query_length", "host_labels", "depth", "digit_ratio", "host_digit_ratio",
    "entropy", "host_entropy", "parameters", "hyphens", "longest_label", "secure", "fragment", "top_blocked", "site_blocked",
)


def host_path(url: str | None) -> tuple[str, str]:
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return host.translate(LOWER), path


@dataclass
class Rules:
    """(host, path, verdict) rules; looked up by the suffixes of a host."""

    by_host: dict[str, list[tuple[str, str]]] = field(default_factory=dict)

    @classmethod
    def of(cls, rules) -> Rules:
        out = cls()
        for host, path, verdict in rules:
            out.by_host.setdefault(host, []).append((path, verdict))
        return out

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits; of equal rules the first given."""
        best, size = None, -1
        suffix = host
        while True:
            for rule_path, verdict in self.by_host.get(suffix, ()):
                if path.startswith(rule_path) and len(suffix) + len(rule_path) > size:
                    best, size = (suffix + rule_path, verdict), len(suffix) + len(rule_path)
            dot = suffix.find(".")
            if dot < 0:
                return best
            suffix = suffix[dot + 1:]


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


@dataclass
class Suffixes:
    """Smoothed share of blocked training urls by the last one and last two host labels."""

    prior: float = 0.0
    share: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def keys(host: str) -> tuple[str, str]:
        labels = host.split(".")
        return labels[-1], ".".join(labels[-2:]) + "/"

    @classmethod
    def fit(cls, hosts: list[str], blocked: np.ndarray, weight: float = 10.0) -> Suffixes:
        out = cls(float(blocked.mean()) if len(blocked) else 0.0)
        seen, bad = Counter(), Counter()
        for host, b in zip(hosts, blocked):
            for k in cls.keys(host):
                seen[k] += 1
                bad[k] += int(b)
        out.share = {k: (bad[k] + weight * out.prior) / (n + weight) for k, n in seen.items()}
        return out


def features(urls: list[str | None], suffixes: Suffixes) -> np.ndarray:
    x = np.zeros((len(urls), len(FEATURES)))
    for i, url in enumerate(urls):
        u = url or ""
        host, path = host_path(u)
        query = u.partition("#")[0].partition("?")[2]
        labels = host.split(".")
        top, site = Suffixes.keys(host)
        x[i] = (
            len(u), len(host), len(path), len(query), len(labels), path.count("/"),
            sum(c.isdigit() for c in u) / max(1, len(u)), sum(c.isdigit() for c in host) / max(1, len(host)),
            entropy(u), entropy(host), query.count("=") or bool(query), host.count("-"), max(map(len, labels)),
            u.startswith("https:"), "#" in u, suffixes.share.get(top, suffixes.prior), suffixes.share.get(site, suffixes.prior),
        )
    return x


@dataclass
class BoostedTrees:
    """Trees of depth `depth` as arrays in heap order: feature, threshold (go right if above), leaf values."""

    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    depth: int = 3

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, l2: float = 1.0) -> BoostedTrees:
        share = float(y.mean()) if len(y) else 0.0
        share = min(max(share, 1e-3), 1 - 1e-3)
        model = cls(math.log(share / (1 - share)), depth=depth)
        if len(set(y.tolist())) < 2:
            return model
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        codes = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
        z = np.full(len(y), model.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-z))
            g, h = p - y, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
            for level in range(depth):
                n, offset = 2**level, 2**level - 1
                best, choice = np.full(n, 1e-9), [None] * n
                for f, c in enumerate(cuts):
                    cell = (node - offset) * BINS + codes[:, f]
                    gs = np.bincount(cell, g, n * BINS).reshape(n, BINS).cumsum(axis=1)
                    hs = np.bincount(cell, h, n * BINS).reshape(n, BINS).cumsum(axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                    gain[:, len(c):] = 0
                    k = gain.argmax(axis=1)
                    for m in range(n):
                        if gain[m, k[m]] > best[m]:
                            best[m], choice[m] = gain[m, k[m]], (f, c[k[m]])
                for m, found in enumerate(choice):
                    if found:
                        feature[offset + m], threshold[offset + m] = found
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
            leaf = node - (2**depth - 1)
            value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + l2)
            model.trees.append((feature, threshold, value))
            z += value[leaf]
        return model

    def predict(self, x: np.ndarray) -> np.ndarray:
        z, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            z += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-z))


@dataclass
class UrlFilter:
    rules: Rules
    suffixes: Suffixes
    trees: BoostedTrees

    @classmethod
    def fit(cls, rules: Rules, labelled: list[tuple[str, str]]) -> UrlFilter:
        """labelled: (url, verdict)."""
        y = np.array([v == "block" for _, v in labelled], float)
        suffixes = Suffixes.fit([host_path(u)[0] for u, _ in labelled], y)
        x = features([u for u, _ in labelled], suffixes) if labelled else np.zeros((0, len(FEATURES)))
        return cls(rules, suffixes, BoostedTrees.fit(x, y))

    def judge(self, urls: list[str | None]) -> pd.DataFrame:
        parts = [host_path(u) for u in urls]
        found = [self.rules.match(h, p) for h, p in parts]
        verdict = np.array([m[1] if m else None for m in found], object)
        open_ = [i for i, m in enumerate(found) if m is None]
        if open_:
            p = self.trees.predict(features([urls[i] for i in open_], self.suffixes))
            verdict[open_] = np.where(p >= BLOCK_AT, "block", "allow")
        return pd.DataFrame({"host": [h for h, _ in parts], "path": [p for _, p in parts],
                             "rule": pd.Series([m[0] if m else None for m in found], dtype=object), "verdict": verdict})


def fit_filter(pages: DataFrame, rules: Rules, key: str = "page_id", max_rows: int = 20_000) -> UrlFilter:
    """Train on urls that a rule decides: those with the least hashes. Only about max_rows of them reach the driver."""
    shared = broadcast_object(pages.sparkSession, rules)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared()
        for pdf in batches:
            rows = [(u, h, own.match(*host_path(u))) for u, h in zip(pdf["url"], pdf["h"])]
            yield pd.DataFrame([(u, h, m[1]) for u, h, m in rows if m], columns=["url", "h", "verdict"])

    rows = pages.filter(F.col("url").isNotNull()).select("url", F.xxhash64("url", F.col(key).cast("string")).alias("h"))
    labelled = rows.mapInPandas(label, "url string, h long, verdict string")
    share = min(1.0, 1.2 * max_rows / max(1, labelled.count()))
    near = labelled.filter(F.col("h") <= F.lit(min(2**63 - 1, int(-(2**63) + 2**64 * share)))).collect()
    near = sorted(near, key=lambda r: (r["h"], r["url"]))[:max_rows]
    return UrlFilter.fit(rules, [(r["url"], r["verdict"]) for r in near])


def judge(pages: DataFrame, model: UrlFilter, key: str = "page_id") -> DataFrame:
    """key, host, path, rule, verdict of each url."""
    kind = pages.schema[key].dataType  # keys travel as text: pandas would make floats of long ones beside a null
    shared = broadcast_object(pages.sparkSession, model)  # rules given by the caller, and at most `rounds` small trees

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared()
        for pdf in batches:
            out = own.judge([None if u is None or u != u else u for u in pdf["url"]])
            out.insert(0, "k", pdf["k"].to_numpy())
            yield out

    rows = pages.select(F.col(key).cast("string").alias("k"), "url")
    return rows.mapInPandas(run, "k string, host string, path string, rule string, verdict string").withColumn("k", F.col("k").cast(kind)).withColumnRenamed("k", key)
