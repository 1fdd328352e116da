"""Language identification in two steps: first the family, then one-versus-one linear support vector machines inside it.

Features are counts of hashed byte n-grams (1 to 4 bytes of the lower-cased text, ends of words marked by their spaces),
square-rooted and scaled to unit length, so a text of any length is one vector. Training takes at most `per_language`
whole texts of each language (a documented bound for fitting only). The family of a language comes from a table that is a parameter; a language it does not
name is a family of its own.

Defined cases: a null text, or one without any letter, is `und` with score 0; with no labelled row at all every text is
`und`; with one language every text with a letter gets it; ties go to the language first in the alphabet; repeated rows
are predicted alike; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import broadcast_object, slices, texts_as_bytes

DIMS = 1 << 14
PIECE = 1 << 20
#: ISO 639-1 codes by family.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "pl", "ru", "sk", "uk"),
}
_MULT = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def counts_of(data: bytes) -> np.ndarray:
    """Hashed n-gram counts of one text; n-grams that cross a piece border of a very long text are counted too."""
    out = np.zeros(DIMS, np.float64)
    low = data.lower()
    for a in range(0, max(len(low), 1), PIECE):
        x = np.frombuffer(low[a:a + PIECE + 3], np.uint8).astype(np.uint32)
        own = min(PIECE, len(low) - a)
        h = np.zeros(len(x), np.uint32)
        for n in range(1, 5):
            m = len(x) - n + 1
            if m <= 0:
                break
            h = (h[:m] * _MULT[0] + x[n - 1:] + np.uint32(n)) * _MULT[1]
            g = h[:own] if m > own else h
            out += np.bincount((g ^ (g >> np.uint32(15))) & np.uint32(DIMS - 1), minlength=DIMS)
    return out


def vectors(texts: list[bytes]) -> np.ndarray:
    x = np.empty((len(texts), DIMS), np.float32)
    for i, t in enumerate(texts):
        x[i] = np.sqrt(counts_of(t))
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-9)


def separate(x: np.ndarray, y: np.ndarray, epochs: int = 12, c: float = 10.0, seed: int = 7) -> tuple[np.ndarray, float]:
    """Linear support vector machine (hinge loss) by dual coordinate descent; y is +1 or -1."""
    rng = np.random.default_rng(seed)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    alpha = np.zeros(len(x))
    norms = (x * x).sum(axis=1) + 1.0
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            grad = y[i] * (x[i] @ w + b) - 1
            new = min(max(alpha[i] - grad / norms[i], 0.0), c)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w += np.float32(step) * x[i]
                b += step
                alpha[i] = new
    return w, float(b)


@dataclass
class LanguageModel:
    """families: their languages in order. top: one machine per family (against the rest). pairs: (a, b) -> machine."""

    families: list[list[str]] = field(default_factory=list)
    top: list[tuple[np.ndarray, float]] = field(default_factory=list)
    pairs: dict[tuple[str, str], tuple[np.ndarray, float]] = field(default_factory=dict)

    @classmethod
    def fit(cls, texts: list[bytes], langs: list[str], families: dict[str, tuple[str, ...]] = FAMILIES) -> LanguageModel:
        family_of = {lang: name for name, members in families.items() for lang in members}
        groups: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            groups.setdefault(family_of.get(lang, lang), []).append(lang)
        model = cls([groups[k] for k in sorted(groups)])
        if not texts:
            return model
        x = vectors(texts)
        lang = np.array(langs, object)
        fam = np.array([family_of.get(v, v) for v in langs], object)
        names = sorted(groups)
        for k, name in enumerate(names):
            if len(names) == 1 or (len(names) == 2 and k == 1):
                model.top.append((np.zeros(DIMS, np.float32), 0.0) if len(names) == 1 else (-model.top[0][0], -model.top[0][1]))
            else:
                model.top.append(separate(x, np.where(fam == name, 1, -1)))
            members = groups[name]
            for i, a in enumerate(members):
                for b in members[i + 1:]:
                    rows = np.flatnonzero((lang == a) | (lang == b))
                    model.pairs[a, b] = separate(x[rows], np.where(lang[rows] == a, 1, -1))
        return model

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return ["und"] * len(texts), np.zeros(len(texts))
        x = vectors(texts)
        margins = np.column_stack([x @ w + b for w, b in self.top])
        pick = margins.argmax(axis=1)
        sure = 1 / (1 + np.exp(-4 * np.abs(margins.max(axis=1)))) if len(self.families) > 1 else np.ones(len(texts))
        out, score = [""] * len(texts), np.zeros(len(texts))
        for f, members in enumerate(self.families):
            rows = np.flatnonzero(pick == f)
            if not len(rows):
                continue
            votes, strength = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for i, a in enumerate(members):
                for j in range(i + 1, len(members)):
                    w, b = self.pairs[a, members[j]]
                    m = x[rows] @ w + b
                    votes[:, i] += m >= 0
                    votes[:, j] += m < 0
                    strength[:, i] += m
                    strength[:, j] -= m
            # votes decide, then the sum of margins, then the alphabet
            best = np.lexsort((-np.arange(len(members))[None, :].repeat(len(rows), 0), strength, votes), axis=1)[:, -1]
            margin = np.abs(strength[np.arange(len(rows)), best]) / max(1, len(members) - 1)
            inner = 1 / (1 + np.exp(-4 * margin)) if len(members) > 1 else np.ones(len(rows))
            for r, k, s in zip(rows, best, inner):
                out[r] = members[k]
                score[r] = s * sure[r]
        return out, np.clip(score, 0, 1)


def training_rows(docs: DataFrame, usable: Column, per_language: int) -> list:
    """At most per_language (text, lang) rows of each language: those with the least hashes of their id, so the choice
    does not depend on partitions. A threshold on the hash keeps what reaches the driver near that number."""
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.xxhash64(F.col("doc_id").cast("string")).alias("h"), "doc_id", F.col("text").alias("t"),
    )
    shares = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    limit = 2**63
    wanted = F.lit(False)
    for lang, n in shares.items():
        # expected number per_language; the cut below makes it exact
        top = int(-limit + 2 * limit * min(1.0, 1.2 * per_language / n)) if n > per_language else limit - 1
        wanted = wanted | ((F.col("lang") == lang) & (F.col("h") <= F.lit(min(top, limit - 1))))
    found: dict[str, list] = {}
    for r in sorted(rows.filter(wanted).collect(), key=lambda r: (r["h"], r["doc_id"] if r["doc_id"] is not None else -1, r["t"])):
        mine = found.setdefault(r["lang"], [])
        if len(mine) < per_language:
            mine.append((r["t"], r["lang"]))
    return [x for lang in sorted(found) for x in found[lang]]


def fit_languages(docs: DataFrame, usable: Column, per_language: int = 400, families: dict = FAMILIES) -> LanguageModel:
    rows = training_rows(docs, usable, per_language)
    return LanguageModel.fit([t.encode() for t, _ in rows], [lang for _, lang in rows], families)


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score of each row's whole text."""
    kind = docs.schema[key].dataType  # keys travel as text: pandas would make floats of long ones beside a null
    shared = broadcast_object(docs.sparkSession, model)  # some vectors of DIMS floats, whatever the input's size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared()
        for pdf in batches:
            letters = pdf["letters"].to_numpy()
            data = texts_as_bytes(pdf["t"])
            for a, b in slices([len(t) + DIMS * 4 for t in data], 1 << 24):
                lang, score = own.predict(data[a:b])
                ok = letters[a:b]
                yield pd.DataFrame({"k": pdf["k"].iloc[a:b], "lang_pred": np.where(ok, np.array(lang, object), "und"), "score": np.where(ok, score, 0.0)})

    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("string").alias("k"), t.alias("t"), t.rlike(r"\p{L}").alias("letters"))
    return rows.mapInPandas(run, "k string, lang_pred string, score double").withColumn("k", F.col("k").cast(kind)).withColumnRenamed("k", key)
