"""b-bit MinHash against brute force."""

import random

import numpy as np
import pytest

from lexspark.llm import bbit_minhash as mh

SCHEMA = "doc_id long, text string, lang string, n long, cls long, sig binary, bands array<long>, key long, root long, x int, kept boolean"


def table(spark, texts, ids=None):
    rows = [((ids or range(len(texts)))[i], t, "en", 1, 2, b"s", [3], 4, 5, 6, True) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def shingles(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for gap in "\t\n\v\f\r":
        text = text.replace(gap, " ")
    w = [x for x in text.split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(texts, ids=None):
    ids = list(ids or range(len(texts)))
    sets = [shingles(t) for t in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    named = {}
    for i, d in enumerate(ids):
        if d is not None and sets[i]:
            named[root(i)] = min(d, named.get(root(i), d))
    out = []
    for i, d in enumerate(ids):
        c = named.get(root(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def prose(r, n):
    return [f"w{r.randrange(400)}" for _ in range(n)]


def corpus(seed):
    r = random.Random(seed)
    out = [None, "", " \t\n", "one", "ONE", "one two three", "é" * 9, "a b c d e", "a b c d e f"]
    for _ in range(12):
        base = prose(r, r.choice([8, 40, 120, 300]))
        out.append(" ".join(base))
        for _ in range(r.randint(0, 6)):
            w = list(base)
            for _ in range(r.choice([1, 1, 2, 3])):
                w[r.randrange(len(w))] = f"new{r.randrange(99)}"
            out.append(r.choice([" ", "\n", "  "]).join(w))
        out += [out[-1].upper()] * r.randint(0, 2)
    out += [" ".join(prose(r, 20000)), None]
    out[-1] = out[-2] + " tail"
    r.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    texts = corpus(seed)
    got = sorted((tuple(r) for r in mh.near_duplicates(table(spark, texts)).collect()), key=str)
    assert got == brute(texts) and sum(not r[3] for r in got) > 5


def test_copies_that_link_through_the_original_only(spark, monkeypatch):
    monkeypatch.setattr(mh, "TILE", 4)
    monkeypatch.setattr(mh, "HASHES", 500)
    monkeypatch.setattr(mh, "COLUMNS", 7)
    monkeypatch.setattr(mh, "HELD", 9)
    r = random.Random(7)
    base = prose(r, 100)
    texts = [" ".join(prose(r, 60)) for _ in range(3)]
    for i in range(25):
        w = list(base)
        w[4 + 3 * i] = f"other{i}"
        texts.append(" ".join(w))
    texts.append(" ".join(base))
    got = sorted((tuple(x) for x in mh.near_duplicates(table(spark, texts)).collect()), key=str)
    assert got == brute(texts) and sum(x[2] == 3 for x in got) == 26


def test_ids_stay_exact_beside_nulls_and_repeats(spark):
    big = 2**53 + 1
    r = random.Random(8)
    base = prose(r, 80)
    near = [*base[:40], "x", *base[41:]]
    texts = [" ".join(base), " ".join(near), " ".join(base), "lonely words", "lonely words", None, "", " ".join(prose(r, 30))]
    ids = [big, None, big + 2, None, None, None, big + 4, -7]
    df = table(spark, texts, ids)
    got = sorted((tuple(x) for x in mh.near_duplicates(df.coalesce(1)).collect()), key=str)
    assert got == brute(texts, ids)
    twice = sorted((tuple(x) for x in mh.near_duplicates(df.union(df)).collect()), key=str)
    assert twice == sorted(got * 2, key=str)


def test_empty_table(spark):
    assert mh.near_duplicates(table(spark, ["a"]).filter("false")).collect() == []
    assert [tuple(x) for x in mh.near_duplicates(table(spark, [None, ""])).orderBy("doc_id").collect()] == [(0, 0, 0, True), (1, 0, 1, True)]


def test_estimates_are_corrected_for_collisions():
    r = np.random.default_rng(3)
    found = {0.0: [], 0.5: [], 0.85: []}
    for share in found:
        for _ in range(60):
            n = 400
            both = round(2 * n * share / (1 + share))
            x = r.integers(0, 1 << 63, 2 * n - both, np.uint64)
            low = mh.minima([x[:n], x[n - both:]])
            sig = mh.signatures(low)
            found[share].append(mh.estimates(sig[:1], sig[1:])[0])
    for share, est in found.items():
        assert abs(np.mean(est) - share) < 0.025 and np.std(est) < 0.08
    assert mh.estimates(sig[:1], sig[:1])[0] == 1


def test_common_counts():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 300, k).astype(np.uint64)) for k in (1, 5, 100, 200, 250)]
    got = mh.common_counts(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(5) for j in range(5) if i != j)
