"""Decontamination against a brute-force search of all windows, and its stated cases."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from lexspark.llm import decontamination as D

G = r"[\x20\x09-\x0D]"
PUNCTUATION = r"""[.,;:!?()"'\[\]]*+"""


def words_of(text):
    """(type or None, word) of each canonical word, by single steps over the words of a text."""
    raw = regex.findall(r"[^\x20\x09-\x0D]+", text or "")
    out, before = [], ""
    for w in raw:
        bare = regex.sub(PUNCTUATION + r"\Z", "", w)
        name = bool(before) and regex.search(r"[\p{Ll}\p{N},;]\Z", before) and regex.match(r"\p{Lu}", w)
        kind = "name" if name else None
        low = bare.lower()
        if kind is None and regex.search(r"[0-9]\Z", before) and regex.match(r"(?:" + "|".join(D.UNITS) + r")(?![^.,;:!?])", w.lower()):
            kind = "unit"
        if kind is None and regex.search("[0-9]", low) and not regex.search(r"\p{L}", low):
            kind = "number"
        joined = out and kind == out[-1][0] and (
            (kind == "name" and not regex.search("[,;]", before)) or (kind == "number" and regex.search(r"[0-9]\Z", before) and w[0].isdigit()))
        if joined:
            out[-1] = (kind, out[-1][1] + " " + low)
        elif low:
            out.append((kind, low))
        before = w
    return out


def brute(doc, item, min_share=0.5):
    """(n_windows, n_item, verbatim) if the document leaks the item."""
    d, i = words_of(doc), words_of(item)
    n = min(D.WINDOW, len(i))
    if not n:
        return None
    plain = lambda ws: [k or w for k, w in ws]
    dt, it = plain(d), plain(i)
    good = [p for p in range(len(i) - n + 1) if 2 * sum(k is None for k, _ in i[p:p + n]) >= n]
    good = good or list(range(len(i) - n + 1))
    covered = lambda ps: len({q for p in ps for q in range(p, p + n)}) - n + 1
    shifts = {}
    for p in good:
        for q in range(len(d) - n + 1):
            if dt[q:q + n] == it[p:p + n]:
                places, slots = shifts.setdefault(q - p, (set(), set()))
                places.add(p)
                slots |= {(i[p + k][1], d[q + k][1]) for k in range(n) if i[p + k][0]}
    fits = lambda slots: len({a for a, _ in slots}) == len(slots)
    shifts = {s: v for s, v in shifts.items() if fits(v[1])}
    groups, last = [], None
    for s in sorted(shifts):
        if last is None or s - last > D.SLACK:
            groups.append((set(), set()))
        groups[-1][0].update(shifts[s][0])
        groups[-1][1].update(shifts[s][1])
        last = s
    found = [g for g in [*shifts.values(), *groups] if fits(g[1]) and covered(g[0]) >= min_share * covered(good)]
    if not found:
        return None
    return max(covered(g[0]) for g in found), covered(good), any(all(a == b for a, b in g[1]) for g in found)


QUESTION = "A train leaves Paris at 10 km from the old town and meets Rosa after 35 minutes while the second train waits there"
PLAIN = " ".join(f"word{chr(97 + k)}x" for k in range(22))


def frames(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return docs, spark.createDataFrame(items, "item_id long, text string")


def found(docs, bench):
    return {(r["doc_id"], r["item_id"]): (r["n_windows"], r["n_item"], r["verbatim"]) for r in D.leaks(docs, bench).collect()}


def test_inserted_changed_and_longer_slots_are_found(spark):
    split = PLAIN.split()
    inserted = " ".join(split[:11] + ["new"] + split[11:])
    changed = " ".join(split[:10] + ["new"] + split[11:])
    longer = QUESTION.replace("Paris", "New York City").replace("10 km", "5 000 km").replace("Rosa", "Ann Lee")
    wrapped = QUESTION.replace(" ", "\n")
    half = " ".join(split[:9])
    texts = [inserted, changed, longer, wrapped, half, "before it. " + PLAIN + " after"]
    docs, bench = frames(spark, texts, [(1, QUESTION), (2, PLAIN)])
    got = found(docs, bench)
    assert set(got) == {(0, 2), (1, 2), (2, 1), (3, 1), (5, 2)}
    assert got[0, 2] == (15, 15, True) and got[1, 2] == (14, 15, True) and not got[2, 1][2] and got[3, 1][2]


def test_equals_brute_force(spark):
    r = random.Random(5)
    vocabulary = ["alpha", "beta", "gamma", "delta", "Paris", "Rome", "New York", "5", "5 000", "12", "km", "kg", "the", "of", "end.", "so,", "a1", "€7", "(x)", "--"]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, prose(r.choice([1, 3, 5, 8, 9, 14, 25]))) for k in range(12)]
    texts = []
    for _ in range(60):
        words = r.choice(items)[1].split(" ")
        for _ in range(r.randrange(4)):
            k = r.randrange(len(words))
            words[k:k + r.randrange(2)] = [r.choice(vocabulary)]
        texts.append(prose(r.randrange(12)) + " " + " ".join(words) + r.choice(["", " ", "\n\n"]) + prose(r.randrange(12)))
    docs, bench = frames(spark, texts, items)
    want = {(d, k): b for d, t in enumerate(texts) for k, i in items if (b := brute(t, i))}
    assert len(want) > 30 and found(docs, bench) == want


def test_rows_without_ids_and_repeated_ids(spark):
    halves = PLAIN.split()
    first, second = " ".join(halves[:9]), " ".join(halves[13:])
    docs = spark.createDataFrame(
        [(None, PLAIN), (None, "a clean text without an id"), (None, first), (None, second), (7, first), (7, second), (8, QUESTION), (8, "clean"), (9, None), (10, "")],
        "doc_id long, text string").withColumn("doc_key", F.lit("x")).withColumn("_leaking", F.lit(1))
    bench = spark.createDataFrame([(None, PLAIN), (5, "an unlike text of this id that stands nowhere else at all"), (5, QUESTION), (5, None), (None, None)], "item_id long, text string")
    assert found(docs, bench).keys() == {(None, None), (8, 5)}
    clean = D.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in clean.collect()) == sorted(
        [("None", "a clean text without an id"), ("None", first), ("None", second), ("7", first), ("7", second), ("8", "clean"), ("9", "None"), ("10", "")])


@pytest.mark.parametrize("size", range(1, 9))
def test_every_window_holds_a_seed(size):
    step, length = D.seed_shape(size)
    for p in range(3 * size):
        assert any(q % step == 0 and q + length <= p + size for q in range(p, p + size))


def test_same_rows_without_broadcasts(spark, monkeypatch):
    docs, bench = frames(spark, [QUESTION, PLAIN + " x", "clean", PLAIN.replace("wordk", "w")], [(1, QUESTION), (2, PLAIN)])
    want = found(docs, bench)
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    shuffled = []
    join = D.broadcast_if_small
    monkeypatch.setattr(D, "broadcast_if_small", lambda df, *a: shuffled.append(df.columns) or (df if a else join(df)))
    assert found(docs, bench) == want
    assert ["size", "h"] in shuffled and ["item_key", "size", "item_pos", "h"] in shuffled
