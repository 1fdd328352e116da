"""The dealt operators against brute force and the libraries, on small and odd inputs."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexspark.llm import decontamination, jaccard_join, mixing, quality_rules, suffix_dedup, token_files
from lexspark.llm.language_id import LanguageModel, fit_languages, identify
from lexspark.llm.quality_model import ByteNet, chunks_of, score, training_rows
from lexspark.llm.token_counts import Counter as TokenCounter
from lexspark.llm.token_counts import Merges, count_tokens
from lexspark.llm.url_filter import BoostedTrees, Rules, fit_filter, host_path, judge

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Extra columns with names that operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, `_row` string, n long, cls long, h long, words string"


def table(spark, texts, sources=None, langs=None):
    rows = [(i, t, (langs or ["en"] * len(texts))[i], (sources or ["a"] * len(texts))[i], 0, 1, "x", 2, 3, 4, "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def word(r):
    return "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))


def prose(r, n):
    return " ".join(word(r) for _ in range(n))


def corpus(seed=5, n=40):
    """Copies, near copies, shared passages, periodic and odd texts."""
    r = random.Random(seed)
    base = [prose(r, r.randint(5, 160)) for _ in range(n)]
    passage = prose(r, 60)
    out = list(base)
    for t in base[:12]:
        out += [t] * r.randint(1, 3)
    for t in base[5:25]:
        w = t.split()
        for _ in range(r.randint(1, max(1, len(w) // 50))):
            w[r.randrange(len(w))] = word(r)
        out.append(" ".join(w))
    out += [prose(r, 10) + "\n" + passage + "\n" + prose(r, k) for k in (3, 30, 80)]
    out += ["ab" * 300, "x" * 500, "x" * 120, "the " * 200, None, "", "   \n\t", "one", "one two three", "ONE two Three", "\u00e9" * 80, "a\x00" * 90, "\x00" * 150]
    r.shuffle(out)
    return out


# suffix-array deduplication


def brute_removed(texts, length=100):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        edge = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                edge[i] += 1
                edge[i + length] -= 1
            seen.add(s)
        gone = edge[:-1].cumsum() > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_equals_brute_force(spark):
    texts = corpus()
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.removal_report(table(spark, texts)).collect()}
    assert got == dict(enumerate(brute_removed(texts)))


def test_two_stage_sort_orders_all_windows():
    r = random.Random(2)
    parts = [bytes(r.choice(b"ab\x00") for _ in range(r.randint(100, 140))) for _ in range(60)] + [b"a" * 180, b"a" * 180]
    size = np.array([len(p) for p in parts])
    begin = np.cumsum(size + 1) - size - 1
    text = np.frombuffer(b"".join(p + b"\x00" for p in parts), np.uint8)
    number = size - 99
    order = suffix_dedup.two_stage_sort(text, begin, size, number)
    window = {int(b) + i: p[i:i + 100] for b, p, n in zip(begin, parts, number) for i in range(n)}
    ranked = [window[i] for i in order.tolist() if i in window]
    assert sorted(window) == sorted(i for i in order.tolist() if i in window)
    assert sum(a != b for a, b in zip(ranked, ranked[1:])) + 1 == len(set(ranked))  # equal windows are neighbours


def test_suffix_dedup_of_repeated_rows_and_ids(spark):
    t = prose(random.Random(1), 60)
    rows = spark.createDataFrame([(1, t), (1, t), (None, t), (2, "short")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in suffix_dedup.removal_report(rows).collect())
    assert got == [(-1, 0), (1, len(t)), (1, len(t)), (2, 0)]
    assert suffix_dedup.removal_report(rows.limit(0)).count() == 0
    assert {bytes(r["kept"]) for r in suffix_dedup.deduplicated(rows).collect()} == {t.encode(), b"", b"short"}


@pytest.mark.parametrize("batch", [1, 10000])
def test_suffix_dedup_keeps_equal_rows_of_several_batches_and_tasks(spark, batch):
    text = prose(random.Random(8), 80)
    rows = spark.createDataFrame(spark.sparkContext.parallelize([(1, text)] * 6, 3), "doc_id long, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = suffix_dedup.removal_report(rows).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [r["n_removed"] for r in got] == [0] * 6


def test_suffix_dedup_of_a_hot_line_with_other_neighbours(spark, monkeypatch):
    r = random.Random(6)
    line, passage = prose(r, 12)[:53], prose(r, 40)
    texts = [prose(r, 15) + line + prose(r, 15) for _ in range(60)] + [prose(r, 9) + line + passage + line + prose(r, 3) for _ in range(9)]
    texts += corpus()[:40] + ["x" * 700]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(61, texts[61])], "doc_id long, text string").repartition(3)
    sent, plain = [], type(rows).mapInPandas

    def spy(self, run, schema, *more, **named):
        out = plain(self, run, schema, *more, **named)
        sent.extend([out] * (schema == suffix_dedup.SEGMENTS))
        return out

    monkeypatch.setattr(type(rows), "mapInPandas", spy)
    monkeypatch.setattr(suffix_dedup, "HOT", 1024, raising=False)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.removal_report(rows).collect()}
    assert got == dict(enumerate(brute_removed(texts)))
    in_bucket = Counter()
    for r in sent[0].filter("bucket >= 0 and length(sizes) > 0").collect():
        size = np.frombuffer(r["sizes"], np.int64)
        for a, n in zip(np.cumsum(size) - size, size):
            in_bucket[int(suffix_dedup.segments([bytes(r["text"][a:a + n])])[3][0])] += int(n)
    assert in_bucket and max(in_bucket.values()) <= 1024


# token counts and files


def odd_texts():
    r = random.Random(1)
    out = ["", None, "a", "aaaaaaa", " a  b\n\n c ", "x<|endoftext|> y <|endoftext|><|endoftext|>", "\t\t a", "don't we'll I'VE", "12 345 ", "  ", "\n", "a\x1cb \x1c c", "w" * 4000]
    return out + ["".join(r.choice(" \n\tab'1\u00e9.!<|endoftext|>\u00a0") for _ in range(r.randint(1, 60))) for _ in range(400)]


def test_token_counts_equal_the_library(spark):
    texts = odd_texts()
    want = [len(e.ids) for e in Tokenizer.from_file(VOCABULARY).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert TokenCounter(Merges.from_json(VOCABULARY)).count([t or "" for t in texts]).tolist() == want
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in count_tokens(table(spark, texts), VOCABULARY).collect()}
    assert got == {i: (len((t or "").encode()), n) for i, (t, n) in enumerate(zip(texts, want))}


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 8192, 20001])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
    planes = token_files.chunk_planes(ids, bits)
    assert (token_files.chunk_ids(planes, n, 32 if bits else 4) == ids).all()


def test_token_files_round_trip(spark):
    texts = odd_texts()
    found = Tokenizer.from_file(VOCABULARY).encode_batch([t or "" for t in texts], add_special_tokens=False)
    want, start = {}, 0
    for i, e in enumerate(found):
        ids = np.array([*e.ids, 0], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r["doc_id"]: tuple(r)[1:] for r in token_files.token_digest(table(spark, texts), VOCABULARY).collect()}
    assert got == want
    assert token_files.token_digest(table(spark, ["a"]).limit(0), VOCABULARY).count() == 0


# n-gram Jaccard join


def brute_components(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(a), root(i)) for i, a in enumerate(sets)}


@pytest.mark.parametrize("group", [2048, 3])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(jaccard_join, "GROUP", group)  # 3: every token and cluster is dealt over a grid
    texts = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(table(spark, texts)).collect()}
    assert got == brute_components(texts)


def test_jaccard_join_links_through_a_row_without_id(spark):
    w = prose(random.Random(21), 200).split()
    end = lambda n: " ".join(w[:200 - n] + ["zz%d" % i for i in range(n)])
    left, middle, right = " ".join(w[:150]), " ".join(w[:170]), " ".join(w[:195])
    alone = end(60)
    rows = spark.createDataFrame([(1, left), (None, middle), (None, middle), (2, right), (3, alone)], "doc_id long, text string")
    got = Counter((r["doc_id"], r["component_id"]) for r in jaccard_join.near_duplicates(rows).collect())
    assert got == Counter({(1, 1): 1, (2, 1): 1, (None, 1): 2, (3, 3): 1})


def test_one_of_each_keeps_columns_and_rows_without_id(spark):
    t = prose(random.Random(4), 40)
    docs = table(spark, [t, t, "other words here", None])
    docs = docs.unionByName(docs.filter("doc_id = 0")).unionByName(docs.filter("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long")))
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 0), (False, 2), (False, 3), (True, 0)]
    assert jaccard_join.near_duplicates(docs.limit(0)).count() == 0


def test_signature_tree_loses_no_pair():
    r = np.random.default_rng(3)
    base = [np.unique(r.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)) for n in r.integers(5, 80, 40)]
    sets = [s for b in base for s in (b, b[r.random(len(b)) > 0.08])]
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets = [sets[i] for i in order]

    def linked(i, j):
        common = len(np.intersect1d(sets[i], sets[j]))
        return 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common)

    joined, plain = jaccard_join.Joined(len(sets)), jaccard_join.Joined(len(sets))
    tree = jaccard_join.SignatureTree(np.array([jaccard_join.signature(s) for s in sets]), np.array([len(s) for s in sets]))
    tree.connect(joined, np.arange(len(sets)), linked)
    for i in range(len(sets)):
        for j in range(i):
            if linked(i, j):
                plain.join(i, j)
    everything = np.arange(len(sets))
    assert joined.roots(everything).tolist() == plain.roots(everything).tolist()


# quality rules


def test_rule_ledger_measures(spark):
    long = prose(random.Random(8), 60)
    texts = [None, "", "a b c a b c", "x y\nx y\n \n\nx y", "#* $%&|<> ok", long, long.upper(), " ".join(w + "!!" for w in long.split()), "\u00e9\u00e9 \u00a0z"]
    got = {r["doc_id"]: r for r in quality_rules.judged(table(spark, texts)).collect()}
    assert [got[i]["n_words"] for i in range(5)] == [0, 0, 6, 6, 3]
    assert got[2]["n_repeat_words"] == 6 and got[3]["n_dup_lines"] == 2 and got[3]["n_repeat_words"] == 6 and got[4]["n_symbols"] == 8
    assert got[8]["word_chars"] == 4 and got[8]["n_words"] == 2
    assert [got[i]["kept"] for i in (5, 6, 7)] == [True, False, False] and not got[6]["base_failed"]
    entries = quality_rules.ledger(table(spark, texts))
    table_ = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality_rules.ablations(entries, "base").collect()}
    assert table_["few_words"][0] == 6
    assert quality_rules.kept_documents(table(spark, texts)).columns == table(spark, texts).columns
    assert [r["doc_id"] for r in quality_rules.kept_documents(table(spark, texts)).collect()] == [5]
    assert quality_rules.judged(table(spark, texts).limit(0)).count() == 0


# decontamination


def test_decontamination_finds_verbatim_and_reparameterised_items(spark):
    question = "A train leaves Paris at 10 km from the old town and meets Rosa after 35 minutes while the second train waits there"
    changed = question.replace("Paris", "Turin").replace("10 km", "99 km").replace("35", "48").replace("Rosa", "Bert")
    mixed_up = "he saw a train leaves Paris at 10 km from a new town"
    swapped = "Rob sold 5 apples to Ann and then 5 apples to Tom before noon on the way back home"
    bad_slots = "Rob sold 7 apples to Ann and then 8 apples to Tom before noon on the way back home"
    filler = prose(random.Random(9), 60)
    bench = spark.createDataFrame([(1, question), (2, swapped), (3, None), (4, ""), (5, "Tiny one")], "item_id long, text string")
    docs = table(spark, [filler + ". " + question + " " + filler, filler + "\n" + changed, mixed_up, filler, None, "", bad_slots, filler + " x tiny one y"])
    found = {(r["doc_id"], r["item_id"]): r["verbatim"] for r in decontamination.leaks(docs, bench).collect()}
    assert found == {(0, 1): True, (1, 1): False, (7, 5): True}
    clean = decontamination.clean_documents(docs, bench)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [2, 3, 4, 5, 6]
    assert decontamination.leaks(docs, bench.limit(0)).count() == 0 and decontamination.leaks(docs.limit(0), bench).count() == 0


# mixing


def test_exponent_meets_its_target():
    shares = [0.6, 0.3, 0.1]
    a = mixing.exponent_for(shares, mixing.Target(repetition=2.0))
    epochs = [w / p for w, p in zip(mixing.weights_at(shares, a), shares)]
    assert max(epochs) / min(epochs) == pytest.approx(2.0)
    a = mixing.exponent_for(shares, mixing.Target(entropy=1.0))
    assert -sum(w * np.log(w) for w in mixing.weights_at(shares, a)) == pytest.approx(1.0)
    assert mixing.exponent_for([0.5, 0.5], mixing.Target(repetition=1.0)) == 0.0
    assert mixing.exponent_for([], mixing.Target(repetition=1.0)) == 1.0


@pytest.mark.parametrize("budget", [None, 500, 3000])
def test_mixture_equals_brute_force(spark, monkeypatch, budget):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 60)
    r = random.Random(3)
    texts = [prose(r, r.randint(1, 20)) for _ in range(200)] + [None, ""]
    sources = [r.choice(["big"] * 6 + ["mid", None]) for _ in texts]
    docs = table(spark, texts, sources)
    mix = mixing.mixture(docs, mixing.Target(repetition=2.0), budget)
    got = Counter(row["doc_id"] for row in mix.apply(docs).collect())
    n = [len((t or "").split()) for t in texts]
    names = [s if s is not None else mixing.NO_SOURCE for s in sources]
    hashes = {(row["doc_id"], e): (row[f"b{e}"]) for row in docs.select(
        "doc_id", *[F.xxhash64(F.lit(12), F.lit(e), F.col("doc_id").cast("string")).alias(f"b{e}") for e in range(4)]).collect() for e in range(4)}
    block_hash = {row["doc_id"]: row["b"] for row in docs.select("doc_id", F.xxhash64(F.lit(11), F.col("doc_id").cast("string")).alias("b")).collect()}
    want = Counter()
    for plan in mix.plans:
        mine = [i for i in range(len(texts)) if names[i] == plan.source]
        full, left = int(plan.epochs), (plan.epochs - int(plan.epochs)) * plan.tokens
        blocks = defaultdict(list)
        for i in mine:
            blocks[block_hash[i] % plan.blocks].append(i)
        order = spark.createDataFrame([(b,) for b in blocks], "b int").select(
            "b", F.xxhash64(F.lit(12), F.lit(full), F.lit(plan.source), "b").alias("h")).orderBy("h", "b").collect()
        for i in mine:
            want[i] += full
        for row in order:
            inside = blocks[row["b"]]
            if left <= 0:
                break
            total = sum(n[i] for i in inside)
            if total <= left:
                for i in inside:
                    want[i] += 1
            else:
                used = 0
                for i in sorted(inside, key=lambda i: (hashes[i, full], str(i))):
                    if used >= left:
                        break
                    want[i] += 1
                    used += n[i]
            left -= total
    assert +got == +want
    if budget is None:
        assert set(got) == set(range(len(texts)))
    assert mixing.mixed(docs, mixing.Target(repetition=2.0), budget).columns == docs.columns
    assert mixing.mixed(docs.limit(0), mixing.Target(repetition=2.0)).count() == 0


# learned operators


def test_quality_network_learns_and_covers_whole_texts(spark):
    r = random.Random(6)
    texts = [prose(r, r.randint(20, 200)) for _ in range(60)] + [" ".join(w.upper() + "!!" for w in prose(r, r.randint(20, 200)).split()) for _ in range(60)]
    docs = table(spark, texts + [None, ""])
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)] + [(0, 1, 0)], "doc_id long, quality int, toxic int")
    x, y, shift = training_rows(docs, labels, "quality", F.col("doc_id") % 4 != 2, 40)
    assert len(x) == len(y) == 80 and shift == pytest.approx(0.0)
    got = {row["doc_id"]: row["score"] for row in score(docs, ByteNet.fit(x, y, epochs=8)).collect()}
    assert len(got) == 122 and all(0 <= s <= 1 for s in got.values()) and got[120] == got[121]
    assert np.mean([(got[i] >= 0.5) == (i < 60) for i in range(120) if i % 4 == 2]) > 0.9
    codes, first = chunks_of([b"z" * 1000, b"", b"q" * 256, b"q" * 261])
    assert first.tolist() == [0, 4, 5, 6] and len(codes) == 8
    assert ByteNet.fit([], np.zeros(0)).scores([b"a"]).tolist() == [0.5] and ByteNet.fit([b"a"], np.ones(1)).scores([b"b"]).tolist() == [1.0]


def test_network_gradients_are_right():
    net = ByteNet.start(1)
    for w in net.params():
        w[...] = w + np.random.default_rng(2).normal(0, 0.05, w.shape).astype(np.float32)
    net.embed[256] = 0
    codes, first = chunks_of([b"hello world", b"x" * 400 + b"some other text", b"abc"])
    y = np.array([1, 0, 1], np.float32)

    def loss():
        z = net.head(net.pooled(codes)[0], first)[2].astype(np.float64)
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    for w, g in zip(net.params()[1:], net.gradients(codes, first, y)[1:]):
        k = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, step = float(w[k]), 1e-3
        w[k] = keep + step
        up = loss()
        w[k] = keep - step
        down = loss()
        w[k] = keep
        assert (up - down) / (2 * step) == pytest.approx(float(g[k]), rel=0.1, abs=2e-3)


def test_language_id_in_two_steps(spark):
    say = {"en": "the house and the garden with this thing", "de": "das haus und der garten mit ein ding nicht", "fr": "la maison et le jardin avec une chose que", "es": "la casa y el jard\u00edn con una cosa que", "xx": "zok zuk zak zek"}
    r = random.Random(2)
    langs = [lang for lang in say for _ in range(30)]
    texts = [" ".join(r.choice(say[lang].split()) for _ in range(12)) for lang in langs]
    docs = table(spark, texts + [None, "", "12 34 !!"], langs=langs + ["en"] * 3)
    model = fit_languages(docs, F.col("doc_id") % 5 != 0, per_language=20)
    got = {row["doc_id"]: (row["lang_pred"], row["score"]) for row in identify(docs, model).collect()}
    assert [got[i] for i in (150, 151, 152)] == [("und", 0.0)] * 3
    assert np.mean([got[i][0] == langs[i] for i in range(150)]) > 0.95 and all(0 <= s <= 1 for _, s in got.values())
    assert LanguageModel.fit([], []).predict([b"abc"])[0] == ["und"] and LanguageModel.fit([b"abc"], ["en"]).predict([b"q"])[0] == ["en"]


# URL filter


def test_url_rules_and_trees(spark):
    rules = Rules.of([("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")])
    urls = ["http://A.Example.ORG/es/1?x=/fr/", "https://example.org/en/12", "https://notexample.org/en/12", "http://x.com/fr/a#b", "http://org", "ftp://a.org/",
            None, "no scheme", "http://", "https://www.x.com/de/9", "http://y.net/q?a=1&b=2", "http://com/de/"]
    pages = spark.createDataFrame([(i, u, None, "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, verdict string")
    got = {r["page_id"]: tuple(r)[1:] for r in judge(pages, fit_filter(pages, rules)).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[1][2] == "example.org/en/1" and got[2][2] == "org/"
    assert got[3] == ("x.com", "/fr/a", "com/fr/", "allow") and got[4][:3] == ("org", "", None) and got[5][2] == "org/"
    assert got[6][:3] == got[7][:3] == got[8][:3] == ("", "", None) and got[11][2] == "com/de/"
    assert all(v[3] in ("allow", "block") for v in got.values())
    assert host_path("x://h?a/b") == ("h", "") and judge(pages.limit(0), fit_filter(pages.limit(0), rules)).count() == 0
    x = np.random.default_rng(0).random((400, 17))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    assert np.mean((BoostedTrees.fit(x, y).predict(x) > 0.5) == y) > 0.95


# queries and pipeline


def test_pipeline_keeps_what_it_should(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(12)
    item = prose(r, 20)
    base = [prose(r, 80) for _ in range(6)]
    near = base[1].split()
    near[40] = "changed"
    texts = [*base, base[0], " ".join(near), base[2] + " " + item, "short", None]
    table(spark, texts, ["a", "b"] * 5 + ["a"]).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        left.append(sorted({row["doc_id"] for row in docs.collect()}))
    assert left == [[0, 1, 2, 3, 4, 5, 6, 7, 8], [0, 1, 2, 3, 4, 5] if 8 not in left[1] else [0, 1, 2, 3, 4, 5, 8], [0, 1, 2, 3, 4, 5], [0, 1, 2, 3, 4, 5], [0, 1, 2, 3, 4, 5]]
    want = {i: len(Tokenizer.from_file(VOCABULARY).encode(texts[i], add_special_tokens=False).ids) + 1 for i in range(6)}
    assert {row["doc_id"]: row["n_tokens"] for row in docs.collect()} == want
