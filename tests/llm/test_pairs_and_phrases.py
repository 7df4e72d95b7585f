"""Set similarity join, hard negatives and phrases against brute force, and their edge cases."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F, types as T

from kgspark.llm import common, hardneg, ngramjoin, phrases

DOCS = "doc_id long, text string, lang string, node string, token string, word string, label string"


def docs(spark, texts, ids=None, langs=None):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i if ids is None else ids[i], t, "en" if langs is None else langs[i], "x", None, "y", "z") for i, t in enumerate(texts)], DOCS)


# --- set similarity join -----------------------------------------------------------------

def brute_sets(texts, size):
    out = []
    for t in texts:
        w = [x for x in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x]
        out.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    return out


def brute_components(texts, ids, size, percent):
    sets, up = brute_sets(texts, size), list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        c = len(sets[a] & sets[b])
        if c and 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            up[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for k in range(len(texts)):
        if ids[k] is not None:
            low[find(k)] = min(low.get(find(k), ids[k]), ids[k])
    return sorted(((ids[k], len(sets[k]), low.get(find(k))) for k in range(len(texts))), key=repr)


def near_copies(seed, n=240):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.choice([3, 12, 40, 41, 90]))) for _ in range(n // 4)]
    while len(texts) < n:
        w = r.choice(texts).split()
        for _ in range(r.choice([0, 1, 1, 2, 5])):
            k = r.randrange(len(w) or 1)
            w[k:k + r.randint(0, 1)] = [r.choice(vocabulary)] * r.randint(0, 1)
        texts.append(" ".join(w or ["w1"]))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,percent,size", [(1, 90, 3), (2, 75, 2), (3, 60, 3)])
def test_join_equals_brute_force(spark, monkeypatch, seed, percent, size):
    monkeypatch.setattr(ngramjoin, "CHUNK", 7)  # buckets of many blocks
    monkeypatch.setattr(ngramjoin, "SMALL", seed + 1)
    monkeypatch.setattr(ngramjoin, "ROWS", 50)
    monkeypatch.setattr(ngramjoin, "NEAREST", 1)
    texts = near_copies(seed)
    got = ngramjoin.similarity_join(docs(spark, texts), percent=percent, size=size).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(texts, range(len(texts)), size, percent)


def test_join_edge_cases(spark):
    long = " ".join(f"word{k}" for k in range(30_000))
    texts = [None, "", " \t\n", "a b", "A  B", "a", "b a", "one two three four", "ONE two\nthree\x0bfour", long, long + " end", "ä Ä", "Ä ä", "one two three four", "x\x1fy z w", "no id here at all", "no id there at all either"]
    ids = [0, 1, 2, 13, 12, 5, 6, 30, 20, 9, 8, 10, 11, 30, None, None, None]
    got = ngramjoin.similarity_join(docs(spark, texts, ids)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(texts, ids, 3, 90)
    found = {r.doc_id: r for r in got}
    assert found[13].component_id == 12 and found[30].component_id == 20 and found[9].component_id == 8
    assert (found[0].n_shingles, found[0].component_id) == (0, 0)
    assert ngramjoin.similarity_join(docs(spark, [])).count() == 0
    assert {r.component_id for r in ngramjoin.similarity_join(docs(spark, [None, ""])).collect()} == {0, 1}


def test_prefix_and_bounds_lose_nothing(spark):
    """Both filters are exact: they pass every linked pair, at the threshold too."""
    r = random.Random(4)
    for _ in range(200):
        n, cut = r.randint(1, 60), r.choice([60, 75, 90, 100])
        a = set(r.sample(range(80), n))
        b = set(a)
        for _ in range(r.randint(0, 4)):
            (b.discard if r.random() < 0.5 else b.add)(r.randrange(80))
        linked = bool(b) and 100 * len(a & b) >= cut * len(a | b)
        hashes = {x: np.uint64(0x9E3779B97F4A7C15 * (x + 1) % (1 << 64)) for x in range(80)}
        one, two = (np.sort(np.array([hashes[x] for x in s], np.uint64)) for s in (a, b or {1}))
        p, q = one[:ngramjoin.prefix_size(len(one), cut)], two[:ngramjoin.prefix_size(len(two), cut)]
        if linked:
            both = np.intersect1d(p, q)
            assert len(both)
            at = [int(np.flatnonzero(x == both[0])[0]) for x in (p, q)]
            import pyarrow as pa
            t = pa.table({"n": [len(one), len(two)], "at": at, "held": [True, False], "node": [0, 1], "label": [0, 1], "asks": [True, True], "bits": [ngramjoin.parity(one), ngramjoin.parity(two)]})
            assert len(ngramjoin._Rows(t, cut).near(np.array([0]), np.array([1]))[0]) == 1


def test_a_large_group_of_near_copies_gives_few_pairs(spark, monkeypatch):
    """600 near copies of one text: links grow with the group, not with its square."""
    r = random.Random(9)
    base = [f"b{k}" for k in range(120)]
    texts = []
    for k in range(600):
        w = list(base)
        for _ in range(r.randint(1, 2)):
            w[r.randrange(120)] = f"edit{k}"
        texts.append(" ".join(w))
    seen, keep = [], ngramjoin._verified
    monkeypatch.setattr(ngramjoin, "_verified", lambda pairs, *a: seen.append(pairs.count()) or keep(pairs, *a))
    got = ngramjoin.similarity_join(docs(spark, texts)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(texts, range(600), 3, 90)
    assert sum(seen) < 600 * 40


def test_similarity_join_hands_texts_over_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        ngramjoin.similarity_join(docs(spark, ["a b c d", "a b c d"]))
        assert int(spark.conf.get(key)) <= common.BATCH_ROWS
    finally:
        spark.conf.set(key, before)


# --- hard negatives ----------------------------------------------------------------------

VECS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                     T.StructField("row", T.StringType()), T.StructField("score", T.StringType()), T.StructField("dim", T.StringType())])


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], VECS)


def brute_negatives(rows, positives=5, negatives=10, low=30, high=90):
    ok = [(k, i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for k, (i, v, lab) in enumerate(rows)
          if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, i, v, lab in ok:
        if i is None or i % 100:
            continue
        every = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m, other) for m, j, w, other in ok if m != k and len(w) == len(v)))
        for s, none, j, _, _ in [x for x in every if x[4] == lab][:positives]:
            inside = [x for x in every if x[4] != lab and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(i, None if none else j, n + 1, None if x[1] else x[2], -s, -x[0]) for n, x in enumerate(inside)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_negatives_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(hardneg, "BLOCK_VALUES", 64)  # many blocks of rows and anchors
    monkeypatch.setattr(hardneg, "BLOCK_ANCHORS", 2)
    r = random.Random(seed)
    rows = [(r.randrange(0, 900, r.choice([1, 50, 100])), [r.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) + r.choice([0, 0.001]) for _ in range(4)], r.randrange(3)) for _ in range(260)]
    rows += [(100, [0.0] * 4, 1), (100, [0.0] * 4, 1), (7, [0.0] * 4, 1), (8, [0.0] * 4, 2)]  # a positive of score 0 and a negative of score 0
    got = hardneg.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got), key=repr) == brute_negatives(rows) and got


def test_negatives_edge_cases(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.5], 2), (3, [0.5, 0.5], 2), (None, [0.5, 0.5], 3), (None, [1.0, 2.0], 1), (4, None, 1), (5, [1.0, None], 1), (6, [float("nan"), 1.0], 2),
            (7, [float("inf"), 1.0], 2), (8, [1.0, 1.0], None), (100, [1.0], 1), (200, [1.0], 1), (300, [-1.0], 1), (9, [0.5], 2), (400, [], 1), (10, [], 1), (11, [], 2), (500, [1.0, 2.0, 3.0], 1)]
    got = hardneg.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got), key=repr) == brute_negatives(rows)
    assert any(r.positive_id is None for r in got) and any(r.negative_id is None for r in got) and any(r.anchor_id == 400 for r in got)
    assert hardneg.mine(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0


def test_scores_of_any_size():
    a, b = np.array([[1 << 40, -3]]), np.array([[1 << 20, 1], [5, 7]])
    assert hardneg.scores(a, b).tolist() == [[(1 << 60) - 3, 5 * (1 << 40) - 21]]
    top = np.array([[hardneg.LONG - 1, hardneg.LONG - 1]])
    assert hardneg.scores(top, -top).tolist() == [[-hardneg.LONG]] and hardneg.scores(top, top).tolist() == [[hardneg.LONG - 1]]


def test_keys_sort_as_asked():
    every = [(a, r, s, k, i, w) for a in (-5, 0, 100) for r in (0, 3) for s in (-9, 0, 1 << 40) for k in (0, 1) for i in (-2, 7, None) for w in (0, 1)]
    random.Random(1).shuffle(every)
    keys = sorted(hardneg.pack(*x) for x in every)
    assert keys == [hardneg.pack(*x) for x in sorted(every, key=lambda x: (x[0], x[1], -x[2], x[3], x[4] is None, x[4] or 0, x[5]))]
    assert all(hardneg.unpack(hardneg.pack(*x))[1:] == (x[0], x[2], x[3], x[4]) for x in every)


# --- phrases -----------------------------------------------------------------------------

def brute_phrases(texts, langs, min_count, longest, top, cover):
    n, f = Counter(), defaultdict(Counter)
    for t, lang in zip(texts, langs):
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {g: a for g, a in counts.items() if len(g) > 1 and a >= min_count}
        best = []
        for g, a in cand.items():
            if any(100 * b >= cover * a and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, b in cand.items() if len(h) > len(g)):
                continue
            score, k = min((1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
            best.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(best)[:top])]
    return sorted(out)


@pytest.mark.parametrize("seed,cover,longest", [(1, 100, 5), (2, 60, 4), (3, 100, 3)])
def test_phrases_equal_brute_force(spark, seed, cover, longest):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["Ä", "ä", "zebra x", "x" * 300]
    fixed = ["to be or not to be that is", "new york city", "w1 w1 w1 w1 w1 w1"]
    texts = [r.choice(["", " ", "\t"]) + "".join(r.choice([*vocabulary, *fixed, "The", f"rare{r.randrange(3000)}"]) + r.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\r\n", "!"]) for _ in range(r.randint(0, 60))) for _ in range(150)]
    texts += [None, "", "...", texts[3], texts[3]]
    langs = [r.choice(["en", "de", None, "x\ty"]) for _ in texts]
    got = phrases.collocations(docs(spark, texts, langs=langs), min_count=8, longest=longest, top=40, cover=cover).collect()
    want = brute_phrases(texts, langs, 8, longest, 40, cover)
    assert sorted(map(tuple, got)) == want and len(want) > 30


def test_phrases_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 500)  # long texts are taken apart between pieces
    monkeypatch.setattr(phrases, "MEMORY_WORDS", 20)
    assert phrases.collocations(docs(spark, [])).count() == 0
    assert phrases.collocations(docs(spark, [None, "", "...", "one"]), min_count=1).count() == 0
    long = "the quick fox, the slow fox. " * 3000
    texts = [long, "the quick fox jumps " + "x" * 5000]
    got = phrases.collocations(docs(spark, texts), min_count=3000).collect()
    assert sorted(map(tuple, got)) == brute_phrases(texts, ["en"] * 2, 3000, 5, 2000, 100)
    one = phrases.collocations(docs(spark, ["a b", "a b", "b a"]), min_count=1, top=1).collect()
    assert [(r.rank, r.phrase, r.a) for r in one] == [(1, "a b", 2)]


def test_colliding_hashes_lead_to_another_seed(spark, monkeypatch):
    texts = docs(spark, ["alpha beta gamma"] * 3).select(F.col("lang"), F.col("text"))
    true = phrases.count_words(texts, 0)
    tried = []

    def count(t, seed):
        tried.append(seed)
        return true.withColumn("other", F.lit(b"other")) if seed == 0 else keep(t, seed)

    keep = phrases.count_words
    monkeypatch.setattr(phrases, "count_words", count)
    assert {r.phrase for r in phrases.collocations(docs(spark, ["alpha beta gamma"] * 3), min_count=3).collect()} == {"alpha beta gamma"}
    assert tried == [0, 1]


def test_products_beyond_64_bits(spark):
    kept = spark.createDataFrame([("en", [1, 2], 4 * 10**12)], "lang string, w array<long>, f long")
    counts = spark.createDataFrame([("en", [1], 5 * 10**12), ("en", [2], 7 * 10**12)], "lang string, w array<long>, f long")
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    assert phrases.scored(kept, counts, totals).first().score == 1000 * 4 * 10**12 * 10**14 // (5 * 10**12 * 7 * 10**12)


def test_units_cross_batches():
    import pyarrow as pa
    b = lambda *keys: pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys])], ["a", "b"])
    got = [t.num_rows for t in common.units([b((1, 1), (1, 1), (1, 2)), b((1, 2)), b((2, 2), (3, 2))], 2)]
    assert got == [2, 2, 1, 1]
