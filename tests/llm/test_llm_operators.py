"""Training-data operators against brute force, round trips and the defined edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F, types as T

from kgspark.llm import chat, decontam, exactdup, licenses, neardup, packing, secrets, shards, tokens, toxicity, urlfilter
from kgspark.llm.components import components

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("kept", T.StringType()),
                     T.StructField("row", T.LongType()), T.StructField("node", T.StringType())])


def docs(spark, *texts, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i if ids is None else ids[i], t, "x", 7, None) for i, t in enumerate(texts)], DOCS)


def invented(seed, n, words=60):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    return [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, words))) for _ in range(n)]


# --- packing -----------------------------------------------------------------------------

def brute_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [(r, k) for k, r in enumerate(rooms) if r >= n]
        if fit:
            rooms[min(fit)[1]] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_plan_equals_one_by_one(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 64, 100])
    lengths = [r.randint(1, capacity) for _ in range(r.randint(1, 600))] + [7] * r.randint(0, 200)
    plan = packing.best_fit_plan({n: lengths.count(n) for n in set(lengths)}, capacity)
    used = {}
    for n in set(lengths):
        rows = plan[plan[:, 0] == n]
        for rank in range(lengths.count(n)):
            row = rows[np.searchsorted(rows[:, 1], rank, "right") - 1]
            at = rank - row[1]
            used.setdefault(int(row[2] + at // row[3]), []).append((int(row[4] + at % row[3] * n), n))
    for places in used.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= capacity
    assert len(used) == brute_best_fit(lengths, capacity) and sorted(used) == list(range(len(used)))


def test_tightest():
    t = packing.Tightest(20)
    assert t.find(1) == -1
    for k in (3, 9, 20):
        t.set(k, True)
    assert [t.find(k) for k in (0, 3, 4, 9, 10, 20)] == [3, 3, 9, 9, 20, 20]
    t.set(9, False)
    assert t.find(4) == 20


def test_pack_documents(spark):
    long_ = " ".join(f"word{k}" for k in range(3000))
    got = packing.pack_documents(docs(spark, "a b c", None, "", long_, "a b c", ids=[1, 2, None, 4, 1]), capacity=256, with_ids=True).collect()
    enc = tokens.encoder()
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    whole = sorted((r for r in got if r.doc_id == 4), key=lambda r: r.piece)
    ids = np.frombuffer(b"".join(r.ids for r in whole), "<u4").tolist()
    assert ids == enc.full.encode(long_, add_special_tokens=False).ids + [2]
    assert all(r.length == 256 for r in whole[1:]) and [r.start for r in whole] == list(itertools.accumulate([0] + [r.length for r in whole[:-1]]))
    assert sum(r.doc_id == 1 for r in got) == 2 and [r.length for r in got if r.doc_id == 2] == [1]
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        v.sort()
        assert [a for a, _ in v] == list(itertools.accumulate([0] + [n for _, n in v[:-1]])) and sum(n for _, n in v) <= 256
    assert packing.pack_documents(docs(spark)).count() == 0


def test_both_tokenizers_agree():
    enc = tokens.encoder()
    for t in ["Étion dans, çouelle  un\n\n x's  we'll 12 34  ", "tabs\t\tand ünïcode — “quotes” €5", "<|endoftext|> in a text", "日本語 text ελληνικά", "a" * 5000, " \x85   x"]:
        assert enc.ids(t).tolist() == enc.full.encode(t, add_special_tokens=False).ids


# --- secrets -----------------------------------------------------------------------------

def test_secrets(spark):
    r = random.Random(1)
    key = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    keys = [key() for _ in range(60)]
    texts = [f'some words here token = "{k}" and more' for k in keys] + [f"see https://example.org/path/{'word' * 5}/{k} internationalisation{k % 7} now" for k in range(120)]
    d = docs(spark, *texts, None, "", "x " * 2000 + f'api_key = "{keys[0]}"')
    found = secrets.scan_secrets(d).collect()
    hit = {(x.doc_id, x.secret) for x in found if x.is_secret}
    assert {(i, k) for i, k in enumerate(keys)} <= hit and (182, keys[0]) in hit
    assert not [x for x in found if x.is_secret and 60 <= x.doc_id < 180]
    assert all(x.secret in texts[x.doc_id].split()[x.word] for x in found if x.doc_id < 180)
    assert secrets.scan_secrets(docs(spark)).count() == 0
    assert [x.is_secret for x in secrets.scan_secrets(docs(spark, "plain " + "abcdefghij" * 3)).collect()] == [False]


def test_secrets_without_quotes_or_names(spark):
    """The forest learns the secrets themselves, not the context that labelled them."""
    r = random.Random(2)
    key = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    texts = [f'words token = "{key()}" end' for _ in range(60)] + [f"see internationalisation{'abcdefghij'[k % 10]}{'word' * (k % 9)} now" for k in range(120)]
    bare = [key() for _ in range(9)]
    texts += [f"words TOKEN={k} end" for k in bare[:3]] + [f"words secret is {k} end" for k in bare[3:6]] + [f"words x={k} end" for k in bare[6:]]
    hit = {(x.doc_id, x.secret) for x in secrets.scan_secrets(docs(spark, *texts)).collect() if x.is_secret}
    assert all(any(i == 180 + n and k in s for i, s in hit) for n, k in enumerate(bare)) and not [i for i, _ in hit if 60 <= i < 180]
    assert not set(secrets.EVIDENCE) & set(secrets.FEATURES)


def test_secret_plan_has_no_python(spark):
    plan = secrets.candidates(docs(spark, "x"))._jdf.queryExecution().toString() + secrets.dictionary(docs(spark, "x"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- URL filters -------------------------------------------------------------------------

def test_url_filters(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("a.b.c", "", "block"), ("a.b.c", "/x", "allow"), ("dup.net", "/", "allow"), ("dup.net", "/", "block"), (None, "/", "block")]
    urls = ["http://Example.ORG/en/15?q=/es/", "https://m.example.org/en/2", "https://example.org", "https://notexample.org/es/1", "http://a.b.c#x", "http://a.b.c/x/y", "http://z.a.b.c/y",
            "http://dup.net/", "no scheme", None, "", "ftp://com/", "http://x.org/es/?a#b", "://", "http://example.org/es/"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)], "page_id long, url string, verdict string")

    def brute(u):
        if u is None or "://" not in u:
            return "", "", None, "allow"
        rest = re.split(r"[?#]", u.split("://", 1)[1])[0]
        host, slash, path = rest.partition("/")
        host, path = "".join(c.lower() if c.isascii() else c for c in host), slash + path
        fit = [(h.count("."), len(p), v == "block", h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fit)[3:] if fit else (None, "allow")))

    for table in (rules, spark.createDataFrame(rules, "host string, path string, verdict string")):
        for block in (200_000, 3):
            got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.filter_urls(pages, table, block=block).collect()}
            assert got == {i: brute(u) for i, u in enumerate(urls)}
    assert {r.verdict for r in urlfilter.filter_urls(pages, [], default="block").collect()} == {"block"}
    assert urlfilter.filter_urls(pages.limit(0), rules).count() == 0


# --- toxicity ----------------------------------------------------------------------------

def test_toxicity_held_out(spark):
    r = random.Random(3)
    bad, calm = ["grobian", "lump", "schuft", "wicht"], ["w" + "abcdefghij"[k % 10] + "klmnop"[k % 6] + "qrstu"[k // 60] for k in range(300)]
    texts, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        w = [r.choice(calm) for _ in range(r.randint(5, 80))] + (r.sample(bad, r.randint(1, 4)) + ["schurke" + r.choice("nabc")] if toxic else [])
        r.shuffle(w)
        texts.append(" ".join(w).upper() if i % 50 == 0 else " ".join(w))
        labels.append(int(toxic))
    d = docs(spark, *texts, None, "")
    known = spark.createDataFrame([(i, labels[i]) for i in range(300)] + [(0, 0), (5, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    got = {x.doc_id: x.toxicity for x in toxicity.score(d, toxicity.train(d, known)).collect()}
    wrong = sum(got[i].rejected != bool(labels[i]) for i in range(300, 600))
    assert wrong <= 3 and not got[600].rejected and not got[601].rejected
    assert np.mean([got[i].severity for i in range(300, 600) if labels[i]]) > 1 > np.mean([got[i].severity for i in range(300, 600) if not labels[i]])
    kept = toxicity.drop_toxic(d, known)
    assert kept.columns == d.columns and kept.count() == sum(not t.rejected for t in got.values())
    for few in (known.limit(0), known.where("toxic = 0")):
        assert toxicity.drop_toxic(d, few).count() == 602
    assert toxicity.drop_toxic(docs(spark), known).count() == 0


def test_ordinal_recovers_order():
    r = np.random.default_rng(0)
    rows = [sorted(r.choice(6, r.integers(0, 6), replace=False).tolist()) for _ in range(1500)]
    w = np.array([2.0, 1.5, 1.0, 0.0, -1.0, 0.5])
    score = [w[x].sum() + r.logistic() for x in rows]
    y = np.array([sum(z > t for t in (0.5, 1.5, 3.0)) for z in score])
    got, th = toxicity.fit_ordinal(rows, y, 6, 4)
    assert np.abs(got - w).max() < 0.45 and (np.diff(th) > 0).all() and np.abs(th - [0.5, 1.5, 3.0]).max() < 0.45


# --- near duplicates ---------------------------------------------------------------------

def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets, parent = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def near_texts():
    r, texts = random.Random(5), invented(5, 120, 90)
    for base in range(6):  # groups of near copies, chains, copies
        t = texts[base * 3].split() + [f"g{base}"] * 3 + [f"h{k}" for k in range(60)]
        for _ in range(25):
            t = list(t)
            t[r.randrange(len(t))] = f"x{r.randrange(10**6)}"
            texts.append(" ".join(t))
            if r.random() < 0.5:
                t = texts[base * 3].split() + [f"g{base}"] * 3 + [f"h{k}" for k in range(60)]
    return texts + ["", None, "one two", "ONE  two\n", "one two three", " \t", texts[3].upper(), texts[3]]


def test_near_dedup_equals_brute_force(spark):
    texts = near_texts()
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in neardup.near_dedup(docs(spark, *texts).repartition(5)).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in brute_components(texts).items()}


def test_near_dedup_edges(spark):
    d = docs(spark, "a b c d e f g", "a b c d e f g", None, None, "a b c d e f g", "", ids=[4, 4, 5, 5, None, None])
    rows = sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in neardup.near_dedup(d).collect()), key=str)
    assert rows == sorted([(4, 3, 4, True), (4, 3, 4, True), (5, 0, 5, True), (5, 0, 5, True), (None, 3, 4, False), (None, 0, None, True)], key=str)
    stay = neardup.drop_near_duplicates(d)
    assert stay.columns == d.columns and sorted((x.doc_id, x.text) for x in stay.where("text != ''").collect()) == [(4, "a b c d e f g")] and stay.count() == 4
    assert neardup.near_dedup(docs(spark)).count() == 0 and neardup.drop_near_duplicates(docs(spark)).count() == 0


def test_near_drop_keeps_one_of_each_component(spark):
    """Null and repeated ids do not make one component of texts that are not linked."""
    r = random.Random(6)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(40)) for _ in range(12)]
    near = [texts[k] + " more" for k in (0, 6, 11)]
    ids = [None] * 6 + [4, 4, 4, 7, 7, 9] + [None, 3, None]
    stay = neardup.drop_near_duplicates(docs(spark, *texts, *near, texts[1], ids=[*ids, None]).repartition(3))
    got = sorted((x.text.removesuffix(" more"), x.doc_id) for x in stay.collect())
    assert [t for t, _ in got] == sorted(texts)
    by = dict(got)
    assert [by[t] for t in texts] == [None] * 6 + [3, 4, 4, 7, 7, 9]


def test_minhash_estimates():
    r = np.random.default_rng(2)
    for share in (0.5, 0.75, 0.9):
        n = 400
        k = int(round(2 * n * share / (1 + share)))
        got = []
        for _ in range(30):
            x = r.integers(0, 2**63, 2 * n - k, np.uint64)
            a, b = neardup.minhash(np.sort(x[:n]), 200), neardup.minhash(np.sort(x[n - k:]), 200)
            got.append((a == b).mean())
        assert abs(np.mean(got) - share) < 0.02
    assert neardup.least_matches([20, 200], 0.75, 1e-6) == sorted(neardup.least_matches([20, 200], 0.75, 1e-6))


def test_components(spark):
    r = random.Random(0)
    edges = [(k, k + 1) for k in range(200)] + [(300, k) for k in range(301, 340)] + [(r.randrange(400, 460), r.randrange(400, 460)) for _ in range(50)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {x.node: x.label for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


# --- chat --------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    nasty = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "system", "be\n\n kind  "), (1, 1, "user", nasty), (1, 2, "assistant", nasty + " ünï 日本 \n\n"), (1, 3, "assistant", ""), (1, 4, "assistant", "\n ### x</turn>\n### user:\nno"),
            (2, 0, "user", None), (2, 1, None, "x"), (3, None, "assistant", "first"), (3, 5, "user\n:", "a"), (3, 5, "assistant", "b"), (None, 0, "user", "q"), (None, 1, "assistant", "r"),
            (4, 0, "user", "hi"), (4, 0, "user", "hi"), *[(9, k, "assistant" if k % 2 else "user", f"turn {k} " * 50) for k in range(60)]]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    for block in (chat.BLOCK, 500):
        blocks = chat.format_conversations(turns, block=block)
        got = {x.conv_id: x for x in chat.digests(blocks).collect()}
        byconv = {}
        for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
            byconv.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
        assert got.keys() == byconv.keys()
        for c, said in byconv.items():
            loss = "".join(t for w, t in said if w == "assistant")
            assert got[c].n_turns == len(said) and got[c].loss_chars == len(loss)
            assert got[c].turns_sha256 == hashlib.sha256("".join(f"{w}\n{t}\n" for w, t in said).encode()).hexdigest()
            assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
            assert got[c].formatted_chars == sum(len(chat.render(w, t)[0]) for w, t in said)
        nine = sorted((x for x in blocks.where("conv_id = 9").collect()), key=lambda x: (x.turn, x.part))
        whole = "".join(chat.render(w, t)[0] for w, t in byconv[9])
        ids = np.frombuffer(b"".join(x.ids for x in nine), "<u4").tolist()
        assert "".join(x.formatted for x in nine) == whole and ids == tokens.encoder().full.encode(whole, add_special_tokens=False).ids
    assert chat.digests(chat.format_conversations(turns.limit(0))).count() == 0


def test_mask_by_binary_search():
    r = random.Random(4)
    for _ in range(200):
        cuts = sorted(r.sample(range(1, 60), r.randint(1, 30)))
        offsets = np.array(list(zip([0] + cuts, cuts + [60])), np.int64)
        spans, at = [], 0
        while at < 55:
            a = r.randint(at, 58)
            b = r.randint(a, min(60, a + 9))
            spans.append((a, b))
            at = b + 1
        mask, under = chat.mask_tokens(offsets, spans)
        assert mask.tolist() == [int(any(a < e and s < b and a < b for a, b in spans)) for s, e in offsets.tolist()]
        assert under == [s for s in spans if s[0] < s[1]]


# --- decontamination ---------------------------------------------------------------------

def words7(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


def brute_hits(text, items):
    w, hit, found = words7(text), set(), set()
    for name, t in items:
        b = words7(t)
        for k in range(max(1, len(b) - 12)) if b else ():
            g = b[k:k + 13]
            for p in range(len(w) - len(g) + 1):
                if w[p:p + len(g)] == g:
                    hit.update(range(p, p + len(g)))
                    found.add("" if name is None else str(name))
    return len(w), len(hit), sorted(found)


def test_decontamination_equals_brute_force(spark):
    r = random.Random(9)
    items = [(10 + k, " ".join(f"b{r.randrange(9)}" for _ in range(r.randint(1, 40)))) for k in range(12)]
    items += [(10, items[1][1]), (None, "null id item"), (99, None), (98, "?!"), (97, "b1"), (96, items[2][1].upper() + "!")]
    texts = [" ".join(r.choice([f"b{r.randrange(9)}", f"t{r.randrange(50)}", "Ñandú", "x-y_z"]) for _ in range(r.randint(0, 60))) for _ in range(60)]
    for k in range(30):
        b = r.choice(items[:12])[1].split()
        a = r.randrange(len(b))
        texts[k] = "t0 " * r.randint(0, 5) + " ".join(b[a:a + r.randint(1, 30)]) + r.choice([".", " t1", ""]) + texts[k]
    texts += [None, "", "null ID item", items[0][1] * 1]
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = docs(spark, *texts)
    for block, shard in ((8_000_000, 1_000_000), (60, 40)):
        got = {x.doc_id: x.contamination for x in decontam.scan(d, bench, block_chars=block, shard_words=shard).collect()}
        for i, t in enumerate(texts):
            assert (got[i].n_words, got[i].n_hit, list(got[i].items)) == brute_hits(t, items), (i, t)
        for i, t in enumerate(texts):
            w = words7(t)
            for m in got[i].matches:
                span = w[m.word:m.word + m.n_words]
                assert any(("" if n is None else str(n)) == m.item_id and words7(x)[m.item_word:m.item_word + m.n_words] == span for n, x in items)
    clean = decontam.decontaminate(d, bench)
    assert clean.columns == d.columns
    assert {x.doc_id for x in clean.collect()} == {i for i, t in enumerate(texts) if not (brute_hits(t, items)[1] and 20 * brute_hits(t, items)[1] >= brute_hits(t, items)[0])}
    assert decontam.scan(d, bench.limit(0)).where("contamination.n_hit > 0").count() == 0 and decontam.decontaminate(docs(spark), bench).count() == 0
    assert decontam.matches(docs(spark, "zz " + items[0][1]), bench.where("item_id = 10").limit(1)).count() >= 1


# --- licenses ----------------------------------------------------------------------------

def test_licenses_against_brute_force(spark):
    r = random.Random(7)
    texts = []
    for k in range(80):
        w = [f"w{r.randrange(500)}" for _ in range(r.randint(0, 80))]
        if k % 2:
            t = licenses.TEMPLATES[k % len(licenses.TEMPLATES)][1].split()
            if k % 3 == 0 and len(t) > 16:
                t[len(t) // 2] = "changed"
            w[len(w) // 2:len(w) // 2] = t
        texts.append(" ".join(w))
    texts += [None, "", "Released under the", "RELEASED, under: the MIT license!"]
    got = {}
    for x in licenses.scan_licenses(docs(spark, *texts)).collect():
        got.setdefault(x.doc_id, set()).add(x.license)
        assert x.containment >= 0.75
    for i, t in enumerate(texts):
        w, expect = decontam.words(t), set()
        for name, notice in licenses.TEMPLATES:
            n = decontam.words(notice)
            need = {tuple(n[k:k + 5]) for k in range(max(1, len(n) - 4))}
            for a in range(max(1, len(w))):
                have = {tuple(w[k:k + 5]) for k in range(a, min(len(w) - 4, a + len(n) - 4))}
                if 100 * len(need & have) >= 75 * len(need):
                    expect.add(name)
        assert got.get(i, set()) >= expect, (i, t)
        assert i % 2 or i > 79 or not got.get(i)
    assert licenses.scan_licenses(docs(spark), []).count() == 0 and licenses.scan_licenses(docs(spark, "x"), []).count() == 0


def test_short_licenses_are_never_missed():
    """Exact short notices in many contexts, at even and odd words; every template is either retrieved directly or missed below 1e-5."""
    r, index = random.Random(12), licenses.Templates(licenses.TEMPLATES)
    for name, notice in licenses.TEMPLATES:
        for k in range(400 if len(notice.split()) < 10 else 20):
            text = " ".join([f"a{r.randrange(10**6)}" for _ in range(7 + k % 2)] + [notice] + [f"b{r.randrange(10**6)}" for _ in range(7)])
            assert (name, 7 + k % 2, len(decontam.words(notice)), 1.0) in index.find(text), text
    for size in range(1, 400):
        n = max(1, size - 4)
        one = licenses.Templates([("x", " ".join(f"t{k}" for k in range(size)))])
        assert one.direct or ((1 - (-(-3 * n // 4) / (2 * n + 2 - -(-3 * n // 4))) ** 2) ** 32 <= 1e-5 and one.bands)


# --- exact duplicates --------------------------------------------------------------------

def test_exact_dedup(spark):
    long_ = "Lorem Ipsum. " * 3000
    texts = ["a", "A", None, "", "Ä", "ä", long_, long_.upper(), long_ + "x", "a", "日本" * 4000, "日本" * 4000]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 9, 2, None, None]
    d = docs(spark, *texts, ids=ids).repartition(3)
    got = exactdup.exact_dedup(d).collect()
    low = ["".join(c.lower() if c.isascii() else c for c in t or "") for t in texts]
    expect = []
    for i, t in zip(ids, low):
        same = [j for j, u in zip(ids, low) if u == t]
        expect.append((i, max((j for j in same if j is not None), default=None), len(same), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(((x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in got), key=str) == sorted(expect, key=str)
    assert sum(x.kept for x in got) == len(set(low)) and all(x.doc_id == x.keep_id for x in got if x.kept)
    stay = exactdup.drop_duplicates(d)
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    assert stay.columns == d.columns and sorted(lower(x.text) for x in stay.select("text").collect()) == sorted(set(low))
    assert exactdup.exact_dedup(docs(spark)).count() == 0 and exactdup.drop_duplicates(docs(spark)).count() == 0


def test_clashing_chunk_hashes(spark, monkeypatch):
    """With a hash of two values the variants alone keep recipes apart."""
    real = F.xxhash64
    monkeypatch.setattr(exactdup.F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(2)))
    texts = invented(3, 40, 400) * 2
    got = exactdup.exact_dedup(docs(spark, *texts)).collect()
    assert all(x.group_size == 2 and x.keep_id == x.doc_id % 40 + 40 for x in got) and len({x.keep_id for x in got}) == 40


def test_exact_dedup_plan_is_native(spark):
    plan = exactdup.recipes(docs(spark, "x"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_chunks_are_the_text(spark):
    for t in ["", "a b " * 5000, "x" * 10000, "line\n" * 3000, "日" * 9000]:
        parts = spark.createDataFrame([(t,)], "t string").select(exactdup.chunks(F.col("t"))).first()[0]
        assert "".join(parts) == t and all(len(p) <= exactdup.MAX for p in parts)


# --- shards ------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    got = shards.permute(np.arange(n), n, "k")
    assert sorted(got.tolist()) == list(range(n))
    if n > 100:
        assert (got != shards.permute(np.arange(n), n, "other")).any() and (got != np.arange(n)).mean() > 0.9


def test_shards_round_trip(spark, tmp_path):
    texts = invented(8, 90, 300) + [None, "", "long " * 5000]
    d = docs(spark, *texts).repartition(3)
    path = str(tmp_path / "out")
    index = shards.materialise(d, path, "key", capacity=64, per_shard=16)
    records = shards.read_records(spark, path, capacity=64, per_shard=16)
    rows = shards.verified(index, records).collect()
    n = len(rows)
    assert sorted(x.slot for x in rows) == list(range(n)) and all(x.ids_crc32 == x.stored_crc32 for x in rows)
    held = {x.slot: np.frombuffer(x.ids, "<u2") for x in records.collect()}
    assert {x.slot for x in shards.read_records(spark, path, capacity=64, per_shard=16, first_slot=40).collect()} == set(range(40, n))
    import glob
    for f in glob.glob(path + "/shard=*/part-*"):
        shard, data = int(re.search(r"shard=(\d+)", f)[1]), open(f, "rb").read()
        for k in range(len(data) // 129):
            ids = np.frombuffer(data[129 * k:129 * k + 128], "<u2")
            assert ids[ids != shards.PAD].tolist() == held[shard * 16 + k].tolist()
    assert len(glob.glob(path + "/shard=*/part-*")) == -(-n // 16)
    enc, found = tokens.encoder(), {}
    for x in rows:
        ids = held[x.slot].tolist()
        for doc, a, b in zip(x.doc_ids, x.starts, [*x.starts[1:], len(ids)]):
            found.setdefault(doc, []).append((x.slot, ids[a:b]))
    for i, t in enumerate(texts):
        whole = [*enc.ids(t).tolist(), 2]
        assert sum(len(p) for _, p in found[i]) == len(whole) and sorted(sum((p for _, p in found[i]), [])) == sorted(whole)
    assert shards.materialise(docs(spark), str(tmp_path / "none"), "key").count() == 0
