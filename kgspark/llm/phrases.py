"""Phrase collocations from a weighted de Bruijn graph of the corpus.

Texts are lower-cased (A-Z), split into pieces at punctuation and line breaks and into words at blanks and tabs.
Nodes of the graph are runs of four words, its edges runs of five that join two overlapping nodes; an edge weighs as often
as it occurs. Only edges are counted in the texts. The count of a node is the weight of the edges that leave it, plus
the places where a piece ends with it (kept as edges padded with zeros); counts of shorter phrases follow from node
to node in the same way. A phrase all of whose occurrences go on by the same word, or come from the same one, lies inside a unary
path and is represented by the longer phrase: such paths are compacted, which is the rule of ``cover``.

Three passes over all texts. The first counts words. In the second, words that occur fewer than ``min_count`` times cut
pieces (no phrase that is wanted holds one), and pairs of words are counted in a table of counters of fixed width, which
never counts too low. In the third, pieces are also cut between words whose counter stays below ``min_count``. Cuts lose no
phrase, they only keep edges out of the shuffle that cannot lead to one. The counters have eight pairs each on average
up to 2^26 counters (64 MB in a task, 8 MB of bits in the broadcast); larger corpora fill them more, so fewer edges are kept
out, down to none: then all edges are shuffled, partially aggregated.

Words travel as 64-bit hashes; two words of one language with the same hash are noticed in the first pass and lead to
another seed, so counts are exact. Products of counts are computed as 38-digit decimals.

Defined cases: null texts are empty; a null language is ``und``; texts without words and an empty table give no rows; repeated rows
count each; a document has no length limit; ties are ordered by the bytes of the phrase; no other column is read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kgspark.llm.common import as_bytes
from kgspark.session import materialize

#: A-Z to lower case, everything that ends a piece to a line feed, tabs to blanks.
FOLD = bytes(ord(b"\n") if c in b".,;:!?\n\x0b\x0c\r" else ord(b" ") if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes of text that are split into words at once, and words a task remembers.
SEGMENT, MEMORY_WORDS = 2_000_000, 400_000
WORD_BITS = 1 << 27
CELLS, BLOCK = (1 << 16, 1 << 26), 1 << 16
TOP_SALT = 64


def words(folded: bytes) -> list[bytes]:
    """Words of a folded text; a line feed stands between pieces."""
    return [*filter(None, folded.replace(b"\n", b" \n ").split(b" "))]


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(language, words) of texts put together up to ``SEGMENT``; longer texts are taken apart between pieces."""
    held: dict[str, list[bytes]] = {}
    size: Counter = Counter()
    for b in batches:
        for lang, text in zip(b.column(0), b.column(1)):
            lang, t = lang.as_py(), as_bytes(text.as_py()).translate(FOLD)
            while len(t) > SEGMENT and (end := t.find(b"\n", SEGMENT)) >= 0:
                yield lang, words(t[:end])
                t = t[end:]
            held.setdefault(lang, []).append(t)
            size[lang] += len(t) + 1
            if size[lang] > SEGMENT:
                yield lang, words(b"\n".join(held.pop(lang)))
                del size[lang]
        if len(held) > 1000:  # so many languages are no languages, but memory stays bounded
            for lang in [*held]:
                yield lang, words(b"\n".join(held.pop(lang)))
            size.clear()
    for lang, texts in held.items():
        yield lang, words(b"\n".join(texts))


def _hash(word: bytes, seed: int) -> int:
    import xxhash

    return (xxhash.xxh3_64_intdigest(word, seed) or 1) - (1 << 63) or 1  # 0 stands for no word


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def _salt(lang: str) -> np.uint64:
    return np.uint64(_hash(lang.encode(), 7) % (1 << 64))


def count_words(texts: DataFrame, seed: int) -> DataFrame:
    """Stored (lang, h, word, other, c) of all words; ``other`` differs from ``word`` where hashes collide."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Counter] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, c in known.items():
                c.pop(b"\n", None)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array([_hash(w, seed) for w in c], pa.int64()),
                                                  pa.array([*c], pa.binary()), pa.array([*c.values()], pa.int64())], ["lang", "h", "word", "c"])
            known.clear()

        for lang, found in segments(batches):
            known.setdefault(lang, Counter()).update(found)
            if sum(map(len, known.values())) > MEMORY_WORDS:
                yield from rows()
        yield from rows()

    out = texts.mapInArrow(count, "lang string, h long, word binary, c long")
    return materialize(out.groupBy("lang", "h").agg(F.min("word").alias("word"), F.max("word").alias("other"), F.sum("c").alias("c")), "vocabulary")


class _Hashed:
    """Hashes of words; 0 for ends of pieces and for words whose bit is not set."""

    def __init__(self, bits: dict[int, bytes], seed: int):
        self.table = np.zeros((WORD_BITS >> 15, 4096), np.uint8)  # pages of zeros take no memory
        for k, b in bits.items():
            self.table[k - 1] = np.frombuffer(b, np.uint8)
        self.seed, self.known = seed, {}

    def __call__(self, lang: str, found: list[bytes]) -> np.ndarray:
        known = self.known.setdefault(lang, {b"\n": 0})
        try:
            return np.fromiter(map(known.__getitem__, found), np.int64, len(found))
        except KeyError:
            if len(known) > MEMORY_WORDS or len(self.known) > 1000:
                self.known = {lang: (known := {b"\n": 0})}
            new = [*(set(found) - known.keys())]
            h = np.array([_hash(w, self.seed) for w in new], np.int64)
            at = h & (WORD_BITS - 1)
            set_ = (self.table[at >> 15, (at & 32767) >> 3] >> (at & 7).astype(np.uint8)) & 1
            known.update(zip(new, (h * set_).tolist()))
            return np.fromiter(map(known.__getitem__, found), np.int64, len(found))


def _word_bits(frequent: DataFrame) -> dict[int, bytes]:
    """Bits of the hashes of frequent words, 16 MB at most."""
    slot = F.col("h").bitwiseAND(F.lit(WORD_BITS - 1)) + 1  # bitmaps count from 1
    return {r["k"]: bytes(r["b"]) for r in frequent.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("b")).collect()}


def _pairs(lang: str, h: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a word is followed by one of the same piece, and the counter of the pair."""
    a, b = h[:-1].view(np.uint64), h[1:].view(np.uint64)
    with np.errstate(over="ignore"):
        cell = _mix(_mix(a + _salt(lang)) * np.uint64(0x9E3779B97F4A7C15) + b) & np.uint64(cells - 1)
    return (h[:-1] != 0) & (h[1:] != 0), cell.astype(np.int64)


def pair_bits(texts: DataFrame, sent, seed: int, cells: int, min_count: int) -> np.ndarray:
    """A bit for every counter of pairs that reaches ``min_count``: ``cells`` / 8 bytes."""
    kind = np.uint8 if min_count < 256 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, total = _Hashed(sent.value, seed), np.zeros(cells, np.uint32)
        for lang, found in segments(batches):
            h = hashed(lang, found)
            ok, cell = _pairs(lang, h, cells)
            np.add.at(total, cell[ok], np.uint32(1))
        for k in range(0, cells, BLOCK):
            part = total[k:k + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k // BLOCK], pa.int32()), pa.array([np.minimum(part, min_count).astype(kind).tobytes()], pa.binary())], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for b in batches:
            for block, counts in zip(b.column(0).to_pylist(), b.column(1)):
                if block != key:
                    if key is not None:
                        yield done(key, total)
                    key, total = block, np.zeros(BLOCK, np.uint64)
                total += np.frombuffer(counts.as_py(), kind)
        if key is not None:
            yield done(key, total)

    def done(block: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(total >= min_count, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])

    found = texts.mapInArrow(count, "block int, counts binary").repartition("block").sortWithinPartitions("block").mapInArrow(add, "block int, bits binary").collect()
    out = np.zeros((cells // BLOCK, BLOCK // 8), np.uint8)
    for r in found:
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def edges(texts: DataFrame, words_sent, pairs_sent, seed: int, cells: int, longest: int) -> DataFrame:
    """Stored (lang, w1.., f): runs of ``longest`` words and, padded with zeros, the shorter ones at ends of pieces."""
    names = [f"w{k}" for k in range(1, longest + 1)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, bits = _Hashed(words_sent.value, seed), pairs_sent.value
        for lang, found in segments(batches):
            h = hashed(lang, found)
            link, cell = _pairs(lang, h, cells)
            link &= ((bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1).astype(bool)
            at = np.flatnonzero(link)
            h, link = np.concatenate([h, np.zeros(longest, h.dtype)]), np.concatenate([link, np.zeros(longest, bool)])
            cols, on = [h[at], h[at + 1]], np.ones(len(at), bool)
            for k in range(2, longest):
                on = on & link[at + k - 1]
                cols.append(np.where(on, h[at + k], 0))
            for k in range(0, len(at), 50_000):
                part = [pa.array(c[k:k + 50_000], pa.int64()) for c in cols]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part[0]), pa.string()), *part], ["lang", *names])

    rows = texts.mapInArrow(cut, "lang string, " + ", ".join(f"{w} long" for w in names))
    return materialize(rows.groupBy("lang", *names).agg(F.count("*").alias("f")), "edges")


def flows(edge: DataFrame, longest: int, min_count: int) -> DataFrame:
    """(lang, w: the words, f) of all phrases of 2 to ``longest`` words with f of at least ``min_count``."""
    names = [f"w{k}" for k in range(1, longest + 1)]
    level = edge.where(F.col(names[-1]) != 0)
    out = level.where(F.col("f") >= min_count).select("lang", F.array(*names).alias("w"), "f")
    for k in range(longest - 1, 1, -1):
        here = names[:k]
        ends = edge.where((F.col(names[k - 1]) != 0) & (F.col(names[k]) == 0))
        level = materialize(level.select("lang", *here, "f").union(ends.select("lang", *here, "f")).groupBy("lang", *here).agg(F.sum("f").alias("f")), "nodes")
        out = out.union(level.where(F.col("f") >= min_count).select("lang", F.array(*here).alias("w"), "f"))
    return materialize(out, "phrases")


def compacted(phrases: DataFrame, cover: int) -> DataFrame:
    """Phrases of which no longer one holds at least ``cover`` percent of the occurrences.

    Of the longer ones those by one word suffice: between a phrase and a longer one that holds it lies one by one word, which
    is as frequent as the longer one at least.
    """
    size = F.size("w")
    longer = phrases.where(size > 2).select("lang", F.explode(F.array(F.slice("w", 1, size - 1), F.slice("w", 2, size - 1))).alias("w"), F.col("f").alias("g"))
    most = longer.groupBy("lang", "w").agg(F.max("g").alias("g"))
    return phrases.join(most, ["lang", "w"], "left").where(F.col("g").isNull() | (100 * F.col("g") < cover * F.col("f"))).select("lang", "w", "f")


def scored(kept: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, w, a, l, r, n, score) with the lowest-scoring cut of each phrase."""
    size = F.size("w")
    cuts = kept.select("lang", "w", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.select("*", F.slice("w", F.lit(1), F.col("cut")).alias("left"), F.slice("w", F.col("cut") + 1, size - F.col("cut")).alias("right"))
    both = cuts.join(counts.select("lang", F.col("w").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        counts.select("lang", F.col("w").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(totals, "lang")
    score = F.expr("cast(1000 as decimal(38,0)) * a * n div (cast(l as decimal(38,0)) * r)")
    return both.withColumn("score", score).groupBy("lang", "w").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("x")).select("lang", "w", "x.a", "x.l", "x.r", "x.n", "x.score")


def collocations(docs: DataFrame, text_col: str = "text", group_col: str = "lang", min_count: int = 100, longest: int = 5, top: int = 2000, cover: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    if longest < 3 or min_count < 1:
        raise ValueError("longest must be 3 or more, min_count 1 or more")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    seed = 0
    while not (vocabulary := count_words(texts, seed)).where("word != other").isEmpty():
        seed += 1
    totals = vocabulary.groupBy("lang").agg(F.sum("c").alias("n"))
    n = totals.agg(F.sum("n")).first()[0] or 0
    frequent = vocabulary.where(F.col("c") >= min_count)
    words_sent = spark.sparkContext.broadcast(_word_bits(frequent))
    cells = min(max(CELLS[0], 1 << max(1, n // 8).bit_length()), CELLS[1])
    pairs_sent = spark.sparkContext.broadcast(pair_bits(texts, words_sent, seed, cells, min_count))
    phrases = flows(edges(texts, words_sent, pairs_sent, seed, cells, longest), longest, min_count)
    counts = phrases.union(frequent.select("lang", F.array("h").alias("w"), F.col("c").alias("f")))
    best = scored(compacted(phrases, cover), counts, totals)
    spelt = best.select("*", F.posexplode("w").alias("at", "h")).join(frequent.select("lang", "h", F.col("word").cast("string").alias("word")), ["lang", "h"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")  # at most ``longest`` words
    named = spelt.groupBy("lang", "w", "a", "l", "r", "n", "score").agg(text.alias("phrase"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each of many parts first, so that a large language is not sorted by one task
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALT))).orderBy(*order)
    first = named.withColumn("k", F.row_number().over(part)).where(F.col("k") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return first.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
