"""Near duplicates: MinHash bands, sequential Bayesian pruning, exact verification.

Documents are sets of distinct five-word shingles; two are linked when their sets overlap in at
least three quarters of their union. ``BANDS`` bands of ``ROWS`` MinHash values bring together a pair at
the threshold with probability 1 - (1 - 0.75^5)^40 = 0.99998. A candidate pair's signatures are
compared in batches; after each, the posterior of the similarity (uniform prior) must leave at least
``MISS`` probability for the threshold, else the pair is pruned. Survivors are verified on full sets.

Groups of near copies are never expanded into pairs. Equal sets become one class first. Then every
bucket offers its smallest class as a hub: classes are tested against hubs and joined to
components, so a group of k copies costs about k tests. Buckets whose classes still lie in several
components are settled without a cap and without pairs as rows: the classes outside the bucket's largest
component are a query set, sent to blocks of the bucket's classes of bounded size, where signatures prune
and full sets verify; a spanning forest of links comes out of every block. Buckets are aggregated before and
joined after the shuffle, so adaptive skew splitting covers huge ones; links, components, signatures
and the sets of bucketed classes stay in stored tables.

Words are runs of characters other than white space (``\\x20 \\x09-\\x0D``) after lower-casing A-Z. A
document of fewer than five words is one shingle. Defined cases: null texts and texts without words
have an empty set, are linked with nothing and kept; repeated rows are members of one class;
a null ``doc_id`` takes part, and is the ``component_id`` only where all members have none; an empty
table gives an empty result. Shingles are compared as 64-bit hashes, equal sets as 128-bit digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kgspark.llm.common import as_bytes, small_batches, worker_cache
from kgspark.llm.components import components
from kgspark.session import materialize

SHINGLE, BANDS, ROWS, STEP, MISS = 5, 40, 5, 20, 1e-6
PERCENT = 75
MEMORY_WORDS = 500_000
#: Hubs are tested anew while open buckets hold more than so many pairs of components a class.
HUBS = 50
#: Shingles of the classes that one task holds at once when open buckets are settled.
BLOCK_SHINGLES = 2_000_000
#: Bits of the filter that keeps texts of unbucketed documents from being shingled again: 16 MB at most.
FILTER_BITS = 1 << 27


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    known: dict[bytes, int] = worker_cache("words", dict)
    if len(known) > MEMORY_WORDS:
        known.clear()
    try:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    words = as_bytes(text).lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - size + 1 + k])
    return np.unique(out)


def minhash(sets: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values of 16 bits; the minimum itself is taken over 64 bits."""
    factors = worker_cache(f"factors:{n}", lambda: np.random.default_rng(20).integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1))
    low = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(sets), 1024):
            low = np.minimum(low, (sets[k:k + 1024, None] * factors[None, :]).min(0))
        return (_mix(low) >> np.uint64(48)).astype("<u2")


def least_matches(steps: list[int], threshold: float, miss: float) -> list[int]:
    """For each number of compared values the smallest number of matches that is not pruned.

    With a uniform prior the posterior of a similarity of at least t after m matches among n is
    P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in steps:
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored (row, doc_id, th, n, fp, sig): th is the text's hash, fp a digest of the set."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("th"), F.col(text_col).cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            n, fp, sig = [], [], []
            for text in b.column(2):
                s = shingles(text.as_py())
                n.append(len(s))
                fp.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig.append(minhash(s, BANDS * ROWS).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sig, pa.binary())],
                                             ["doc_id", "th", "n", "fp", "sig"])

    kind = src.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(sign, f"doc_id {kind}, th long, n long, fp binary, sig binary")
    return materialize(out.withColumn("row", F.monotonically_increasing_id()), "signatures")


def _likely(pairs: DataFrame, sig: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sequential comparison of their signatures does not prune."""
    steps = list(range(STEP, BANDS * ROWS + 1, STEP))
    least = least_matches(steps, percent / 100, MISS)

    @F.pandas_udf("boolean")
    def alive(x: pd.Series, y: pd.Series) -> pd.Series:
        keep = np.arange(len(x))
        a = np.frombuffer(b"".join(x), "<u2").reshape(len(x), BANDS * ROWS) if len(x) else np.zeros((0, BANDS * ROWS), "<u2")
        b = np.frombuffer(b"".join(y), "<u2").reshape(len(y), BANDS * ROWS) if len(y) else a
        same = np.zeros(len(x), np.int64)
        for n, m in zip(steps, least):
            same[keep] += (a[keep, n - STEP:n] == b[keep, n - STEP:n]).sum(1)
            keep = keep[same[keep] >= m]
        out = np.zeros(len(x), bool)
        out[keep] = True
        return pd.Series(out)

    one = sig.select(F.col("node").alias("a"), F.col("sig").alias("sa"), F.col("n").alias("na"))
    two = sig.select(F.col("node").alias("b"), F.col("sig").alias("sb"), F.col("n").alias("nb"))
    near = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return pairs.join(two, "b").join(one, "a").where(near).where(alive("sa", "sb")).select("a", "b")


def _sets(docs: DataFrame, need: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored (node, s) of the classes ``need`` (node, doc_id, th): their full sets, from one more pass over the texts.

    A bitmap of text hashes, of bounded size, lets only those texts through (and now and then another,
    which the join drops).
    """
    slot = F.pmod("th", F.lit(FILTER_BITS)) + 1  # bitmaps count from 1
    bits = need.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("b")).collect()
    sent = docs.sparkSession.sparkContext.broadcast({r["k"]: bytes(r["b"]) for r in bits})
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("h"), text.alias("text"))
    kind = src.schema["d"].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((FILTER_BITS >> 15, 4096), np.uint8)  # pages of zeros take no memory
        for k, b in sent.value.items():
            table[k - 1] = np.frombuffer(b, np.uint8)
        for b in batches:
            h = b.column(1).to_numpy() % FILTER_BITS
            rows = np.flatnonzero((table[h >> 15, (h & 32767) >> 3] >> (h & 7).astype(np.uint8)) & 1)
            for k in range(0, len(rows), 64):
                part = b.take(pa.array(rows[k:k + 64]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([shingles(t.as_py()).tobytes() for t in part.column(2)], pa.binary())], ["d", "h", "s"])

    full = src.mapInArrow(sets, f"d {kind}, h long, s binary")
    # repeated rows have equal sets, any of them will do
    found = full.join(need, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("th"))).select("node", "s")
    return materialize(found.dropDuplicates(["node"]), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored pairs (a, b) whose full sets are similar enough."""

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            a, b = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    return materialize(pairs.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a").where(similar("sa", "sb")).select("a", "b"), "verified")


class _Block:
    """Classes of a block (node, label, sig, set) that queries are compared with."""

    def __init__(self, rows: list[tuple[int, int, bytes, bytes]], percent: int, least: list[int]):
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        self.percent, self.least = percent, least
        # components join as links are found, so a block gives out a spanning forest of them
        self.node, self.label, self.joined = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), {}
        self.n = np.array([len(x) for x in sets], np.int64)
        self.sig = np.frombuffer(b"".join(r[2] for r in rows), "<u2").reshape(len(rows), BANDS * ROWS)
        owner, every = np.repeat(np.arange(len(rows)), self.n), np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        self.every, self.owner = every[order], owner[order]

    def links(self, label: int, sig: bytes, full: bytes) -> list[int]:
        """One linked node for every component that has one and is not yet joined with the query's."""
        while label in self.joined:
            label = self.joined[label]
        s, x = np.frombuffer(full, np.uint64), np.frombuffer(sig, "<u2")
        near = 100 * np.minimum(self.n, len(s)) >= self.percent * np.maximum(self.n, len(s))
        keep = np.flatnonzero((self.label != label) & near)
        same = np.zeros(len(self.n), np.int64)
        for k, m in enumerate(self.least):
            cols = slice(k * STEP, (k + 1) * STEP)
            same[keep] += (self.sig[keep, cols] == x[cols]).sum(1)
            keep = keep[same[keep] >= m]
        if not len(keep):
            return []
        low, up = np.searchsorted(self.every, s, "left"), np.searchsorted(self.every, s, "right")
        size = up - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        both = np.bincount(self.owner[at], minlength=len(self.n))[keep]
        keep = keep[100 * both >= self.percent * (self.n[keep] + len(s) - both)]
        others, first = np.unique(self.label[keep], return_index=True)
        for other in others.tolist():
            self.joined[other] = label
        self.label[np.isin(self.label, others)] = label
        return self.node[keep[first]].tolist()


def _settled(named: DataFrame, open_: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored links (a, b) between classes of different components that share an open bucket.

    ``named`` (key, node, label), ``open_`` (key, most). Every two such classes meet: of the classes of a
    bucket, those outside its largest component ``most`` query all.
    """
    here = named.join(open_.select("key", "most"), "key").select("most", "node", "label").distinct()
    full = here.join(nodes.select("node", "n", "sig"), "node").join(sets, "node")
    full = materialize(full, "open-sets")
    size = full.groupBy("most").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    full = full.join(size, "most")
    cols = ["most", "block", "asks", "node", "label", "sig", "s"]
    held = full.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("asks", F.lit(False))
    asked = full.where("label != most").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(True))
    least = least_matches(list(range(STEP, BANDS * ROWS + 1, STEP)), percent / 100, MISS)
    dealt = held.select(cols).union(asked.select(cols)).repartition("most", "block").sortWithinPartitions("most", "block", "asks", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, block, out = None, [], None, []
        for b in batches:
            for most, k, asks, node, label, sig, s in zip(*(c.to_pylist() for c in b.columns)):
                if (most, k) != key:
                    key, rows, block = (most, k), [], None
                if not asks:
                    rows.append((node, label, sig, s))
                elif rows:
                    block = block or _Block(rows, percent, least)
                    out += [(min(node, y), max(node, y)) for y in block.links(label, sig, s)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
                out = []

    return materialize(dealt.mapInArrow(compare, "a long, b long").distinct(), "settled")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(row, doc_id, th, n_shingles, component_id, label) for every row of ``docs``.

    ``label`` tells components apart (null without words); ``component_id`` does not where ids are null or repeated.
    """
    signed = signatures(docs, id_col, text_col)
    classes = signed.where("fp is not null").groupBy("fp").agg(F.min("row").alias("node"), F.min("doc_id").alias("low"))
    members = materialize(signed.join(classes, "fp", "left").select(
        "row", "doc_id", "th", "n", "node", F.coalesce("low", "doc_id").alias("low"), F.when(F.col("row") == F.col("node"), F.col("sig")).alias("sig")), "members")
    nodes = members.where("row = node")
    width = 2 * ROWS
    bands = nodes.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        i, F.substring(F.col("sig"), i * width + 1, F.lit(width))))).alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    buckets = materialize(bands.join(shared, "key").select("key", "node"), "buckets")
    sets = _sets(docs, buckets.select("node").distinct().join(nodes.select("node", "doc_id", "th"), "node"), id_col, text_col)
    label = nodes.select("node", F.col("node").alias("label")).limit(0)  # only of classes that have a link
    links, tested = None, None
    while True:
        named = buckets.join(label, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
        parts = named.groupBy("key", "label").agg(F.min("node").alias("rep"), F.count("*").alias("k"))
        whole = parts.groupBy("key").agg(F.count("*").alias("parts"), F.min("rep").alias("hub"), F.sum("k").alias("k"),
                                         F.sum(F.col("k") * F.col("k")).alias("kk"), F.max_by("label", "k").alias("most"))
        open_ = materialize(whole.where("parts > 1"), "open")
        n_open, cross = open_.agg(F.sum("k"), F.sum((F.col("k") * F.col("k") - F.col("kk")) / 2)).first()
        if not n_open:
            break
        pairs = None
        if tested is None or cross > HUBS * n_open:
            pairs = parts.join(open_.select("key", "hub"), "key").where("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
            # the first round tests a class once, against its smallest hub
            pairs = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b") if tested is None else pairs.distinct().join(tested, ["a", "b"], "left_anti")
            pairs = materialize(pairs, "pairs")
        if pairs is not None and not pairs.isEmpty():
            found = _verified(materialize(_likely(pairs, nodes, percent), "likely"), sets, percent)
            tested = pairs if tested is None else tested.union(pairs)
        else:
            found = _settled(named, open_, nodes, sets, percent)
        links = found if links is None else links.union(found)
        label = components(links)
        if pairs is None or pairs.isEmpty():
            break
    low = nodes.select("node", "low").join(label, "node").groupBy("label").agg(F.min("low").alias("least"))
    final = label.join(low, "label").select(F.col("node").alias("v"), "least", "label")
    return members.join(final, F.col("node") == F.col("v"), "left").select(
        "row", "doc_id", "th", F.col("n").alias("n_shingles"), F.coalesce("least", "low").alias("component_id"), F.coalesce("label", "node").alias("label"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    return near_components(docs, id_col, text_col, percent).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged: one of each component, and every row without words."""
    found = materialize(near_components(docs, id_col, text_col, percent), "near")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    one = found.where(own & (F.col("n_shingles") > 0)).groupBy("label").agg(F.min("row").alias("row"))
    stay = found.join(one, "row", "left_semi").union(found.where("n_shingles = 0")).select(F.col("doc_id").alias("__d"), F.col("th").alias("__h"))
    text = F.xxhash64(F.col(text_col).cast("string"))
    out = docs.join(stay, F.col(id_col).eqNullSafe(F.col("__d")) & (text == F.col("__h")), "left_semi")
    if found.where("n_shingles > 0").groupBy("doc_id", "th").agg(F.count("*").alias("k")).where("k > 1").isEmpty():
        return out
    first = Window.partitionBy(id_col, text).orderBy(F.lit(0))
    empty = F.length(F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]", "")) == 0
    return out.withColumn("__n", F.row_number().over(first)).where((F.col("__n") == 1) | empty).drop("__n")
