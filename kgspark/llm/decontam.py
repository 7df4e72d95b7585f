"""Benchmark decontamination with suffix arrays over shards of the training documents.

Every task turns its documents, a shard of bounded size at a time, into one array of word ids
(0 for a word no benchmark text has, and between documents) and builds the suffix array of the shard
over the suffixes that can start a match. Every test suffix of the benchmark is then looked up by
binary search: the range of equal prefixes gives all verbatim occurrences of its first ``WINDOW``
words, and neighbouring occurrences on one diagonal join to the longest matches with their places.
Documents never move: the pass is one map over them.

The benchmark is broadcast in blocks of at most ``BLOCK_CHARS`` characters, measured before they are
collected; a larger benchmark takes several passes, each adding its hits to the rows.

Words are the runs of ``0-9 a-z`` and non-ASCII characters after lower-casing A-Z. A window is
``WINDOW`` consecutive words of an item; a shorter item with words is one window. A document word
inside any occurrence of a window is hit.

Defined cases: null or wordless texts have no words, no hits and are clean; items without words
match nothing; rows of one ``item_id`` count as one item, a null ``item_id`` is reported as the empty
string; repeated documents are judged one by one; an empty benchmark hits nothing; a shard takes
whole documents, so a very long document is a shard of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from kgspark.llm.common import as_bytes, small_batches, worker_cache

WINDOW, SHARD_WORDS, BLOCK_CHARS = 13, 1_000_000, 8_000_000
#: Words are what this table leaves: A-Z become a-z, other ASCII but digits and a-z becomes a blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return as_bytes(text).translate(_TABLE).split()


class Suffixes:
    """All distinct test suffixes of a block of items, cut to ``WINDOW`` words, by length."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window, self.vocabulary = window, {}
        seen: dict[tuple[int, ...], int] = {}
        where: list[list[tuple[int, int]]] = []  # window -> (item, word) it starts at
        self.names = sorted({i for i, _ in items})
        number = {n: k for k, n in enumerate(self.names)}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if not ids:
                continue
            for k in range(max(1, len(ids) - window + 1)):
                w = tuple(ids[k:k + window])
                if w not in seen:
                    seen[w] = len(where)
                    where.append([])
                where[seen[w]].append((number[name], k))
        self.where = where
        self.lengths = np.array([len(w) for w in seen], np.int32)
        self.keys = np.zeros((len(seen), window), ">u4")
        for k, w in enumerate(seen):
            self.keys[k, :len(w)] = w
        self.starts = np.zeros(len(self.vocabulary) + 1, bool)
        if len(seen):
            self.starts[self.keys[:, 0].astype(np.int64)] = True
        n = len(self.vocabulary) + 1
        pairs = self.keys[self.lengths > 1][:, :2].astype(np.int64) if window > 1 else np.zeros((0, 2), np.int64)
        self.pairs = np.unique(pairs[:, 0] * n + pairs[:, 1]) if len(pairs) else np.zeros(0, np.int64)
        self.single = np.zeros(n, bool)
        self.single[self.keys[self.lengths == 1][:, 0].astype(np.int64)] = True

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, window) of every occurrence in the shard ``ids``."""
        n, none = len(self.vocabulary) + 1, (np.zeros(0, np.int64), np.zeros(0, np.int64))
        at = np.flatnonzero(self.starts[ids])
        if not len(at) or not len(self.keys):
            return none
        padded = np.concatenate([ids, np.zeros(self.window, ids.dtype)])
        pair = ids[at].astype(np.int64) * n + padded[at + 1]
        k = np.searchsorted(self.pairs, pair)
        ok = self.single[ids[at]]
        if len(self.pairs):
            ok = ok | (self.pairs[np.minimum(k, len(self.pairs) - 1)] == pair)
        at = at[ok]
        if not len(at):
            return none
        # the suffix array: starts in lexicographic order of their first words
        prefixes = padded[at[:, None] + np.arange(self.window)].astype(">u4")
        text = prefixes.view(f"S{4 * self.window}").ravel()
        order = np.argsort(text, kind="stable")
        at, text = at[order], text[order]
        high = self.keys.copy()
        high[np.arange(self.window)[None, :] >= self.lengths[:, None]] = 0xFFFFFFFF
        low = np.searchsorted(text, self.keys.view(f"S{4 * self.window}").ravel(), "left")
        up = np.searchsorted(text, high.view(f"S{4 * self.window}").ravel(), "right")
        # a byte string ignores trailing zeros, so a full window ends where larger ones begin
        size = np.maximum(up - low, 0)
        which = np.repeat(np.arange(len(self.keys)), size)
        first = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return at[first + np.arange(size.sum())], which


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _search(texts: list, index: Suffixes) -> list[tuple[int, list, list, list]]:
    """Per text: number of words, hit spans, items found, matches (item, item word, text word, words)."""
    docs = [words(t) for t in texts]
    get = index.vocabulary.get
    bounds = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])]).astype(np.int64)
    ids = np.zeros(int(bounds[-1]), np.int32)
    for d, b in zip(docs, bounds.tolist()):
        ids[b:b + len(d)] = [get(w, 0) for w in d]
    at, which = index.occurrences(ids)
    out = [(len(d), [], [], []) for d in docs]
    if not len(at):
        return out
    doc = np.searchsorted(bounds, at, "right") - 1
    order = np.lexsort((at, doc))
    at, which, doc = at[order], which[order], doc[order]
    edges = np.flatnonzero(np.diff(doc)) + 1
    for rows in np.split(np.arange(len(at)), edges):
        d = int(doc[rows[0]])
        n, base = len(docs[d]), int(bounds[d])
        cover = np.zeros(n + 1, np.int64)
        start = at[rows] - base
        np.add.at(cover, start, 1)
        np.add.at(cover, start + index.lengths[which[rows]], -1)
        hit = np.cumsum(cover)[:n] > 0
        open_: dict[tuple[int, int], list[int]] = {}  # (item, diagonal) -> the match that may go on
        found = []
        for s, w in zip(start.tolist(), which[rows].tolist()):
            size = int(index.lengths[w])
            for item, word in index.where[w]:
                last = open_.get((item, s - word))
                if last and last[2] + last[3] >= s:
                    last[3] = max(last[3], s + size - last[2])
                else:
                    open_[item, s - word] = m = [item, word, s, size]
                    found.append(m)
        out[d] = (n, _runs(hit), sorted({m[0] for m in found}), found)
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, chars: int) -> Iterator[list[tuple[str, str]]]:
    t = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null")
    total = t.agg(F.sum(F.char_length("t"))).first()[0] or 0
    n = max(1, -(-total // chars))
    for k in range(n):
        yield [tuple(r) for r in t.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()]


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
         window: int = WINDOW, shard_words: int = SHARD_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with one more column ``contamination``: n_words, n_hit, items, spans, matches."""
    spark = docs.sparkSession
    small_batches(spark)
    name = "contamination"
    span = "struct<first:int,last:int>"
    match = "struct<item_id:string,item_word:int,word:int,n_words:int>"
    kind = f"struct<n_words:bigint,spans:array<{span}>,items:array<string>,matches:array<{match}>>"
    out = docs.withColumn(name, F.lit(None).cast(kind))
    at, text_at = len(out.columns) - 1, docs.columns.index(text_col)
    for items in _blocks(benchmark, item_col, item_text, block_chars):
        sent = spark.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch], sent=sent, key=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            index = worker_cache(f"suffixes:{key}", lambda: Suffixes(sent.value, window))
            for batch in batches:
                texts = batch.column(text_at)
                sizes = np.array(pc.fill_null(pc.binary_length(texts), 0), np.int64) // 6 + 1
                shard = (np.cumsum(sizes) - sizes) // shard_words
                for s in np.unique(shard):
                    rows = np.flatnonzero(shard == s)
                    part = batch.slice(int(rows[0]), len(rows))
                    yield _add(part, at, _search(part.column(text_at).to_pylist(), index), index)

        out = out.mapInArrow(search, out.schema)
    c = F.col(name)
    length = lambda s: (s["last"] - s["first"]).cast("long")
    return out.withColumn(name, F.struct(
        c["n_words"].alias("n_words"), F.aggregate(c["spans"], F.lit(0).cast("long"), lambda a, s: a + length(s)).alias("n_hit"),
        c["items"].alias("items"), c["spans"].alias("spans"), c["matches"].alias("matches")))


def _add(batch: pa.RecordBatch, at: int, found: list, index: Suffixes) -> pa.RecordBatch:
    """The batch with what one more block of the benchmark hit."""
    out = []
    for old, (n, spans, items, matches) in zip(batch.column(at).to_pylist(), found):
        old = old or {"spans": [], "items": [], "matches": []}
        if old["spans"] and spans:
            mask = np.zeros(n, bool)
            for s in [*((x["first"], x["last"]) for x in old["spans"]), *spans]:
                mask[s[0]:s[1]] = True
            spans = _runs(mask)
        merged = [{"first": a, "last": b} for a, b in spans] or old["spans"]
        names = [index.names[i] for i in items]
        out.append({"n_words": n, "spans": merged, "items": sorted({*old["items"], *names}) if old["items"] else names,
                    "matches": old["matches"] + [{"item_id": index.names[i], "item_word": a, "word": b, "n_words": m} for i, a, b, m in matches]})
    cols = batch.columns
    cols[at] = pa.array(out, batch.schema.field(at).type)
    return pa.RecordBatch.from_arrays(cols, schema=batch.schema)


def contaminated():
    """The rule on the column ``contamination``: at least a twentieth of the words is hit."""
    c = F.col("contamination")
    return (c["n_hit"] > 0) & (20 * c["n_hit"] >= c["n_words"])


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Longest verbatim matches: (id, item_id, item_word, word, n_words)."""
    s = scan(docs, benchmark, **options)
    return s.select(id_col, F.explode("contamination.matches").alias("m")).select(id_col, "m.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, all columns unchanged."""
    return scan(docs, benchmark, **options).where(~contaminated()).drop("contamination")
