"""Best-fit packing of token pieces into sequences of fixed capacity.

Best-fit decreasing takes the pieces longest first and puts each into the tightest open bin. Pieces
of one length are interchangeable, so the whole run follows from the number of pieces of each length:
a histogram of at most ``capacity`` rows, whatever the corpus. The driver runs best-fit decreasing on
it with a segment tree over remaining capacities (logarithmic search of the tightest open bin, and
bins of one state are kept as ranges of sequence ids), which yields the very packing of the
one-by-one algorithm as at most a few rows per length. Every piece then finds its place from its
length and its rank among the pieces of that length, which Spark numbers in hash buckets with
per-bucket offsets: no task ever holds a whole length, source or document group.

Defined cases: null text is the empty text and yields one piece holding only the end token; null or
repeated ``doc_id`` rows are packed one by one like any other row; an empty table gives an empty
result; a text longer than a sequence is cut into full pieces, the first taking the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kgspark.llm.common import small_batches
from kgspark.llm.tokens import cut, encoder
from kgspark.session import materialize

CAPACITY, END = 1024, 2
BUCKET_ROWS = 100_000


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END,
                 with_ids: bool = False, vocabulary: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of every document's ids plus the end token."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, folder)
        for batch in batches:
            row, out = [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(enc.ids(text.as_py()), np.uint32(end)).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    part = ids[s:s + n].tobytes()
                    row.append(i)
                    out.append((k, s, n, zlib.crc32(part), part))
            cols = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:4 + with_ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids])

    return src.mapInArrow(pieces, schema)


class Tightest:
    """Segment tree over remaining capacities: is a bin open, and which is the smallest capacity >= s with one."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.open = [False] * (2 * self.size)

    def set(self, at: int, value: bool) -> None:
        i = at + self.size
        self.open[i] = value
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def find(self, least: int) -> int:
        """Smallest capacity >= ``least`` with an open bin, else -1."""
        i = least + self.size
        if self.open[i]:
            return least
        while i > 1 and not (i % 2 == 0 and self.open[i + 1]):
            i //= 2
        if i <= 1:
            return -1
        i += 1
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, offset) of best-fit decreasing.

    The pieces of ``length`` with ranks from ``first rank`` up to the next row's go, ``pieces per
    sequence`` at a time, to the sequences from ``first sequence`` on, the first at ``offset``.
    """
    tree = Tightest(capacity)
    bins: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> ranges (first sequence, number)
    plan, fresh = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            bins.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted((n for n in histogram if histogram[n]), reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.find(length)
            if room < 0:
                room, each = capacity, capacity // length
                first, have = fresh, -(-left // each)
                fresh += have
            else:
                first, have = bins[room].pop()
                if not bins[room]:
                    tree.set(room, False)
            each = room // length
            full = min(have, left // each)
            if full:
                plan.append((length, rank, first, each, capacity - room))
                rank, left = rank + full * each, left - full * each
                put(room - each * length, first, full)
            if full < have and 0 < left < each:
                plan.append((length, rank, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(room, first + full, have - full)
    return np.array(plan, np.int64).reshape(-1, 5)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, key: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (stored; column length) with sequence_id and offset by best-fit decreasing."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(best_fit_plan(counts, capacity))
    n_buckets = max(32, sum(counts.values()) // BUCKET_ROWS)
    bucketed = pieces.withColumn("__b", F.pmod(F.xxhash64(*key), F.lit(n_buckets)))
    sizes = bucketed.groupBy("length", "__b").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    within = Window.partitionBy("length", "__b").orderBy(*key)
    ranked = bucketed.withColumn("__r", F.row_number().over(within) - 1).join(offsets, ["length", "__b"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rows = plan.value
        if not len(length):
            return pd.DataFrame({"sequence_id": [], "offset": []}, dtype="int64")
        # rows sorted by (length descending, first rank): one search over a combined key
        wide = int(rank.max() if len(rank) else 0) + int(rows[:, 1].max()) + 2
        keys = -rows[:, 0] * wide + rows[:, 1]
        row = rows[np.searchsorted(keys, -length.to_numpy() * wide + rank.to_numpy(), "right") - 1]
        at = rank.to_numpy() - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 2] + at // row[:, 3], "offset": row[:, 4] + at % row[:, 3] * length.to_numpy()})

    cols = [F.col(c) for c in pieces.columns]
    return ranked.withColumn("__p", place("length", F.col("__o") + F.col("__r"))).select(
        *cols, F.col("__p.sequence_id").alias("sequence_id"), F.col("__p.offset").alias("offset"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END,
                   with_ids: bool = False, **tokens) -> DataFrame:
    """Every piece of every document with its sequence and place there. The pieces are tokenised once and stored."""
    return place_pieces(materialize(token_pieces(docs, id_col, text_col, capacity, end, with_ids, **tokens), "pieces"), capacity)
