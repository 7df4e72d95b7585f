"""Hard negatives by a secondary sort: (anchor, descending score, id) keys, windows opened by positives.

An anchor's positives are its ``positives`` first other rows of the same label, by falling score and then
smaller id. Every positive with score p opens a window of scores from ``low`` to ``high`` percent of p, and the first
``negatives`` rows of other labels in it are its hard negatives. Scores are integer inner products.

Anchors are a query set against all rows, both cut into blocks of bounded size; a task scores one block of
anchors against one block of rows. Nothing that could be returned is lost before the shuffle: a block gives out its best
``positives`` rows of an anchor's label, and, once the positives' scores are known, the best ``negatives`` rows of
every window. These pairs are packed into one binary key each (anchor, score reversed, positives first, id, row),
dealt out by anchor with ``repartitionAndSortWithinPartitions``, and read as one sorted stream: a positive
opens a window, a negative goes to the open windows it lies in, a window closes when it is full or the scores have fallen
below it. No anchor is held in memory.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part; a null
id is no anchor, comes last among ties and may be returned; repeated rows are rows of their own (a copy of the anchor is one
of its positives); vectors are compared with those of their own length only; scores beyond 64 bits count as the nearest
64-bit number; a positive with a negative score counts as positive and its window is empty; an anchor without
positives or without negatives in its windows has no rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kgspark.llm.common import units
from kgspark.session import materialize

#: Vector components of the rows that a task holds at once, and anchors it scores them with.
BLOCK_VALUES, BLOCK_ANCHORS = 1 << 18, 256
LONG = 1 << 63
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def valid(vec: Column, label: Column) -> Column:
    """Whether a row takes part."""
    infinity = F.lit(float("inf"))
    return F.coalesce(label.isNotNull() & vec.isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != infinity)), F.lit(False))


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, exact; beyond 64 bits the nearest 64-bit number."""
    top = int(max(anchors.max(initial=0), -int(anchors.min(initial=0)))) * int(max(rows.max(initial=0), -int(rows.min(initial=0)))) * max(1, anchors.shape[1])
    if top < 1 << 53:
        return np.rint(anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if top < LONG:
        return anchors @ rows.T
    return np.clip(anchors.astype(object) @ rows.astype(object).T, -LONG, LONG - 1).astype(np.int64)


def _matrix(t: pa.Table, dim: int) -> np.ndarray:
    return t.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(t.num_rows, dim)


def _scored(units_: Iterable[pa.Table]) -> Iterator[tuple[pa.Table, pa.Table, np.ndarray, np.ndarray]]:
    """(anchors, rows, scores, same label) of each unit; rows are in the order of (id, row)."""
    for t in units_:
        asks = t.column("asks").to_numpy()
        anchors, rows = t.filter(pa.array(asks)), t.filter(pa.array(~asks))
        if anchors.num_rows and rows.num_rows:
            dim = t.column("dim")[0].as_py()
            known = {x: k for k, x in enumerate(t.column("label").unique().to_pylist())}
            one, two = (np.array([known[x] for x in part.column("label").to_pylist()]) for part in (anchors, rows))
            yield anchors, rows, scores(_matrix(anchors, dim), _matrix(rows, dim)), one[:, None] == two[None, :]


def pack(anchor: int, anchor_row: int, score: int, kind: int, id_: int | None, row: int) -> bytes:
    """A key whose byte order is: anchor, score from high to low, positives (kind 0) first, id (null last), row."""
    return b"".join(((anchor + LONG).to_bytes(8), anchor_row.to_bytes(8), (LONG - 1 - score).to_bytes(8), bytes((kind, id_ is None)),
                     ((id_ or 0) + LONG).to_bytes(8), row.to_bytes(8)))


def unpack(key: bytes) -> tuple[bytes, int, int, int, int | None]:
    """(anchor and its row as packed, anchor id, score, kind, id) of a key."""
    n = int.from_bytes
    return key[:16], n(key[:8]) - LONG, LONG - 1 - n(key[16:24]), key[24], None if key[25] else n(key[26:34]) - LONG


def windows(keys: Iterable[bytes], positives: int, negatives: int, low: int, high: int) -> Iterator[tuple]:
    """The hard negatives of sorted keys, as they pass."""
    last, seen, open_ = None, 0, []
    for key in keys:
        anchor, anchor_id, score, kind, id_ = unpack(key)
        if anchor != last:
            last, seen, open_ = anchor, 0, []
        if kind == 0:
            seen += 1
            if seen <= positives and score >= 0:
                open_.append([score, id_, 0])
            continue
        closed = False
        for w in open_:
            if 100 * score < low * w[0] or w[2] == negatives:
                closed = True
            elif 100 * score <= high * w[0]:
                w[2] += 1
                yield anchor_id, w[1], w[2], id_, w[0], score
        if closed:
            open_ = [w for w in open_ if 100 * score >= low * w[0] and w[2] < negatives]


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = 256,
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows for which ``anchors`` holds.

    Ids are whole numbers; components become ``floor(scale * x)`` with x as double.
    """
    spark = vectors.sparkSession
    vec, label = F.col(vec_col), F.col(label_col)
    rows = vectors.where(valid(vec, label)).select(
        F.col(id_col).cast("long").alias("id"), label.alias("label"), F.coalesce(anchors & F.col(id_col).isNotNull(), F.lit(False)).alias("asks"),
        F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("vec"))
    # stored, so that row numbers stay the same when a task runs again
    rows = materialize(rows.withColumn("dim", F.size("vec")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = rows.groupBy("dim").agg(F.ceil(F.count("*") * F.greatest("dim", F.lit(1)) / BLOCK_VALUES).cast("int").alias("nr"),
                                   F.ceil(F.count_if("asks") / BLOCK_ANCHORS).cast("int").alias("na")).where("na > 0")
    placed = rows.join(size, "dim").withColumn("r", F.pmod(F.xxhash64("row"), F.col("nr")).cast("int")).withColumn("a", F.pmod(F.xxhash64("row", F.lit(1)), F.col("na")).cast("int"))
    cols = ["dim", "r", "a", "asks", "id", "row", "label", "vec"]
    every = placed.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("na") - 1))).withColumn("asks", F.lit(False)).select(cols)
    ask = placed.where("asks").withColumn("r", F.explode(F.sequence(F.lit(0), F.col("nr") - 1))).select(cols)

    def dealt(asking: DataFrame) -> DataFrame:
        rest = [c for c in asking.columns if c not in cols]
        both = every.select(*cols, *(F.lit(None).cast(asking.schema[c].dataType).alias(c) for c in rest)).union(asking)
        return both.repartition("dim", "r", "a").sortWithinPartitions("dim", "r", "a", F.col("id").asc_nulls_last(), "row")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for asking, held, s, same in _scored(units(batches, 3)):
            ids, at = held.column("id").to_pylist(), held.column("row").to_numpy()
            out = []
            for k, (anchor, row) in enumerate(zip(asking.column("id").to_pylist(), asking.column("row").to_pylist())):
                mine_ = np.flatnonzero(same[k] & (at != row))
                for j in mine_[np.argsort(~s[k, mine_], kind="stable")[:positives]]:  # ~x falls as x rises, without overflow
                    out.append((anchor, row, int(s[k, j]), ids[j], int(at[j])))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], ["anchor", "arow", "score", "id", "row"])

    found = dealt(ask).mapInArrow(best, "anchor long, arow long, score long, id long, row long")
    rank = F.row_number().over(Window.partitionBy("arow").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row"))
    first = materialize(found.withColumn("k", rank).where(F.col("k") <= positives).drop("k"), "positives")
    opened = first.where("score >= 0").groupBy("arow").agg(F.collect_set("score").alias("opened"))  # at most ``positives`` of them

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for asking, held, s, same in _scored(units(batches, 3)):
            ids, at, out = held.column("id").to_pylist(), held.column("row").to_numpy(), []
            for k, (anchor, row, each) in enumerate(zip(asking.column("id").to_pylist(), asking.column("row").to_pylist(), asking.column("opened").to_pylist())):
                bounds = [(-(-low * p // 100), min(high * p // 100, LONG - 1)) for p in each]
                other = np.flatnonzero(~same[k] & (s[k] >= min(x for x, _ in bounds)) & (s[k] <= max(y for _, y in bounds)))
                falling = ~s[k, other]
                order = np.argsort(falling, kind="stable")
                falling, other, keep = falling[order], other[order], set()
                for lowest, highest in bounds:
                    begin, end = np.searchsorted(falling, ~highest, "left"), np.searchsorted(falling, ~lowest, "right")
                    keep.update(other[begin:min(end, begin + negatives)].tolist())
                out += [pack(anchor, row, int(s[k, j]), 1, ids[j], int(at[j])) for j in keep]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["key"])

    ask = ask.join(opened.withColumnRenamed("arow", "row"), "row").select(*cols, "opened")
    behind = dealt(ask).mapInArrow(inside, "key binary").rdd.map(lambda r: (bytes(r[0]), None))
    ahead = first.rdd.map(lambda r: (pack(r["anchor"], r["arow"], r["score"], 0, r["id"], r["row"]), None))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt_keys = ahead.union(behind).repartitionAndSortWithinPartitions(n, lambda key: int.from_bytes(key[8:16]) * 0x9E3779B97F4A7C15 >> 32 & 0x7FFFFFFF)
    return spark.createDataFrame(dealt_keys.mapPartitions(lambda part: windows((k for k, _ in part), positives, negatives, low, high)), RESULT, verifySchema=False)
