"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows handed to a Python worker at once: with texts of 100 kB a batch stays near 50 MB.
BATCH_ROWS = 512

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the Arrow batch size of the session (never raise it)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def worker_cache(key: str, make):
    """What a Python worker builds once (a tokenizer, a broadcast index) and reuses for later tasks."""
    store = sys.__dict__.setdefault("_kgspark_worker_cache", {})
    if key not in store:
        store[key] = make()
    return store[key]


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that where a text is pure ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def as_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def units(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows that agree in the first ``keys`` columns, which are sorted, as one table each."""
    held, last = [], None
    for b in batches:
        if not b.num_rows:
            continue
        cols = np.stack([b.column(k).to_numpy() for k in range(keys)])
        cuts = [0, *(np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(0)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            key = cols[:, lo].tolist()
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def whole_units(batches: Iterable[pa.RecordBatch], keys: int, rows: int) -> Iterator[pa.Table]:
    """Tables of some ``rows`` rows that hold whole units: all rows that agree in the first ``keys`` columns, which are sorted."""
    held, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n >= rows:
            t = pa.Table.from_batches(held).combine_chunks()
            cols = [t.column(k).to_numpy() for k in range(keys)]
            last = np.flatnonzero(np.logical_or.reduce([c[:-1] != c[-1] for c in cols]))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last unit may go on
            if cut:
                yield t.slice(0, cut)
                held, n = t.slice(cut).to_batches(), n - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
