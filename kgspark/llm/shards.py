"""Training order: a keyed permutation gives every sequence its slot in fixed-stride binary shards.

Every task joins the ids of its documents, each closed by an end token, to one stream and cuts it into
sequences of ``capacity`` ids; only the last of a task is shorter. The sequences are stored once
and numbered 0..n-1 by task and place. A balanced Feistel network over the next even number of bits,
keyed and with cycle-walking back into the range, permutes these numbers: the slot of a sequence follows
from its number, the key and n, without a sort or a table. Slot s lies in shard s // ``per_shard`` at byte
(s % ``per_shard``) * stride, so a reader can go on from any slot. Sequences are dealt by ranges of slots and a task writes the
shards of its range in slot order; shards have a fixed size and slots are spread evenly, whatever the skew of the
documents.

A record is ``capacity`` little-endian uint16 ids, padded with ``PAD``, and a line end (stride 2 * capacity + 1). Spark's
own writer and commit protocol write the files, so a lost executor leaves no half shard.

Defined cases: an empty table writes no shard; a null text is the empty text (one end token); repeated or
null ``doc_id`` rows are written one by one; a text of any length runs on over as many sequences as it
needs; ids beyond 16 bits raise an error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kgspark.llm.common import small_batches
from kgspark.llm.packing import CAPACITY, END
from kgspark.llm.tokens import encoder
from kgspark.session import materialize

PER_SHARD, ROUNDS, PAD = 4096, 4, 0xFFFF
#: Bytes of records that one task writes at most, where the session has fewer shuffle partitions.
RANGE_BYTES = 1 << 30


def permute(number: np.ndarray, n: int, key: str, rounds: int = ROUNDS) -> np.ndarray:
    """Slots of the sequence numbers 0 <= number < n: a permutation of the range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "little")) for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            f = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        return left << np.uint64(half) | right

    with np.errstate(over="ignore"):
        out = once(np.asarray(number).astype(np.uint64))
        while (far := out >= np.uint64(n)).any():  # cycle-walking: the domain is under 4 n
            out[far] = once(out[far])
    return out.astype(np.int64)


def sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END,
              vocabulary: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """Stored (task, place, n_tokens, ids_crc32, ids, doc_ids, starts): ids are uint16, starts where each document begins."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, place = encoder(vocabulary, folder), TaskContext.get().partitionId(), 0
        if enc.full.get_vocab_size() > PAD:
            raise ValueError("token ids of 16 bits only")
        type_, ids, owners = None, np.zeros(0, "<u2"), []  # owners: (document, where its ids begin in the open sequence)
        names = ["task", "place", "n_tokens", "ids_crc32", "ids", "doc_ids", "starts"]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(type_), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        def row(part: np.ndarray) -> tuple:
            data = part.tobytes()
            return (task, place, len(part), zlib.crc32(data), data, [d for d, _ in owners], [a for _, a in owners])

        for b in batches:
            type_, out = b.column(0).type, []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                new = enc.ids(text.as_py())
                owners.append((doc, len(ids)))
                joined = np.empty(len(ids) + len(new) + 1, "<u2")
                joined[:len(ids)], joined[len(ids):-1], joined[-1] = ids, new, end
                ids = joined
                at = 0
                while len(ids) - at >= capacity:
                    out.append(row(ids[at:at + capacity]))
                    place, at = place + 1, at + capacity
                    owners = [(doc, 0)] if len(ids) > at else []
                ids = ids[at:]
                if len(out) >= 4096:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)
        if len(ids):
            yield batch([row(ids)])

    out = src.mapInArrow(cut, f"task int, place long, n_tokens long, ids_crc32 long, ids binary, doc_ids array<{kind}>, starts array<long>")
    # pages of many sequences compress better than single ones
    return materialize(out, "sequences", compression="zstd", **{"parquet.compression.codec.zstd.level": "6"})


def ordered(stored: DataFrame, key: str, per_shard: int = PER_SHARD, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Stored sequences with slot, shard and byte, and their number. One count per task goes through the driver."""
    counts = {r["task"]: r["n"] for r in stored.groupBy("task").agg(F.count("*").alias("n")).collect()}
    tasks = sorted(counts)
    first = dict(zip(tasks, accumulate([0, *(counts[t] for t in tasks)])))
    n, sent = sum(counts.values()), stored.sparkSession.sparkContext.broadcast(first)

    @F.pandas_udf("long")
    def slot(task: pd.Series, place: pd.Series) -> pd.Series:
        return pd.Series(permute(task.map(sent.value).to_numpy() + place.to_numpy(), n, key) if len(task) else np.zeros(0, np.int64))

    s = F.col("slot")
    return stored.withColumn("slot", slot("task", "place")).withColumns({
        "shard": F.floor(s / per_shard).cast("long"), "byte": s % per_shard * (2 * capacity + 1)}), n


def write_shards(placed: DataFrame, n: int, path: str, capacity: int = CAPACITY, per_shard: int = PER_SHARD) -> None:
    """Write the records under ``path``/shard=N, one file each, in slot order.

    The slots are cut into ranges of whole shards, one range for a task. The number of ranges follows the shuffle partitions
    of the session and the bytes, not the number of shards.
    """

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdCompressor(level=5, write_checksum=False)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([*map(z.compress, b.column(2).to_pylist())], pa.binary())], ["shard", "slot", "ids"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z, pad = zstandard.ZstdDecompressor(), np.full(capacity, PAD, "<u2").tobytes()
        for b in batches:
            out = [ids + pad[len(ids):] for ids in map(z.decompress, b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["shard", "record"])

    if n:
        shards = -(-n // per_shard)
        wanted = max(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), n * (2 * capacity + 1) // RANGE_BYTES)
        each = -(-shards // wanted)
        small = placed.select("shard", "slot", "ids").mapInArrow(squeeze, "shard long, slot long, ids binary")
        dealt = small.repartitionById(-(-shards // each), F.floor(F.col("shard") / each).cast("int")).sortWithinPartitions("slot")
        # raw bytes pass the text writer unchanged; it adds the line end that closes a record
        dealt.select("shard", "ids").mapInArrow(records, "shard long, record binary").select(
            "shard", F.col("record").cast("string").alias("value")).write.partitionBy("shard").option("compression", "none").text(path)


def read_records(spark: SparkSession, path: str, capacity: int = CAPACITY, per_shard: int = PER_SHARD, first_slot: int = 0) -> DataFrame:
    """(slot, n_tokens, ids) of the records from ``first_slot`` on; ids are little-endian uint16 without the padding. A shard is
    a file of fixed size, so earlier shards are not opened; a task takes as many as fit its split of the input."""
    stride = 2 * capacity + 1
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where(F.col("shard") >= first_slot // per_shard).select("shard", "content")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column(0), b.column(1)):
                data = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
                for k in range(0, len(data), 512):
                    ids = np.ascontiguousarray(data[k:k + 512, :-1]).view("<u2")
                    full = (ids != PAD).sum(1).tolist()  # the padding follows the ids
                    held = [r[:n].tobytes() for r, n in zip(ids, full)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(int(shard.as_py()) * per_shard + k + np.arange(len(ids)), pa.int64()),
                        pa.array(full, pa.int64()), pa.array(held, pa.binary())], ["slot", "n_tokens", "ids"])

    return files.mapInArrow(cut, "slot long, n_tokens long, ids binary").where(F.col("slot") >= first_slot)


def materialise(docs: DataFrame, path: str, key: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END,
                per_shard: int = PER_SHARD) -> DataFrame:
    """Tokenise ``docs``, write them in training order and return the index: one row per sequence with slot, shard, byte,
    n_tokens, ids_crc32, doc_ids (in order) and starts."""
    placed, n = ordered(sequences(docs, id_col, text_col, capacity, end), key, per_shard, capacity)
    write_shards(placed, n, path, capacity, per_shard)
    return placed.select("slot", "shard", "byte", "n_tokens", "ids_crc32", "doc_ids", "starts")


def verified(index: DataFrame, records: DataFrame) -> DataFrame:
    """The index with ``stored_crc32``, the checksum of what the shards hold at each slot."""

    @F.pandas_udf("long")
    def crc(ids: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(x) for x in ids], dtype="int64")

    held = records.select(F.col("slot"), crc("ids").alias("stored_crc32"))
    return index.join(held, "slot", "left")
