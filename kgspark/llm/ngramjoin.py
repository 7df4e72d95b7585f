"""Set similarity join on word n-grams: grouped prefix filter, verified on full sets.

Documents are sets of distinct three-word shingles; two are linked when their sets overlap in at least nine tenths of
their union. Shingles have a total order, rare ones first; two sets that are similar enough share a shingle among
their first ``n - ceil(0.9 n) + 1`` ones, their prefixes. Any order gives right results; this one comes from a table of 2^22 counters
over all texts, which tells shingles apart that many documents share.

Equal sets become one class, and classes of equal size and prefix one group. Groups, not documents, are posted under the
shingles of their prefixes; postings that meet no other one are dropped, and the rest are dealt out by (shingle, size band), where
sizes of linked sets lie in the same or the next band. There the groups of a bucket are filtered in pairs (sizes, and the
positions of the shingle in both prefixes bound the overlap), groups are expanded to their classes, and a parity bitmap of each class
(half as many bits as its set has shingles, or more) bounds the overlap again; both bounds are exact, so they lose nothing. What passes is verified
on the full sets, and links are joined to components.

A group of k near copies is never expanded into pairs: in the first round a class is tested against the nearest of the
others of its bucket, or, in large buckets, of those that stand for the others. Buckets with further pairs stay open. In the following
rounds every two components that meet in an open bucket are tested by
their nearest ``m`` pairs, ``m`` rising until no bucket holds back a pair. Large buckets are cut into blocks: classes outside the bucket's
largest component ask, in blocks, every block of the bucket. Links, components and buckets stay in stored tables.

Words are runs of characters other than white space (``\\x20 \\x09-\\x0D``) after lower-casing A-Z. A document of fewer than three
words is one shingle. Defined cases: null texts and texts without words have an empty set and are linked with nothing; repeated rows
are members of one class; a null ``doc_id`` takes part, and is the ``component_id`` only where all members have none; an
empty table gives an empty result; other columns are not read. Shingles are compared as 64-bit hashes, equal sets as 128-bit digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kgspark.llm.common import small_batches, units, whole_units
from kgspark.llm.components import components
from kgspark.llm.neardup import shingles
from kgspark.session import materialize

SHINGLE, PERCENT = 3, 90
CELL_BITS, BLOCK_CELLS = 22, 65536
#: Classes of a bucket that one task compares with one another, or asks at once.
CHUNK = 2048
#: Pairs of two components that are tested in the second round; later rounds take ``GROWTH`` times as many.
NEAREST, GROWTH = 8, 16
#: Rows that a task looks at together; rows of a bucket up to which all its pairs are; pairs held at once, and words of their bitmaps.
ROWS, SMALL, PAIRS, PAIR_WORDS = 20_000, 64, 200_000, 1 << 18
FILTER_BITS = 1 << 27
#: Texts whose sets are made at once.
SLICE = 64


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def cells(sets: np.ndarray) -> np.ndarray:
    return (sets >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def levels(docs: DataFrame, text_col: str, size: int) -> np.ndarray:
    """How common the shingles of each counter are, in half powers of two: 2^22 bytes."""
    src = docs.select(F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.uint32)
        for b in batches:
            for k in range(0, b.num_rows, SLICE):
                found = [shingles(t.as_py(), size) for t in b.column(0).slice(k, SLICE)]
                np.add.at(total, cells(np.concatenate(found)), np.uint32(1))
        for k in range(0, len(total), BLOCK_CELLS):
            if (part := total[k:k + BLOCK_CELLS]).any():  # what is common in one task is common enough
                yield pa.RecordBatch.from_arrays([pa.array([k // BLOCK_CELLS], pa.int32()), pa.array([np.minimum(part, 255).astype(np.uint8).tobytes()], pa.binary())], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in units(batches, 1):
            total = np.zeros(BLOCK_CELLS, np.int64)
            for c in t.column(1):
                total += np.frombuffer(c.as_buffer(), np.uint8)
            low = np.ceil(2 * np.log2(total + 1)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([t.column(0)[:1].combine_chunks(), pa.array([low.tobytes()], pa.binary())], ["block", "levels"])

    out = np.zeros(((1 << CELL_BITS) // BLOCK_CELLS, BLOCK_CELLS), np.uint8)
    for r in src.mapInArrow(count, "block int, counts binary").repartition("block").sortWithinPartitions("block").mapInArrow(add, "block int, levels binary").collect():
        out[r["block"]] = np.frombuffer(r["levels"], np.uint8)
    return out.ravel()


def parity(s: np.ndarray) -> bytes:
    """A bit for every shingle, or rather for an odd number of them; at least half as many bits as shingles."""
    width = 1 << max(6, (len(s) - 1).bit_length() - 1)
    return np.packbits(np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1, bitorder="little").tobytes()


def described(docs: DataFrame, level: np.ndarray, id_col: str, text_col: str, percent: int, size: int) -> DataFrame:
    """Stored (row, doc_id, th, n, fp, gp, prefix, bits): digests of the set and of size and prefix, the prefix, the bitmap."""
    sent = docs.sparkSession.sparkContext.broadcast(level)
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            for k in range(0, b.num_rows, SLICE):
                part, out = b.slice(k, SLICE), []
                for t in part.column(2):
                    s = shingles(t.as_py(), size)
                    if not len(s):
                        out.append((0, None, None, None, None))
                        continue
                    first = s[np.lexsort((s, sent.value[cells(s)]))[:prefix_size(len(s), percent)]]
                    out.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), xxhash.xxh3_128_digest(first.tobytes(), len(s)), first.view(np.int64), parity(s)))
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *map(pa.array, zip(*out), kinds)], ["doc_id", "th", "n", "fp", "gp", "prefix", "bits"])

    kind = src.schema["doc_id"].dataType.simpleString()
    found = src.mapInArrow(describe, f"doc_id {kind}, th long, n long, fp binary, gp binary, prefix array<long>, bits binary")
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "described")


def _buckets(nodes: DataFrame, percent: int) -> DataFrame:
    """Stored (token, band, g, n, at, held): groups under the shingles of their prefixes, of size band ``band`` (held) or the one above."""
    groups = nodes.groupBy("g").agg(F.count("*").alias("k"))
    posted = nodes.where("node = g").join(groups, "g").select("g", "n", "k", F.posexplode("prefix").alias("at", "token"))
    shared = posted.groupBy("token").agg(F.sum("k").alias("all")).where("all > 1").select("token")
    # a little less than the exact base, so that rounding never puts linked sizes two bands apart
    band = F.floor(F.log("n") * F.lit((1 - 1e-9) / log(100 / percent))).cast("int")
    both = posted.join(shared, "token").withColumn("own", band).withColumn("band", F.explode(F.array(F.col("own"), F.col("own") - 1)))
    both = materialize(both.select("token", "band", "g", "n", "k", "at", (F.col("own") == F.col("band")).alias("held")), "posted")
    # of two linked sets the smaller one, which is held, has the shingle in a prefix that is shorter still
    short = F.col("held") & (F.col("at") <= F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)))
    met = both.groupBy("token", "band").agg(F.sum("k").alias("all"), F.max(short).alias("any")).where("all > 1 and any").select("token", "band")
    return materialize(both.join(met, ["token", "band"]).drop("k"), "buckets")


class _Rows:
    """Rows of many buckets, as arrays: size, place of the shingle in the prefix, whether held, class, component, bitmap."""

    def __init__(self, t: pa.Table, percent: int):
        self.n, self.at, self.node, self.label = (t.column(c).to_numpy() for c in ("n", "at", "node", "label"))
        self.held, self.asks = (t.column(c).to_numpy(zero_copy_only=False) for c in ("held", "asks"))
        self.percent = percent
        bits = t.column("bits").combine_chunks()
        ends = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset:bits.offset + len(bits) + 1]
        self.begin, self.words = ends.astype(np.int64) // 8, np.frombuffer(bits.buffers()[2] or b"", np.uint64, ends[-1] // 8)

    def _bitmaps(self, rows: np.ndarray, size: int, width: int) -> np.ndarray:
        """Bitmaps of ``size`` words, folded to ``width``, which keeps parities."""
        out = self.words[self.begin[rows][:, None] + np.arange(size)]
        return np.bitwise_xor.reduce(out.reshape(len(rows), -1, width), 1)

    def near(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the row pairs (x, y) the bounds allow to be linked, and the number of bits that differ in these."""
        n, m = self.n[x], self.n[y]
        need = -(-self.percent * (n + m) // (100 + self.percent))  # so large must the overlap be
        ok = np.flatnonzero((self.held[x] | self.held[y]) & (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)) & (np.minimum(n - self.at[x], m - self.at[y]) >= need))
        x, y = x[ok], y[ok]
        one, two = self.begin[x + 1] - self.begin[x], self.begin[y + 1] - self.begin[y]
        differ = np.zeros(len(ok), np.int64)
        for size in np.unique(np.stack([one, two], 1), axis=0).tolist() if len(ok) else []:
            width = min(size)
            these = np.flatnonzero((one == size[0]) & (two == size[1]))
            for k in range(0, len(these), max(1, PAIR_WORDS // max(size))):
                part = these[k:k + max(1, PAIR_WORDS // max(size))]
                differ[part] = np.bitwise_count(self._bitmaps(x[part], size[0], width) ^ self._bitmaps(y[part], size[1], width)).sum(1, dtype=np.int64)
        keep = (n[ok] + m[ok] - differ) // 2 >= need[ok]
        return ok[keep], differ[keep]


def _inside(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All row pairs (earlier, later) of units, in blocks of bounded size."""
    for m in np.unique(sizes[sizes > 1]).tolist():
        one, two = np.triu_indices(m, 1)
        units_ = starts[sizes == m]
        for k in range(0, len(units_), max(1, PAIRS // len(one))):
            part = units_[k:k + max(1, PAIRS // len(one)), None]
            yield (part + one).ravel(), (part + two).ravel()


def _first_pairs(r: _Rows, starts: np.ndarray, sizes: np.ndarray, blocks: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Every class with the nearest earlier one of its bucket (of large buckets: of those that stand for earlier ones, so that a
    group of near copies is no matter of its square), and the units in which more pairs may be linked."""
    found, open_ = [], set(np.flatnonzero(blocks > 1).tolist())
    unit = np.repeat(np.arange(len(sizes)), sizes)
    small = sizes <= SMALL
    for x, y in _inside(starts[small], sizes[small]):
        keep, differ = r.near(x, y)
        x, y = x[keep], y[keep]
        order = np.lexsort((x, differ, y))
        x, y = x[order], y[order]
        new = np.concatenate([[True], y[1:] != y[:-1]])[:len(y)]
        found += zip(r.node[x[new]].tolist(), r.node[y[new]].tolist())
        open_.update(unit[y[~new]].tolist())
    for k in np.flatnonzero(~small).tolist():
        stand = np.empty(sizes[k], np.int64)
        many = 0
        for y in range(starts[k], starts[k] + sizes[k]):
            keep, differ = r.near(stand[:many], np.full(many, y))
            if len(keep):
                found.append((int(r.node[stand[keep[differ.argmin()]]]), int(r.node[y])))
            else:
                stand[many] = y
                many += 1
        open_.add(k)
    return found, np.array(sorted(open_), np.int64)


def _nearest_pairs(r: _Rows, starts: np.ndarray, sizes: np.ndarray, most: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """The nearest ``most`` pairs of every two components of a unit, and the units that hold back pairs."""
    unit, parts, kept, back = np.repeat(np.arange(len(sizes)), sizes), [], 0, set()

    def cut(parts: list[np.ndarray]) -> np.ndarray:
        x = np.concatenate(parts) if parts else np.zeros((0, 6), np.int64)  # unit, label, label, bits that differ, node, node
        x = np.unique(x, axis=0)  # in this order
        new = np.concatenate([[True], (x[1:, :3] != x[:-1, :3]).any(1)])[:len(x)]
        rank = np.arange(len(x)) - np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))
        back.update(x[rank >= most, 0].tolist())
        return x[rank < most]

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        small = sizes <= SMALL
        yield from _inside(starts[small], sizes[small])
        for k in np.flatnonzero(~small).tolist():
            rows = np.arange(starts[k], starts[k] + sizes[k])
            for y in rows[r.asks[rows]]:
                yield rows, np.full(len(rows), y)

    for x, y in pairs():
        ok = (r.asks[x] != r.asks[y]) & (r.label[x] != r.label[y])
        x, y = x[ok], y[ok]
        keep, differ = r.near(x, y)
        if len(keep):
            x, y = x[keep], y[keep]
            low = lambda a: (np.minimum(a[x], a[y]), np.maximum(a[x], a[y]))  # noqa: B023, E731
            parts.append(np.stack([unit[y], *low(r.label), differ, *low(r.node)], 1))
            kept += len(keep)
            if kept > PAIRS:
                parts = [cut(parts)]
                kept = 0
    return list({(a, b) for a, b in cut(parts)[:, 4:].tolist()}), np.array(sorted(back), np.int64)


def _round(buckets: DataFrame, nodes: DataFrame, label: DataFrame | None, percent: int, most: int) -> DataFrame:
    """Stored rows: pairs (a, b) to be verified, and buckets (token, band) that hold back more."""
    member = nodes.select("g", "node", "bits")
    key, cols = ["token", "band"], ["n", "at", "held", "node", "label", "bits", "asks", "blocks"]
    if label is None:
        here = buckets.join(member.withColumn("label", F.col("node")).withColumn("asks", F.lit(True)), "g")
        size = here.groupBy(key).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("blocks")).where("blocks > 1")
        dealt = here.join(size, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("part", F.lit(0))
    else:
        named = nodes.select("g", "node").join(label, "node", "left").select("g", "node", F.coalesce("label", "node").alias("label"))
        here = materialize(buckets.join(named, "g"), "members")
        count = here.groupBy(*key, "label").agg(F.count("*").alias("k"))
        whole = count.groupBy(key).agg(F.count("*").alias("labels"), F.max_by("label", F.struct("k", "label")).alias("main"), F.sum("k").alias("k"), F.max("k").alias("top")).where("labels > 1")
        whole = whole.select(*key, "main", F.ceil(F.col("k") / CHUNK).cast("int").alias("blocks"), F.ceil((F.col("k") - F.col("top")) / CHUNK).cast("int").alias("parts"))
        open_ = here.join(whole, key).join(nodes.select("node", "bits"), "node")
        block, part = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
        both = [*key, "block", "part", *cols]
        held = open_.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("asks", F.lit(False)).select(both)
        asked = open_.where("label != main").withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(True)).select(both)
        dealt = held.union(asked)
    key = [*key, "block", "part"]
    dealt = dealt.select(*key, *cols).repartition(*key).sortWithinPartitions(*key, "node", "asks")
    first = label is None

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_units(batches, 4, ROWS):
            token, band = t.column("token").to_numpy(), t.column("band").to_numpy()
            keys = [token, band, t.column("block").to_numpy(), t.column("part").to_numpy()]
            starts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in keys])]))
            sizes = np.diff(np.append(starts, t.num_rows))
            r = _Rows(t, percent)
            pairs, open_ = _first_pairs(r, starts, sizes, t.column("blocks").to_numpy()[starts]) if first else _nearest_pairs(r, starts, sizes, most)
            x, at = np.array(pairs, np.int64).reshape(-1, 2), starts[open_]
            none = lambda k, type_: pa.nulls(k, type_)
            yield pa.RecordBatch.from_arrays([pa.array(x.min(1)), pa.array(x.max(1)), none(len(x), pa.int64()), none(len(x), pa.int32())], ["a", "b", "token", "band"])
            yield pa.RecordBatch.from_arrays([none(len(at), pa.int64()), none(len(at), pa.int64()), pa.array(token[at]), pa.array(band[at])], ["a", "b", "token", "band"])

    return materialize(dealt.mapInArrow(compare, "a long, b long, token long, band int").distinct(), "pairs")


def _sets(docs: DataFrame, need: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Stored (node, s): the full sets of the classes ``need`` (node, doc_id, th), from one more pass over the texts.

    A bitmap of text hashes, of bounded size, lets only those texts through (and now and then another, which the join drops).
    """
    slot = F.col("th").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1  # bitmaps count from 1
    bits = need.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("b")).collect()
    sent = docs.sparkSession.sparkContext.broadcast({r["k"]: bytes(r["b"]) for r in bits})
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("h"), text.alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((FILTER_BITS >> 15, 4096), np.uint8)  # pages of zeros take no memory
        for k, b in sent.value.items():
            table[k - 1] = np.frombuffer(b, np.uint8)
        for b in batches:
            h = b.column(1).to_numpy() & (FILTER_BITS - 1)
            rows = np.flatnonzero((table[h >> 15, (h & 32767) >> 3] >> (h & 7).astype(np.uint8)) & 1)
            for k in range(0, len(rows), SLICE):
                part = b.take(pa.array(rows[k:k + SLICE]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([shingles(t.as_py(), size).tobytes() for t in part.column(2)], pa.binary())], ["d", "h", "s"])

    full = src.mapInArrow(sets, f"d {src.schema['d'].dataType.simpleString()}, h long, s binary")
    found = full.join(need, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("th"))).select("node", "s")
    return materialize(found.dropDuplicates(["node"]), "sets")  # repeated rows have equal sets


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored pairs (a, b) whose full sets are similar enough."""
    one, two = (sets.select(F.col("node").alias(c), F.col("s").alias(f"s{c}")) for c in ("a", "b"))
    both = pairs.join(two, "b").join(one, "a").select("a", "b", "sa", "sb")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return materialize(both.mapInArrow(check, "a long, b long"), "links")


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, label) for every row of ``docs``; ``label`` tells components apart also where ids are null or repeated."""
    small_batches(docs.sparkSession)
    rows = described(docs, levels(docs, text_col, size), id_col, text_col, percent, size)
    classes = rows.where("fp is not null").groupBy("fp").agg(F.min("row").alias("node"), F.min("doc_id").alias("low"))
    members = rows.select("row", "doc_id", "th", "n", "fp").join(classes, "fp", "left").drop("fp")
    members = materialize(members.withColumn("low", F.coalesce("low", "doc_id")), "classes")
    only = rows.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    groups = only.groupBy("gp").agg(F.min("row").alias("g"))
    nodes = materialize(only.join(groups, "gp").select(F.col("row").alias("node"), "g", "n", "doc_id", "th", F.when(F.col("row") == F.col("g"), F.col("prefix")).alias("prefix"), "bits"), "groups")
    buckets = _buckets(nodes, percent)
    label, links, tested, sets, most = None, None, None, None, NEAREST
    while True:
        pairs = _round(buckets, nodes, label, percent, most)
        # buckets all of whose pairs have been looked at are done
        buckets = buckets.join(pairs.where("a IS NULL").select("token", "band").distinct(), ["token", "band"], "left_semi")
        more = not pairs.where("a IS NULL").isEmpty()
        fresh = pairs.where("a IS NOT NULL").select("a", "b")
        if tested is not None:
            fresh = materialize(fresh.join(tested, ["a", "b"], "left_anti"), "fresh")
        if not fresh.isEmpty():
            need = fresh.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            need = need.join(nodes.select("node", "doc_id", "th"), "node")
            if sets is not None:
                need = need.join(sets, "node", "left_anti")
            found = _sets(docs, need, id_col, text_col, size)
            sets = found if sets is None else sets.union(found)
            linked = _verified(fresh, sets, percent)
            tested = fresh if tested is None else tested.union(fresh)
            links = linked if links is None else links.union(linked)
            new = components(links)
        else:
            new = label
        most, label = most if label is None else most * GROWTH, new if new is not None else nodes.select("node", F.col("node").alias("label")).limit(0)
        if not more:
            break
    low = members.where("row = node").select("node", "low").join(label, "node").groupBy("label").agg(F.min("low").alias("least"))
    final = label.join(low, "label").select(F.col("node").alias("v"), "least", "label")
    return members.join(final, F.col("node") == F.col("v"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "low").alias("component_id"), F.coalesce("label", "node").alias("label"))


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    return join_components(docs, id_col, text_col, percent, size).drop("label")
