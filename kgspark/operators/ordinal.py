"""Row numbers and byte-bounded chunks over whole tables: prefix sums on two levels, no global window.

Rows are put into buckets whose order is the order of the rows: row numbers cut the key space at bounds that
Spark samples, chunks cut a graph's hash space into as many equal shares as its bytes ask for. Buckets are summed up, the sums of
the buckets before one are its offset, and inside a bucket the rows follow one another. A graph
holding all rows is spread over as many tasks as a thousand small ones.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from kgspark.session import materialize

#: Bits of the place of a row within its task in ``monotonically_increasing_id``.
PLACE_BITS = 33
#: Chunks that one bucket of a graph holds.
CHUNKS = 16
#: Bits that hold the length of a line.
LENGTH_BITS = 36


def with_ordinal(df: DataFrame, order: list[str], name: str = "n", start: int = 1, by: list[str] | None = None) -> DataFrame:
    """Running number over the table in ``order``, or within each group ``by``. Ties are numbered in any order, but once and for all.

    The rows are stored in ranges of (by, order); one count per range passes through the driver. The number within a group
    is the number over the table less the group's first one.
    """
    spark, by = df.sparkSession, by or []
    keys = [F.col(c) for c in [*by, *order]]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = materialize(df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id()), "ordinals")
    part = F.shiftright("__id", PLACE_BITS).cast("int")
    counts = sorted((r["part"], r["n"]) for r in stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = zip((p for p, _ in counts), accumulate([0, *(n for _, n in counts)]))
    offsets = spark.createDataFrame(list(before), "__part int, __off bigint")
    out = stored.withColumn("__part", part).join(F.broadcast(offsets), "__part")  # one row per range
    number = F.col("__id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + F.col("__off")
    if not by:
        return out.select(*df.columns, (number + start).alias(name))
    out = out.withColumn("__at", number)
    first = out.groupBy(*[F.col(c).alias(f"__by_{c}") for c in by]).agg(F.min("__at").alias("__first"))
    same = [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by]
    return out.join(first, same).select(*df.columns, (F.col("__at") - F.col("__first") + start).alias(name))


def chunk_lines(lines: DataFrame, target_bytes: int, by: str = "graph", line: str = "line", text: bool = True) -> DataFrame:
    """Chunk number of every line of a graph, chunks of about ``target_bytes``.

    A graph is a set, so its lines are put in the order of their hashes, which fill equal shares of the hash space
    equally whatever the lines look like. Without ``text`` a line is given by its length as ``bytes``, line end included: only its hash and
    length are shuffled.
    """
    digest = F.sha1(F.col(line))
    number = lambda start, digits: F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")
    size, share = (F.octet_length(line) + 1).cast("bigint"), F.shiftright("__h", 28).cast("double") / float(1 << 32)
    if text:
        h = lines.select(by, line, number(1, 15).alias("__h"), number(16, 15).alias("__t"), size.alias("__len"))
    else:
        # two numbers a line: 60 bits of the hash, then 24 more above the length
        h = lines.select(by, number(1, 15).alias("__h"), F.shiftleft(number(16, 6), LENGTH_BITS).bitwiseOR(size).alias("__t"))
        h = h.select(by, "__h", "__t", F.col("__t").bitwiseAND(F.lit((1 << LENGTH_BITS) - 1)).alias("__len"))
    # stored, so that its size is known and the lines are not shuffled to meet it
    buckets = materialize(h.groupBy(by).agg(F.ceil(F.sum("__len") / (CHUNKS * target_bytes)).alias("__buckets")), "buckets")
    h = h.join(buckets, by).withColumn("__b", F.floor(share * F.col("__buckets"))).drop("__buckets")
    sums = h.groupBy(by, "__b").agg(F.sum("__len").alias("__sum"))
    before = Window.partitionBy(by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(by, "__b", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(by, "__b").orderBy("__h", "__t").rowsBetween(Window.unboundedPreceding, -1)
    dealt = h if text else h.drop("__len").repartition(by, "__b").withColumn("__len", F.col("__t").bitwiseAND(F.lit((1 << LENGTH_BITS) - 1)))
    upto = F.coalesce(F.sum("__len").over(inside), F.lit(0))
    out = dealt.withColumn("__upto", upto).join(offsets, [by, "__b"])
    return out.select(by, line if text else F.col("__len").alias("bytes"), F.floor((F.col("__off") + F.col("__upto")) / target_bytes).cast("bigint").alias("chunk"))
