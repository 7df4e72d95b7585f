"""Connected components of a link table by alternating star contractions, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kgspark.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): label is the smallest node reachable.

    Each round hangs the larger neighbours of a node, then the smaller ones, on the smallest; the
    number of rounds grows with the logarithm of the longest chain. Every round is stored, hubs are split by the
    adaptive skew join, and the loop ends when a round changes no link.
    """
    e = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = _state(e)
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parent, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.union(parent.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
