"""Exact duplicates by content-defined chunk recipes, with DataFrame functions only.

A text is cut where its own content says so (after a white space that follows two letters of given
ranges, at least ``MIN`` and at most ``MAX`` characters apart), so equal texts have equal cuts. Chunks
are de-duplicated to identifiers: the 64-bit hash of the chunk, plus a variant number wherever the
stored chunk texts show that one hash stands for several of them. A document's recipe is its ordered
list of identifiers; documents are equal exactly if their recipes are. Only distinct chunks move with
their text, once, pre-aggregated before the shuffle; documents move as recipes. Groups are counted
with partial aggregation and joined back, so a huge group is split by the adaptive skew join.

Defined cases: null text is the empty text; rows with a null ``doc_id`` take part like others, a group
of nothing but such rows keeps one of them and has a null ``keep_id``; repeated rows (same ``doc_id`` and text)
count each in ``group_size`` and one row of them may stay; the largest ``doc_id`` of a group stays;
an empty table gives an empty result. Texts of any length are cut into bounded chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kgspark.llm.common import ascii_lower
from kgspark.session import materialize

MIN, MAX = 512, 4096
CUT = r"(?s).{%d,%d}?(?<=[a-m][n-z]\s)|.{1,%d}" % (MIN, MAX, MAX)


def normal(text: Column) -> Column:
    return ascii_lower(F.coalesce(text.cast("string"), F.lit("")))


def chunks(text: Column) -> Column:
    """Content-defined chunks of a normalised text, in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(CUT), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, ids, fix, text_sha256): ids are chunk hashes, fix tells variants of clashing hashes apart."""
    src = docs.select(F.col(id_col).alias("doc_id"), normal(F.col(text_col)).alias("t"))
    plain = materialize(src.select(
        "doc_id", F.monotonically_increasing_id().alias("row"),
        F.transform(chunks(F.col("t")), lambda c: F.xxhash64(c)).alias("ids"), F.sha2("t", 256).alias("text_sha256")), "recipes")
    parts = src.select("doc_id", F.sha2("t", 256).alias("text_sha256"), F.posexplode(chunks(F.col("t"))).alias("pos", "c"))
    known = parts.select(F.xxhash64("c").alias("h"), "c").distinct()
    clash = materialize(known.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "clashes")
    if clash.isEmpty():
        return plain.withColumn("fix", F.expr("cast(array() as array<struct<pos:int,v:int>>)"))
    variant = known.join(clash, "h", "left_semi").withColumn("v", F.row_number().over(Window.partitionBy("h").orderBy("c")))
    fix = (parts.withColumn("h", F.xxhash64("c")).join(variant, ["h", "c"]).select("doc_id", "text_sha256", "pos", "v").distinct()
           .groupBy("doc_id", "text_sha256").agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("fix"))
           .select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("s"), "fix"))
    return plain.join(fix, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_sha256") == F.col("s")), "left").select(
        "doc_id", "row", "ids", "text_sha256",
        F.coalesce("fix", F.expr("cast(array() as array<struct<pos:int,v:int>>)")).alias("fix"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    r = recipes(docs, id_col, text_col)
    groups = r.groupBy("ids", "fix").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"),
        F.coalesce(F.max_by("row", "doc_id"), F.min("row")).alias("keep_row"))
    return r.join(groups, ["ids", "fix"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged; of repeated rows one."""
    decided = materialize(exact_dedup(docs, id_col, text_col), "exact")
    stay = decided.where("kept").select(F.col("doc_id").alias("__d"), F.col("text_sha256").alias("__s"))
    sha = F.sha2(normal(F.col(text_col)), 256)
    out = docs.join(stay, F.col(id_col).eqNullSafe(F.col("__d")) & (sha == F.col("__s")), "left_semi")
    repeats = decided.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n")).where("n > 1")
    if repeats.isEmpty():
        return out
    one = Window.partitionBy(id_col, sha).orderBy(F.lit(0))
    return out.withColumn("__n", F.row_number().over(one)).where("__n = 1").drop("__n")
