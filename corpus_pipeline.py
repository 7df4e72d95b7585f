"""The corpus pipeline: toxicity, exact duplicates, near duplicates, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return
the columns of documents. Stages are written as Parquet between each other, so a lost executor costs at
most one stage's tasks. Rows with a null ``doc_id``, null or empty texts, repeated rows and extra columns pass as
each operator defines; an empty table stays empty to the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kgspark.llm import decontam, exactdup, neardup, packing, toxicity
from kgspark.llm.common import table
from kgspark.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exactdup.drop_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_duplicates),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: The toxicity model is fitted, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
