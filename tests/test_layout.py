"""The stored quads: bucketed by subject, equal to the rules, loaded once."""

import os

import pytest
from pyspark.sql import functions as F

from kgspark.operators import metrics as M, pattern as P, questions as Q
from kgspark.plans import mapping

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_per_subject_need_no_shuffle(spark):
    quads = mapping.Tables(spark, SF).quads()
    union = P.union_graph(quads)
    assert "Exchange" not in plan(union) and "Exchange" not in plan(union.groupBy("s").agg(F.count("*")))
    assert "Exchange" not in plan(quads.groupBy("graph", "s").agg(F.count("*")))
    assert "hashpartitioning" not in plan(Q.out_degree(quads))
    # subjects and triples per graph: one row per graph and task is shuffled
    assert plan(M._per_subject(quads)).count("Exchange") == 1


def test_loaded_once_and_as_the_rules_say(spark):
    tables = mapping.Tables(spark, SF)
    assert tables.stored() == mapping.Tables(spark, SF + "/").stored()
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    want = dict(con.execute(f"SELECT graph, count(*) FROM ({mapping.quads_sql()}) GROUP BY graph").fetchall())
    assert {r["graph"]: r["count"] for r in tables.quads().groupBy("graph").count().collect()} == want
    some = tables.quads("catalog", preds=("a",))
    assert {r[0] for r in some.select("graph").distinct().collect()} == {mapping.BASE + "g/catalog"} and some.select("p").distinct().count() == 1
