"""Queries read the rules as a view over the tables: nothing is stored, other tables are not read."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kgspark.model import QUAD_COLS, TYPE
from kgspark.operators import metrics, pattern as P
from kgspark.plans import mapping

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_view_is_what_the_rules_say(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    view = mapping.Tables(spark, SF).view()
    assert view.columns == QUAD_COLS
    want = dict(con.execute(f"SELECT graph || p, count(*) FROM ({mapping.quads_sql()}) GROUP BY ALL").fetchall())
    assert {r["graph"] + r["p"]: r["count"] for r in view.groupBy("graph", "p").count().collect()} == want


def test_a_query_stores_nothing_and_reads_its_tables_only(spark, tmp_path):
    for f in os.listdir(SF):
        os.symlink(f"{SF}/{f}", tmp_path / f)
    before = dict(mapping._LOADED)
    for key in ("cq_datasets", "shape_has_value", "ego_subgraph"):
        entry.queries()[key](spark, str(tmp_path)).collect()
    assert mapping._LOADED == before


def test_filters_leave_the_rules_that_can_meet_them(spark):
    view = mapping.Tables(spark, SF).view()
    people = plan(P.typed(view, mapping.expand("ont:Person")))
    # the rules whose class depends on a row stay: one per event, part and asset
    assert "c_custkey" in people and "l_orderkey" not in people and "o_orderkey" not in people and "text" not in people
    assert "lineitem" not in plan(view.where(f"p = '{TYPE}' AND graph LIKE '%g/events'"))


def test_a_repeated_view_holds_the_same_quads_and_shuffles_no_keys(spark):
    tables = mapping.Tables(spark, SF)
    once, more = (tables.view("process", "catalog", repeats=r) for r in (False, True))
    assert "Aggregate" in plan(once) and "Aggregate" not in plan(more)
    small = f"p IN ('{mapping.expand('ont:occupies')}', '{mapping.expand('ont:participatesIn')}')"
    key = F.xxhash64(*QUAD_COLS)
    assert more.where(small).select(key).distinct().count() == once.where(small).count()


def test_individuals_meet_all_rules_in_one_join(spark):
    view = mapping.Tables(spark, SF).view("datasets")
    out = P.drop_individuals(view, mapping.expand("owl:NamedIndividual"), [mapping.expand("owl:Class")])
    assert plan(out).count("Join ") == 1


def test_inferences_are_counted_without_loading_all_quads(spark, tmp_path):
    for f in os.listdir(SF):
        os.symlink(f"{SF}/{f}", tmp_path / f)
    before = dict(mapping._LOADED)
    entry.queries()["inferred_only"](spark, str(tmp_path))
    assert mapping._LOADED == before


def test_endpoint_descriptions_are_whole(spark):
    out = entry.queries()["endpoint_void"](spark, SF)
    void, stat = "http://rdfs.org/ns/void#", mapping.BASE + "stat/"
    want = {TYPE, mapping.expand("label"), *(void + x for x in ("classes", "entities", "classPartition", "class", "vocabulary")),
            *(stat + x for x in ("objectProperties", "dataProperties", "reusedClass", "reusedObject", "reusedData"))}
    assert {r.p for r in out.select("p").distinct().collect()} == want
    assert out.where(f"p = '{void}classes'").count() == mapping.Tables(spark, SF).view().select("graph").distinct().count()


def test_file_descriptions_are_returned_as_triples(spark):
    out = entry.queries()["void_description"](spark, SF)
    assert out.columns == ["graph", "s", "p", "o"]
    text = out.where("s LIKE '%#desc' AND o LIKE 'Imported%'").first()["o"]
    assert [x.split(":")[0] for x in text.split("\n")[1:9]] == ["source", "registered_as", "file", "version", "landing_page", "download_url", "content_type", "sha256"]


def test_average_of_triples_shuffles_hashes(spark, quads):
    q = quads(("g", "ont:a", "ont:p", "ont:b"), ("h", "ont:a", "ont:p", "ont:b"), ("g", "ont:a", "ont:p", '"b"'), ("g", "ont:a", "ont:p", '"b"@en'), ("g", "ont:b", "ont:p", "ont:b"))
    out = metrics.average_triples(q)
    assert out.first()["avg_triples"] == 2.0
    assert all("o#" not in line for line in plan(out).split("\n") if "Aggregate" in line)
