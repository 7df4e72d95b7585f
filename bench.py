"""Headline timings. Prints one JSON line.

``load_quads`` is the derivation and storing of all quads from the tables; the other queries
read the stored table, each run once and fully counted after a warm-up of the session.
"""

import json
import os
import time

from kgspark.session import build_session

HEADLINE = [
    "graph_sizes", "class_counts", "property_counts", "class_property_flow", "top_concepts", "content_counts", "dataset_list", "orgs_by_people",
    "rdf_stats", "void_stats", "kg_stats", "dl_constructs", "stat_triples", "stat_out_degree", "stat_untyped", "stat_datatypes",
    "bgp_star", "optional_block", "path_chain", "graph_var_join", "cq_software", "cq_people", "cq_datasets", "cq_facilities",
    "transitive_closure", "rdfs_closure", "consistency_report", "ego_subgraph", "shape_load_process", "verify_classes",
    "template_to_triples", "catalog_persons", "catalog_processes", "select_artifacts", "change_detect", "chunk_statements", "latest_class_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    from kgspark.plans import load_all, mapping
    from kgspark.plans.registry import QUERIES

    load_all()
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    t0 = time.perf_counter()
    mapping.Tables(spark, sf_dir).stored()
    times["load_quads"] = round(time.perf_counter() - t0, 3)
    for key in os.environ.get("BENCH_QUERIES", "").split() or HEADLINE:
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
