"""Incremental state over several runs, and upserts whose graphs come in parts."""

import json

from conftest import rows

from kgspark.model import QUAD_COLS
from kgspark.sources import sinks
from kgspark.streaming import incremental as I


def land(folder, name, *graphs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"graph_iri": g, "sha256": str(h), "version": "1", "harvested_at": at, "registered_from": "r"}) + "\n" for g, h, at in graphs))


def test_resync_is_kept(spark, tmp_path):
    state, report = str(tmp_path / "state"), str(tmp_path / "report")
    weekly, full = tmp_path / "weekly", tmp_path / "full"
    run = lambda src, **kw: I.run_change_detection(spark, str(src), state, report, **kw)
    assert rows(I.read_state(spark, state)) == []
    land(weekly, "1.json", ("a", 1, "01"), ("b", 1, "01"), ("b", 2, "00"))
    run(weekly)
    assert rows(I.read_state(spark, state), "graph_iri", "sha256") == [("a", "1"), ("b", "1")]
    for k, g in enumerate("azq"):
        land(full, f"{k}.json", (g, 9, "02"))
    run(full, resync=True, max_files=1)
    assert rows(I.read_state(spark, state), "graph_iri", "sha256") == [("a", "9"), ("q", "9"), ("z", "9")]
    land(weekly, "2.json", ("a", 9, "03"), ("q", 2, "03"), ("n", 1, "03"), ("b", 1, "03"))
    run(weekly)
    assert rows(I.read_state(spark, state), "graph_iri", "sha256") == [("a", "9"), ("b", "1"), ("n", "1"), ("q", "2"), ("z", "9")]
    batches = spark.read.parquet(report)
    last = batches.agg({"batch": "max"}).first()[0]
    assert rows(batches.where(f"batch = {last}"), "graph_iri", "change") == [("a", "unchanged"), ("b", "new"), ("n", "new"), ("q", "changed")]
    assert {r.change for r in batches.where(f"epoch = 1 and batch < {last}").collect()} == {"new"}
    run(weekly)  # nothing landed
    assert spark.read.parquet(report).count() == batches.count()


def test_a_batch_writes_in_proportion_to_itself(spark, tmp_path):
    state, report, landing = str(tmp_path / "state"), str(tmp_path / "report"), tmp_path / "landing"
    size = lambda: {f: f.stat().st_size for f in (tmp_path / "state" / "query" / "state").rglob("*") if f.is_file()}
    land(landing, "1.json", *((f"graph-{k}", k, "01") for k in range(20_000)))
    I.run_change_detection(spark, str(landing), state, report)
    first = size()
    land(landing, "2.json", ("graph-7", 8, "02"), ("graph-9", 9, "02"))
    I.run_change_detection(spark, str(landing), state, report)
    grown = sum(n for f, n in size().items() if f not in first)
    assert grown * 5 < sum(first.values())
    assert rows(spark.read.parquet(report).where("batch = 1"), "graph_iri", "change") == [("graph-7", "changed"), ("graph-9", "unchanged")]
    # a batch whose end was not noted runs again with the state it began with
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "query" / "commits" / name).unlink()
    I.run_change_detection(spark, str(landing), state, report)
    assert rows(spark.read.parquet(report).where("batch = 1"), "graph_iri", "change") == [("graph-7", "changed"), ("graph-9", "unchanged")]


def test_resync_that_did_not_end(spark, tmp_path):
    root = str(tmp_path / "state")
    assert I._epoch(spark, root, True) == 1 and I._epoch(spark, root, True) == 1
    try:
        I._epoch(spark, root, False)
        raise AssertionError("the open re-sync was overlooked")
    except RuntimeError:
        pass


def test_upsert_of_graphs_in_parts(spark, tmp_path):
    table, schema = str(tmp_path / "table"), ", ".join(f"{x} STRING" for x in QUAD_COLS)
    row = lambda g, s: (g, s, "iri", "p", "o", "iri", None, "")

    def load(name, *parts):
        for p in parts:
            spark.createDataFrame([row(*x) for x in p], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        I.run_upsert(spark, str(tmp_path / name), schema, table, str(tmp_path / f"cp-{name}"), max_files=1)

    load("one", [("g", "1"), ("h", "1")], [("g", "2")], [("g", "3"), ("k", "1")])
    assert rows(sinks.read_graphs(spark, table), "graph", "s") == [("g", "1"), ("g", "2"), ("g", "3"), ("h", "1"), ("k", "1")]
    load("one", [("g", "7")])  # the next run of the same job replaces
    assert rows(sinks.read_graphs(spark, table), "graph", "s") == [("g", "7"), ("h", "1"), ("k", "1")]


def test_the_detector_takes_rows_and_asks_its_state_once(spark):
    from pyspark.sql import Row
    asked = []

    class Known:
        held = ("1", "v", "01", "r", 0)
        def get(self): asked.append("get"); return self.held  # noqa: E704
        def exists(self): asked.append("exists"); return True  # noqa: E704
        def update(self, value): self.held = value  # noqa: E704

    class Handle:
        def getValueState(self, *_): return Known()  # noqa: E704

    d = I._detector()
    d.init(Handle())
    new = [Row(graph_iri="a", sha256=s, version="v", harvested_at=at, registered_from="r", epoch=0) for s, at in (("1", "02"), ("2", "03"))]
    assert list(d.handleInputRows(("a",), iter(new), None)) == [Row(graph_iri="a", change="changed")]
    assert asked == ["get"] and d.known.held == ("2", "v", "03", "r", 0)
