import datetime as dt
import io
import json
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kgspark.model import BASE, ONT
from kgspark.operators import harvest as H
from kgspark.sources import archives, scan, sinks
from kgspark.streaming import incremental as I


def pick(spark, assets=(), tree=()):
    data = [("k", p, "asset", p) for p in assets] + [("k", p, "tree", p) for p in tree]
    return [r.path for r in H.select_artifacts(spark.createDataFrame(data, "source_key string, path string, source string, download_url string")).orderBy("path").collect()]


def test_artifact_choice(spark):
    assert pick(spark, ["o.ttl", "o-full.ttl", "o-full.owl", "o-base.ttl"], ["x.ttl"]) == ["o-full.ttl"]
    assert pick(spark, tree=["o.owl", "o.ttl", "src/o-edit.ttl", "imports/i.ttl"]) == ["o.ttl"]
    assert pick(spark, tree=["src/a.ttl", "src/b.nt"]) == ["src/a.ttl", "src/b.nt"]
    assert pick(spark, tree=["tests/t.ttl"]) == ["tests/t.ttl"]
    assert pick(spark, tree=["dataset-2024.ttl", "dataset-2025.ttl"]) == ["dataset-2024.ttl", "dataset-2025.ttl"]


def test_globs_fall_back(spark):
    c = spark.createDataFrame([("a", "x/o.ttl", "tree", ""), ("a", "x/p.nt", "tree", ""), ("b", "q.ttl", "tree", ""), ("b", "q-full.ttl", "tree", "")], "source_key string, path string, source string, download_url string")
    g = spark.createDataFrame([("a", H.glob_regex("*.nt")), ("b", H.glob_regex("none*"))], "source_key string, regex string")
    assert rows(H.include_globs(c, g), "path") == [("q-full.ttl",), ("x/p.nt",)]


def test_changes(spark):
    now = spark.createDataFrame([("n", "1"), ("c", "2"), ("u", "3")], "graph_iri string, sha256 string")
    was = spark.createDataFrame([("c", "x"), ("u", "3"), ("o", "4")], "graph_iri string, sha256 string")
    assert dict(rows(H.change_detect(now, was))) == {"n": "new", "c": "changed", "u": "unchanged", "o": "orphaned"}
    assert {r.change for r in H.change_detect(now, was.limit(0)).collect()} == {"new"}
    assert {r.change for r in H.change_detect(now, now).collect()} == {"unchanged"}


def test_stream_second_run_is_unchanged(spark, tmp_path):
    def land(name, items):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(dict(graph_iri=g, sha256=h, version="1", harvested_at=t, registered_from="r")) for g, h, t in items))

    run = lambda: I.run_change_detection(spark, *[str(tmp_path / x) for x in ("in", "state", "report")])
    land("1.json", [("a", "1", "t1"), ("b", "1", "t1")])
    run()
    land("2.json", [("a", "1", "t2"), ("b", "2", "t2"), ("c", "1", "t2")])
    run()
    rep = spark.read.parquet(str(tmp_path / "report"))
    assert rows(rep.where("batch = 1"), "graph_iri", "change") == [("a", "unchanged"), ("b", "changed"), ("c", "new")]
    assert I.read_state(spark, str(tmp_path / "state")).count() == 3
    assert rows(I.orphaned_after_full_run(spark.createDataFrame([("a",)], "graph_iri string"), spark, str(tmp_path / "state"))) == [("b",), ("c",)]


def test_daily_snapshots_stream(spark, tmp_path):
    ev = spark.createDataFrame([(dt.datetime(2024, 1, d, 5), "view") for d in (1, 1, 2, 5)], "ts timestamp, event_type string")
    ev.write.parquet(str(tmp_path / "in"))
    I.run_daily_snapshots(spark, str(tmp_path / "in"), "ts timestamp, event_type string", str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    # the last day stays open until the watermark passes it
    assert rows(got, "n") == [(1,), (2,)] or rows(got, "n") == [(1,), (1,), (2,)]


def test_publish_replaces_only_its_graphs(spark, quads, tmp_path):
    path = str(tmp_path / "pub")
    sinks.publish_graphs(quads(("g1", "ont:a", "ont:p", "ont:b"), ("g2", "ont:a", "ont:p", "ont:b")), path)
    for _ in range(2):
        sinks.publish_graphs(quads(("g1", "ont:a", "ont:p", "ont:c")), path)
    assert rows(sinks.read_graphs(spark, path), "graph", "o") == [("g1", ONT + "c"), ("g2", ONT + "b")]


def test_nquads_round_trip(spark, quads, tmp_path):
    q = quads(("g", "ont:a", "ont:p", '"x \\ "y"\nz"@en-GB'), ("g", "ont:a", "ont:p", '"5"^^xsd:integer'), ("g", "ont:a", "ont:q", "ont:b"), ("g", "_:n", "ont:q", "ont:b"))
    sinks.write_nquads(q, str(tmp_path / "nq"))
    back = scan.scan_nquads(spark, str(tmp_path / "nq") + "/*/*")
    cols = ["graph", "s", "p", "o", "o_kind", "o_lang"]
    assert rows(back, *cols) == rows(q.where("s_kind = 'iri'"), *cols)


def test_permissive_lines(spark, tmp_path):
    (tmp_path / "a.nt").write_text("<s> <p> <o> .\nbroken\n# note\n\n<s> <p> \"v\"^^<t> .\n_:b <p> _:c <g> .\n")
    q, report = scan.scan_permissive(spark, str(tmp_path / "a.nt"))
    assert rows(report, "parsed", "corrupt") == [(3, 1)]
    b = q.where("s_kind = 'bnode'").first()
    assert b.graph == "g" and b.s.startswith("_:") and b.o != "_:c"


def test_zip_members(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name in ("a.ttl", "../evil.ttl", "/abs.nt", "b.txt", "in/c.NT"):
            z.writestr(name, "x")
        z.writestr("big.nt", "y" * 50)
    (tmp_path / "f.zip").write_bytes(buf.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    got = rows(scan.scan_zip(spark, str(tmp_path) + "/*.zip"), "inner")
    assert got == [("a.ttl",), ("big.nt",), ("in/c.NT",)]
    assert rows(scan.expand_zip(scan.sized_files(spark, str(tmp_path) + "/f.zip"), 10), "inner") == [("a.ttl",), ("in/c.NT",)]


def test_registrations(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("TYPE\tSource\tLink\tfiles\tLabel\nX\t\thttps://github.com/o/r\ta.ttl; b/*.ttl\tL\nX\tZenodo\tsome\t\t\nX\t\t# c\t\t\nX\t\thttps://other\t\t\nX\t\t10.5281/zenodo.5\t\t\n")
    got = rows(scan.scan_registrations(spark, str(tmp_path / "r.tsv")), "row", "source", "url", "files")
    assert got == [(2, "github", "https://github.com/o/r", ["a.ttl", "b/*.ttl"]), (3, "zenodo", "some", []), (6, "zenodo", "10.5281/zenodo.5", [])]


def test_records_bindings_state(spark, tmp_path):
    v = spark.createDataFrame([('{"id": 1, "files": [{"filename": "a", "links": {"content": "u"}}]}',), ('{"id": 2, "files": {"entries": {"k": {"checksum": "c"}}}}',), ('{"id": 3}',)], "value string")
    assert rows(scan.parse_records(v), "id") == [("1",), ("2",), ("3",)]
    assert {(r.id, r.file_key, r.link) for r in scan.parse_records(v).collect()} == {("1", "a", "u"), ("2", "k", None), ("3", None, None)}
    b = spark.createDataFrame([('{"results":{"bindings":[{"c":{"type":"uri","value":"x"},"n":{"type":"literal","value":"3.0"}},{"n":{"type":"literal","value":"q"}}]}}',), ('{"results":{"bindings":[]}}',)], "value string")
    assert {(r.c, r.n) for r in scan.parse_bindings(b, ["c", "n"], integers=("n",)).collect()} == {("x", 3), (None, 0)}
    assert scan.scan_state(spark, str(tmp_path / "none"), I.STATE).count() == 0
    s = spark.createDataFrame([("r1|1", "b"), ("r1|0", "a"), ("r2|x", "c")], "key string, node string")
    assert [r.nodes for r in scan.regroup_slots(s).collect()] == [["a", "b"]]


def test_release_and_repair(spark):
    r = spark.createDataFrame([("a", "v1", "2024-01-01", False, False), ("a", "v2", "2024-02-01", False, False), ("a", "v3", "2024-03-01", True, False), ("b", "w1", "2023", False, True), ("b", "w2", "2024", False, False)],
                              "repo string, tag string, published_at string, draft boolean, is_latest boolean")
    assert rows(H.latest_release(r), "tag") == [("v2",), ("w1",)]
    s = spark.createDataFrame([("r", "f1", 10), ("r", "f2", 10), ("r", "f3", 10), ("r", "f4", 12)], "record string, function string, ts long")
    fixed = {x.function: x.fixed for x in H.repair_ids(s).collect()}
    assert fixed["f1"] == 10 and fixed["f4"] == 12 and sorted(fixed.values()) == [10, 12, 13, 14]


def test_tables(spark):
    assert scan.table_rows("<table><tr><td>a</td><td>b <b>c</b></td></tr><tr><td>x</td></tr></table>") == [(0, "a", "b c")]


def test_metric_sinks(spark, tmp_path):
    base = spark.createDataFrame([(BASE + "g", 3)], "graph string, triples long")
    for day in (1, 2):
        sinks.append_metric(sinks.stamp(base.withColumn("triples", F.col("triples") * day), "graph_stats", dt.datetime(2026, 1, day)), str(tmp_path / "m"))
    t = spark.read.parquet(str(tmp_path / "m"))
    assert t.count() == 2
    assert rows(sinks.latest_views({"graph_stats": t}, BASE)["graph_stats"], "triples") == [(6,)]
    assert sinks.latest_views({"graph_stats": t}, "urn:")["graph_stats"].count() == 0


def test_literals_of_any_length_and_escape(spark, tmp_path):
    long_ = ('say \\"x\\" \\\\ \\n' * 60_000)
    lines = [f'<s> <p> "{long_}"@en .', '<s> <p> "\\u00fc \\U0001F600 \\b\\f\\t\\r \\\\u0041 \\\\" .', '<s> <p> "a # \\" b" . # "comment"', '_:a <p> "x"^^<t> _:g .', '<s> <p> "open .', '<s> <p> "x" "y" .', "<s> <p> <o> <g> .", "# c", "  "]
    (tmp_path / "a.nq").write_text("\n".join(lines) + "\n", encoding="utf-8")
    got = scan.parse_lines(spark.read.text(str(tmp_path / "a.nq"))).collect()
    assert [r.ok for r in got] == [True, True, True, True, False, False, True]
    assert got[0].o == 'say "x" \\ \n' * 60_000 and got[0].o_lang == "en"
    assert got[1].o == "ü \U0001F600 \b\f\t\r \\u0041 \\" and got[2].o == 'a # " b' and got[3].o_datatype == "t" and got[3].graph == "_:g"
    assert (got[6].o, got[6].o_kind, got[6].graph) == ("o", "iri", "g")


def test_publishing_one_graph_rewrites_its_part_only(spark, tmp_path):
    """A thousand small graphs in packs, one huge graph in a part of its own."""
    path, bound = str(tmp_path / "published"), 4000
    row = ["concat('s', id) AS s", "'iri' AS s_kind", "'p' AS p", "repeat('x', 20) AS o", "'literal' AS o_kind", "cast(null AS string) AS o_datatype", "'' AS o_lang"]
    small = spark.range(3000).selectExpr("concat('g', id % 1000) AS graph", *row)
    huge = spark.range(2000).selectExpr("'huge' AS graph", *row)
    files = lambda: {f.relative_to(path): f.stat().st_mtime_ns for f in (tmp_path / "published").rglob("*.parquet")}
    parts = lambda a, b: {f.parts[0] for f in a.keys() | b.keys() if a.get(f) != b.get(f)}
    sinks.publish_graphs(small.unionByName(huge), path, pack_bytes=bound)
    where = sinks.partition_map(spark, path)
    sizes = {r["part"]: r["n"] for r in where.groupBy("part").agg(F.sum("bytes").alias("n")).collect()}
    assert 20 < len(sizes) < 200 and all(n <= bound + 150 for p, n in sizes.items() if p.startswith("pack-"))
    assert rows(where.where("files > 1"), "graph") == [("huge",)]
    first = files()
    sinks.publish_graphs(small.where("graph = 'g7'").limit(1), path, pack_bytes=bound)
    second = files()
    assert len(parts(first, second)) == 1 and {p[:9] for p in parts(first, second)} == {"part=pack"}
    sinks.publish_graphs(huge.where("s < 's5'"), path, pack_bytes=bound)
    third = files()
    assert {p[:8] for p in parts(second, third)} == {"part=own"} and len(parts(second, third)) == 1
    # a graph that outgrows its pack moves out, one that shrinks moves into a pack and its part goes
    sinks.publish_graphs(huge.withColumn("graph", F.lit("g8")), path, pack_bytes=bound)
    sinks.publish_graphs(huge.limit(2), path, pack_bytes=bound)
    assert rows(sinks.partition_map(spark, path).where("files > 1"), "graph") == [("g8",)]
    counts = {r["graph"]: r["n"] for r in sinks.read_graphs(spark, path).groupBy("graph").agg(F.count("*").alias("n")).collect()}
    assert counts["g7"] == 1 and counts["g8"] == 2000 and counts["huge"] == 2 and len(counts) == 1001 and sum(counts.values()) == 3000 - 6 + 1 + 2000 + 2
    sinks.publish_graphs(small.where("graph = 'g9'"), path, delete_first=False, pack_bytes=bound)
    assert sinks.read_graphs(spark, path).where("graph = 'g9'").count() == 6


def test_archive_members_are_dealt_out(spark, tmp_path):
    """One archive of 10,000 members is read by all tasks; a large member comes in bounded pieces."""
    with zipfile.ZipFile(tmp_path / "many.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(10_000):
            z.writestr(f"m{k}.nt", f"line {k}\n")
    with zipfile.ZipFile(tmp_path / "large.zip", "w", zipfile.ZIP_DEFLATED) as z:
        with z.open("large.nt", "w") as f:
            for k in range(30):
                f.write((f"<s{k}> <p> " + "é" * 500_000 + " .\n").encode())
        z.writestr("../evil.nt", "x")
        z.writestr("note.txt", "x")
        z.writestr("empty.ttl", "")
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    found, left_out = archives.scan_archives(spark, str(tmp_path) + "/*.zip", max_bytes=40_000_000)
    many = found.where("file LIKE '%many.zip'").select("inner", F.spark_partition_id().alias("task"))
    assert many.select("inner").distinct().count() == 10_000 and many.select("task").distinct().count() == 4
    sizes = found.where("inner = 'large.nt'").select(F.octet_length("text").alias("n"), "piece").collect()
    assert max(r.n for r in sizes) < 3 * archives.PIECE_BYTES and len(sizes) >= 10 and sorted(r.piece for r in sizes) == list(range(len(sizes)))
    assert sum(r.n for r in sizes) == sum(len(f"<s{k}> <p>  .\n") + 1_000_000 for k in range(30))
    assert rows(left_out.select(F.coalesce("inner", F.lit("-")), "status")) == [("-", "no archive"), ("../evil.nt", "outside"), ("note.txt", "other format")]
    assert archives.scan_archives(spark, str(tmp_path) + "/large.zip", max_bytes=10)[1].where("status = 'too large'").count() == 1
    assert b"".join(archives.pieces(io.BytesIO("aé€𝄞\n".encode() * 50), 7)).decode() == "aé€𝄞\n" * 50
    assert [p.decode() for p in archives.pieces(io.BytesIO("é€𝄞".encode() * 9), 5)]


def test_paged_harvest_goes_on(spark, tmp_path):
    landing, out, cp = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "cp")

    def land(start, ids):
        folder = landing / f"start={start:012d}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"p{len(ids)}.json").write_text("".join(json.dumps({"id": i}) + "\n" for i in ids) + "no json\n")

    run = lambda **kw: I.run_paged_harvest(spark, str(landing), "id BIGINT", out, cp, **kw)
    got = lambda **kw: [r.id for r in I.harvested(spark, out, 3, **kw).orderBy("start", "place").collect()]
    land(0, [5, 4, 3])
    land(6, [9, 8, 7])  # a page that came before the one in front of it
    run(max_files=1)
    assert got() == [5, 4, 3]
    land(3, [2, 1, 0])
    run()
    assert got() == [5, 4, 3, 2, 1, 0, 9, 8, 7]
    land(9, [11])
    land(12, [99, 98, 97])  # beyond the short page
    run(max_files=1)
    run()
    assert got() == [5, 4, 3, 2, 1, 0, 9, 8, 7, 11] and got(max_records=4) == [5, 4, 3, 2]


def test_dumps_are_written_by_version(spark, quads, tmp_path):
    q = quads(("ont:g", "ont:a", "ont:p", '"x y"@en'), ("ont:g", "_:b", "ont:p", "ont:c"), ("ont:h", "ont:a", "ont:p", "ont:b"), ("ont:other", "ont:a", "ont:p", "ont:b"))
    path, stages = str(tmp_path / "dumps"), {ONT + "g": "raw", ONT + "h": "valid", ONT + "none": "gone"}
    for version in ("1.0", "1.1", "1.1"):
        sinks.write_dumps(q, stages, version, path)
    got = scan.parse_lines(sinks.read_dumps(spark, path), "line").where("ok")
    assert rows(got.groupBy("dump").count()) == [("raw_v1.0", 2), ("raw_v1.1", 2), ("valid_v1.0", 1), ("valid_v1.1", 1)]
    assert rows(got.where("o_lang = 'en'"), "o", "graph") == [("x y", ONT + "g")] * 2
    try:
        sinks.write_dumps(q, {ONT + "none": "gone"}, "2", path)
        raise AssertionError("an empty dump was written")
    except ValueError:
        pass


def test_archives_without_members_are_archives(spark, tmp_path):
    # three rows in six tasks: three archives hold nothing
    members = spark.range(0, 3, 1, 6).select(F.format_string("d%d.ttl", "id").alias("inner"), F.lit("x").alias("text"))
    archives.write_archives(members, str(tmp_path / "a"))
    with zipfile.ZipFile(tmp_path / "a" / "note.zip", "w") as z:
        z.comment = b"empty"
    (tmp_path / "a" / "short.zip").write_bytes(b"PK")
    found, left_out = archives.scan_archives(spark, str(tmp_path / "a") + "/*.zip")
    assert rows(found, "inner", "text") == [(f"d{i}.ttl", "x") for i in range(3)]
    assert [(r.file.rsplit("/", 1)[1], r.status) for r in left_out.collect()] == [("short.zip", "no archive")]


def test_members_of_one_name_and_empty_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for text in ("first", "second one", ""):
            z.writestr("d.ttl", text)
        z.writestr("empty.ttl", "")
    found, left_out = archives.scan_archives(spark, str(tmp_path) + "/*.zip")
    assert rows(found, "place", "inner", "piece", "text") == [(0, "d.ttl", 0, "first"), (1, "d.ttl", 0, "second one"), (2, "d.ttl", 0, ""), (3, "empty.ttl", 0, "")]
    assert left_out.count() == 0


def test_scan_zip_of_odd_documents_is_its_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry
    docs = [(1, "one", "en"), (1, "one again", "en"), (2, "", "fr"), (3, None, "en"), (4, "x", None), (5, None, "de"), (5, "é\n" * 5000, "fr")]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(entry.oracle_sql()["scan_zip"]).fetchall()
    key = lambda r: tuple(map(str, r))
    got = entry.queries()["scan_zip"](spark, str(tmp_path)).select("member", "status", "chars").collect()
    assert sorted(map(key, got)) == sorted(map(key, want))
