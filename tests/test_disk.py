"""What writers and chunks put on disk."""

import hashlib

from conftest import rows
from pyspark.sql import functions as F

from kgspark.operators.ordinal import chunk_lines
from kgspark.sources import scan, sinks


def test_chunks_without_text_shuffle_no_lines(spark):
    lines = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("graph"), F.format_string("line %06d ä", "id").alias("line"))
    per = lambda df, size: rows(df.groupBy("graph", "chunk").agg(F.count("*"), F.sum(size)))
    sizes = chunk_lines(lines, 1000, text=False)
    assert per(sizes, F.col("bytes")) == per(chunk_lines(lines, 1000), F.octet_length("line") + 1)
    assert sizes.columns == ["graph", "bytes", "chunk"]


def test_dumps_are_compressed_and_not_shuffled(spark, quads, tmp_path):
    q = quads(("g1", "ont:a", "ont:p", "ont:b"), ("g2", "ont:a", "ont:p", '"x\ny"'))
    path = str(tmp_path / "dumps")
    sinks.write_dumps(q, {"g1": "raw", "g2": "valid"}, "1", path)
    files = [f.name for f in (tmp_path / "dumps").rglob("part-*")]
    assert files and all(f.endswith(".gz") for f in files)
    back = scan.parse_lines(sinks.read_dumps(spark, path), "line", file_id="dump").where("ok")
    assert rows(back, "dump", "o") == [("raw_v1", "https://kg.example.org/ont/b"), ("valid_v1", "x\ny")]


def test_quad_files_are_compressed(quads, tmp_path):
    sinks.write_nquads(quads(("g", "ont:a", "ont:p", "ont:b")), str(tmp_path / "nq"))
    files = [f.name for f in (tmp_path / "nq").rglob("part-*")]
    assert files and all(f.endswith(".gz") for f in files)


def test_chunks_without_text_shuffle_two_numbers_a_line(spark):
    lines = spark.range(50).select(F.lit("g").alias("graph"), F.format_string("line %06d", "id").alias("line"))
    sizes = chunk_lines(lines, 100, text=False)
    plan = sizes._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "unhex" not in plan
    # the order is that of the whole hash
    want, upto = {}, 0
    for line in sorted((r.line for r in lines.collect()), key=lambda x: hashlib.sha1(x.encode()).hexdigest()):
        want[upto // 100] = want.get(upto // 100, 0) + 1
        upto += len(line) + 1
    assert rows(sizes.groupBy("chunk").agg(F.count("*"))) == sorted(want.items())
