"""The corpus pipeline as a whole: what stays of small tables, and its edge cases."""

import random

import pytest

import corpus_pipeline
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, row long, node string"


def tables(spark, folder, docs, labels=(), benchmark=()):
    rows = [(i, t, "en", "s", len(t or ""), "x", 7, None) for i, t in docs]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(benchmark), "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def text(r, n=80):
    return " ".join(f"w{r.randrange(20_000)}" for _ in range(n))


def ids(result):
    return sorted((x[0] for x in result.select("doc_id").distinct().collect()), key=str)


def test_every_stage_takes_effect(spark, tmp_path):
    r = random.Random(2)
    docs = [(i, text(r)) for i in range(30)]
    near = docs[4][1].split()
    near[40] = "changed"
    item = text(r, 26)
    docs += [(30, docs[3][1].upper()), (31, " ".join(near)), (32, text(r, 20) + " " + item), (33, None), (34, ""), (None, text(r)), (None, text(r)), (36, docs[5][1] + " more words"), (37, text(r, 20_000)), (38, text(r)), (38, None)]
    docs.append((38, docs[-2][1]))  # a repeated row
    folder = tables(spark, tmp_path, docs, benchmark=[("b1", item), ("b2", None)])
    got = corpus_pipeline.run(spark, folder)
    # 3 and 33 or the empty row 38 go as exact copies, 31 and 36 as near copies, 32 as contaminated
    gone = {3, 31, 32, 33, 34, 36}
    assert ids(got) == sorted([*(set(range(39)) - gone - {35}), None], key=str)
    pieces = got.collect()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p.length)
    assert len(by_doc[37]) > 10 and len(by_doc[None]) == 2 and len(by_doc[38]) == 2 and all(len(by_doc[i]) == 1 for i in range(30) if i != 3)
    places = {}
    for p in pieces:
        places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in places.values():
        end = 0
        for at, n in sorted(spans):
            assert at == end
            end += n
        assert end <= 1024


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    r = random.Random(3)
    folder = tables(spark, tmp_path, [(i, text(r)) for i in range(6)] + [(None, None)], benchmark=[("b", text(r, 20))])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and sorted(out.collect(), key=str) == sorted(docs.collect(), key=str)


def test_toxic_documents_go_and_clean_ones_stay(spark, tmp_path):
    r = random.Random(4)
    clean = [(i, text(r)) for i in range(150)]
    toxic = [(i, text(r, 60) + " " + " ".join(r.choice(["vilefoo", "nastybar", "uglybaz"]) for _ in range(8))) for i in range(150, 210)]
    labels = [(i, 1, int(i >= 150)) for i in range(210) if i % 3]
    folder = tables(spark, tmp_path, clean + toxic, labels)
    assert ids(corpus_pipeline.run(spark, folder)) == sorted((i for i in range(150)), key=str)


@pytest.mark.parametrize("docs", [[], [(None, None)], [(1, ""), (2, None)]])
def test_empty_tables(spark, tmp_path, docs):
    got = corpus_pipeline.run(spark, tables(spark, tmp_path, docs))
    assert got.count() == min(1, len(docs)) and got.where(F.col("length") != 1).count() == 0
