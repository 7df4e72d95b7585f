from conftest import rows
from pyspark.sql import functions as F

from kgspark.functions import scalars as S
from kgspark.model import ONT, TERMS, TRIPLE_COLS
from kgspark.operators import metrics as M, pattern as P, questions as Q
from kgspark.operators.ordinal import chunk_lines, with_ordinal
from kgspark.sources import sinks


def test_only_first_events_meet_their_blocks(quads):
    q = quads(("g", "ont:e1", "a", "ont:Process"), ("g", "ont:e1", "ont:denotedBy", "ont:t"), ("g", "ont:t", "a", "ont:Title"), ("g", "ont:t", "label", '"T"'),
              ("g", "ont:t", "ont:hasUrl", '"u"'), ("g", "ont:e1", "ont:hasParticipant", "ont:o"), ("g", "ont:e1", "ont:hasParticipant", "ont:x"),
              ("g", "ont:o", "a", "ont:Organization"), ("g", "ont:o", "label", '"Org"'), ("g", "ont:x", "label", '"untyped"'),
              ("g", "ont:e2", "a", "ont:Process"), ("g", "ont:e3", "a", "ont:Process"))
    cols = ("event", "title", "url", "org_label", "consortium_label")
    whole = rows(Q.events(q, ONT + "Process", cap=None), *cols)
    assert whole[0] == (ONT + "e1", "T", "u", "Org", None) and len(whole) == 3
    first = Q.events(q.union(q), ONT + "Process", cap=2)
    assert rows(first, *cols) == whole[:2]
    # the quads themselves are read by scans beside small stored tables; what is left to do reads these only
    assert "ExistingRDD" not in first._jdf.queryExecution().executedPlan().toString()


def test_people_star_and_optional(quads):
    q = quads(("g", "ont:p1", "a", "ont:Person"), ("g", "ont:p1", "label", '"Ada"'), ("g", "ont:p1", "ont:denotedBy", "ont:m"),
              ("g", "ont:p1", "ont:denotedBy", "ont:n"), ("g", "ont:m", "a", "ont:Email"), ("g", "ont:m", "label", '"ada@x"'),
              ("g", "ont:n", "a", "ont:Title"), ("g", "ont:n", "label", '"Dr"'), ("g", "ont:p1", "ont:externalId", "ont:orcid1"),
              ("g", "ont:p2", "a", "ont:Person"), ("g", "ont:p2", "label", '"Bob"'))
    got = rows(Q.people(q), "label", "email", "orcid")
    assert got == [("Ada", "ada@x", ONT + "orcid1"), ("Bob", None, None)] or got[0] == ("Ada", "ada@x", ONT + "orcid1")
    assert len(got) == 2


def test_sets_and_duplicates(quads):
    a = quads(("g1", "ont:a", "ont:p", "ont:b"), ("g2", "ont:a", "ont:p", "ont:b"), ("g2", "ont:a", "ont:p", '"ont:b"'))
    assert P.union_graph(a).count() == 2
    once, twice = P.merge(a, graph="m"), P.merge(a, a, graph="m")
    assert rows(once, "s", "o") == rows(twice, "s", "o")
    t = a.select(TRIPLE_COLS).distinct()
    assert P.insert_absent(t, t).count() == t.count()


def test_object_kind_keeps_text_apart(quads):
    q = quads(("g", "ont:a", "ont:p", "ont:b"), ("g", "ont:c", "ont:p", '"' + ONT + 'b"'), ("g", "ont:b", "label", '"B"'))
    got = P.link(q, ONT + "p", "x", "y").join(P.labels(q, "y", "l"), "y")
    assert rows(got, "x") == [(ONT + "a",)]


def test_english_labels(quads):
    q = quads(*[("g", "ont:a", "label", f'"{t}"@{t}' if t else '"none"') for t in ("", "en", "en-GB", "EN", "de", "eng")])
    assert rows(P.english_labels(q, "a", "l"), "l") == [("EN",), ("en",), ("en-GB",), ("none",)]


def test_label_rule(spark):
    df = spark.createDataFrame([(None, "x#A"), (None, "x/B"), ("C!", "x#C"), (None, "x#")], "l string, i string")
    assert [r[0] for r in df.select(S.label_fallback("l", "i")).collect()] == ["A", "", "C!", ""]
    assert [r[0] for r in df.select(S.label_fallback("l", "i", strict=False)).collect()][1] == "B"


def test_bnode_strip(quads):
    q = quads(("g", "_:x", "ont:p", "ont:b"), ("g", "ont:a", "ont:p", "_:x"), ("g", "ont:a", "ont:p", "ont:b"))
    assert P.strip_bnodes(q).count() == 1


def test_class_count_not_multiplied_by_labels(quads):
    q = quads(*[("g", f"ont:i{k}", "a", "ont:C") for k in range(3)], ("g", "ont:C", "label", '"zeta"'), ("g", "ont:C", "label", '"alpha"@en'))
    assert rows(M.class_counts(q, q), "class_label", "instances") == [("alpha", 3)]
    assert rows(Q.entities_per_concept(q), "label", "count") == [("alpha", 3), ("zeta", 3)]


def test_optional_combinations_of_dataset_list(quads):
    q = quads(("g", "ont:d", "a", "ont:Dataset"), ("g", "ont:d", "ont:literalTitle", '"T"'), *[("g", "ont:d", "ont:hasPart", f"ont:c{k}") for k in (1, 2)],
              *[("g", f"ont:c{k}", "label", f'"L{k}"') for k in (1, 2)])
    got = M.dataset_list(q)
    assert got.count() == 4 and {r.title for r in got.collect()} == {"T"}


def test_optional_bound_is_left_to_right(spark):
    left = spark.createDataFrame([("r1", "n1"), ("r2", None)], "role string, node string")
    block = spark.createDataFrame([("r1", "n1", "w1"), ("r1", "n9", "w9"), ("r2", "n2", "w2")], "role string, node string, web string")
    assert rows(P.optional_bound(left, block, "role", "node"), "role", "node", "web") == [("r1", "n1", "w1"), ("r2", "n2", "w2")]


def test_latest_view_keeps_missing_keys(spark):
    df = spark.createDataFrame([("1", "g", "a", 1), ("1", "g", "b", 2), ("2", "g", "a", 3)], "ts_utc string, graph string, class_iri string, n long")
    assert rows(P.latest(df, ["graph", "class_iri"]), "class_iri", "n") == [("a", 3), ("b", 2)]


def test_top_n_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    top = P.top_n(df, 3, ["g"], ["-id"])
    assert rows(top, "id") == [(994,), (995,), (996,), (997,), (998,), (999,)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_ordinals_and_chunks(spark):
    df = spark.range(0, 5000, 7).select(F.col("id").alias("k"))
    numbered = with_ordinal(df, ["k"], "n")
    got = numbered.orderBy("k").collect()
    assert [r.n for r in got] == list(range(1, len(got) + 1))
    assert "Window" not in numbered._jdf.queryExecution().executedPlan().toString()
    grouped = df.withColumn("g", F.when(F.col("k") % 5 > 0, (F.col("k") % 5 > 2).cast("string"))).withColumn("m", -F.col("k"))
    for g in (None, "true", "false"):
        part = with_ordinal(grouped, ["m"], "n", start=2, by=["g"]).where(F.col("g").eqNullSafe(F.lit(g))).orderBy("m").collect()
        assert part and [r.n for r in part] == list(range(2, len(part) + 2))
    assert with_ordinal(df.limit(0), ["k"]).count() == 0
    lines = spark.range(2000).select((F.col("id") % 3).cast("string").alias("graph"), F.format_string("line %05d", "id").alias("line"))
    out = chunk_lines(lines, 1000)
    assert out.count() == 2000
    sizes = out.groupBy("graph", "chunk").agg(F.sum(F.octet_length("line") + 1).alias("b")).agg(F.max("b"), F.count("*")).first()
    assert sizes[0] <= 1000 + 11 and sizes[1] >= 21
    # a graph that holds nearly all rows is cut into as many buckets as its bytes ask for, and chunks stay gapless
    hot = chunk_lines(spark.range(30_000).select(F.when(F.col("id") < 10, "small").otherwise("hot").alias("graph"), F.format_string("line %06d", "id").alias("line")), 1000)
    per = hot.groupBy("graph").agg(F.countDistinct("chunk").alias("n"), F.max("chunk").alias("top")).collect()
    assert all(r.n == r.top + 1 for r in per) and {r.graph: r.n for r in per} == {"small": 1, "hot": 360}


def test_chunks_are_written_and_read(spark, quads, tmp_path):
    q = quads(*[("ont:g", f"ont:s{k}", "rdfs:label", f'"{k}"') for k in range(300)], ("ont:h", "ont:x", "rdfs:label", '"y"'))
    sinks.write_chunks(q, str(tmp_path / "chunks"), 2000)
    back = sinks.read_chunks(spark, str(tmp_path / "chunks"))
    assert rows(back, "line") == rows(sinks.nquads_lines(q), "line")
    sizes = [r.b for r in back.groupBy("graph_stem", "chunk").agg(F.sum(F.octet_length("line") + 1).alias("b")).collect()]
    assert len(sizes) > 8 and max(sizes) < 2300
    assert len({f.parent for f in (tmp_path / "chunks").rglob("part-*")}) == len(sizes) == len([*(tmp_path / "chunks").rglob("part-*")])


def test_cross_products_are_refused(spark):
    import pytest
    a, b = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "b int")
    with pytest.raises(ValueError):
        P.bgp(a, b)
    with pytest.raises(ValueError):
        P.optional(a, b)


def test_constructs(quads):
    q = quads(("g", "_:r1", "owl:minQualifiedCardinality", '"1"'), ("g", "_:r1", "owl:onClass", "ont:C"), ("g", "_:r2", "owl:qualifiedCardinality", '"1"'),
              ("g", "_:r2", "owl:onClass", "owl:Thing"), ("g", "_:c", "owl:oneOf", "_:l1"), ("g", "_:l1", "rdf:first", "ont:x"), ("g", "_:d", "owl:oneOf", "_:l2"),
              ("g", "_:l2", "rdf:first", '"x"'), ("g", "ont:p", "owl:inverseOf", "ont:q"), ("g", "ont:p", "a", "owl:TransitiveProperty"), ("g", "_:s", "owl:someValuesFrom", "owl:Thing"))
    got = dict(rows(M.dl_constructs(P.union_graph(q)), "construct", "count"))
    assert len(got) == 17
    assert (got["Q"], got["N"], got["CONCEPT_UNION"], got["D"], got["NOMINALS"], got["ROLE_INVERSE"], got["LIMITED_EXISTENTIAL"], got["ROLE_TRANSITIVE"]) == (1, 1, 1, 1, 1, 1, 1, 1)


def test_bounded_list(spark):
    df = spark.range(70).select(F.lit("a").alias("k"), F.format_string("%03d", "id").alias("v"))
    r = M.bounded_list(df, "k", "v").first()
    assert r.total == 70 and r["items"].endswith("049 ... (+20 more)")


def test_combinations_are_cut_before_they_are_built(spark):
    """A hub of 3,000 values in three lists has 2.7e10 combinations; none but the first are made."""
    things = spark.createDataFrame([("g", "a", "t1"), ("g", "a", None), ("g", "b", "t"), ("g", "c", None), ("h", "z", "t")], "graph string, e string, title string")
    hub = spark.range(3000).select(F.lit("g").alias("graph"), F.lit("b").alias("e"), F.format_string("v%05d", "id").alias("x"))
    few = spark.createDataFrame([("g", "a", "q2"), ("g", "a", "q1"), ("g", "a", "q1"), ("h", "z", "q9")], "graph string, e string, x string")
    every = hub.unionByName(few)
    lists = [(every, "x"), (every.withColumnRenamed("x", "y"), "y"), (every.withColumnRenamed("x", "z"), "z")]
    got = [tuple(r) for r in P.first_combinations(things, lists, 40, ["graph"]).orderBy("graph", "e", F.asc_nulls_last("title"), "x", "y", "z").collect()]
    q = [(a, b, c) for a in ("q1", "q2") for b in ("q1", "q2") for c in ("q1", "q2")]
    want = [("g", "a", t, *c) for t in ("t1", None) for c in q] + [("g", "b", "t", "v00000", "v00000", f"v{k:05d}") for k in range(24)] + [("h", "z", "t", "q9", "q9", "q9")]
    assert got == want
    assert len(P.first_combinations(things, lists, 40).collect()) == 40
    plan = P.first_combinations(things, [], 2, ["graph"])
    assert rows(plan.where("graph = 'g'"), "e") == [("a",), ("a",)]


def test_an_empty_list_of_graphs_is_an_error(quads):
    import pytest
    q = quads(("ont:g1", "ont:a", "ont:p", "ont:b"), ("ont:g2", "ont:a", "ont:p", "ont:b"))
    assert rows(M.list_graphs(q, ONT)) == [(ONT + "g1",), (ONT + "g2",)]
    with pytest.raises(ValueError):
        M.list_graphs(q, "urn:none")
