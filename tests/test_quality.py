from conftest import rows

from kgspark.model import ONT, VOID
from kgspark.operators import pattern as P, shapes as H, verify as V


def check(fn, q, **kw):
    t = P.union_graph(q)
    return rows(fn(t, t, **kw), "focus", "path", "value")


def test_textual_and_value(quads):
    good = quads(("g", "ont:t", "a", "ont:TextualEntity"), ("g", "ont:t", "ont:isAbout", "ont:x"), ("g", "ont:t", "ont:hasValue", '"v"'))
    half = quads(("g", "ont:E", "rdfs:subClassOf", "ont:TextualEntity"), ("g", "ont:t", "a", "ont:E"), ("g", "ont:t", "ont:isAbout", "ont:x"))
    assert not check(H.textual_entity, good) and not check(H.has_value, good)
    assert not check(H.textual_entity, half) and len(check(H.has_value, half)) == 1


def test_roles_punning_variant_url(quads):
    role = quads(("g", "ont:r", "a", "ont:Role"), ("g", "ont:r", "ont:realizedIn", "ont:p"))
    assert not check(H.role_realized, role) and len(check(H.role_bearer, role)) == 1
    pun = quads(("g", "ont:i", "a", "owl:NamedIndividual"), ("g", "ont:i", "rdfs:subClassOf", "ont:C"))
    assert len(check(H.no_punning, pun)) == 1
    var = quads(("g", "ont:v", "a", "ont:OntologyVariant"), ("g", "ont:v", "ont:partOf", "ont:o"), ("g", "ont:o", "a", "ont:Ontology"))
    assert not check(H.ontology_variant, var)
    assert len(check(H.ontology_variant, var.where(f"s <> '{ONT}o'"))) == 1
    url = quads(("g", "ont:a", "a", "ont:Website"), ("g", "ont:b", "a", "ont:Website"), ("g", "ont:a", "ont:hasUrl", '"u"'))
    assert [x[0] for x in check(H.has_url, url)] == [ONT + "b"]


def test_version(quads):
    base = [("g", "ont:v", "a", "ont:OntologyVersion")]
    num = [("g", "ont:v", "ont:isSubjectOf", "ont:n"), ("g", "ont:n", "a", "ont:VersionNumber")]
    file = [("g", "ont:v", "ont:isSubjectOf", "ont:f"), ("g", "ont:f", "a", "ont:File")]
    assert not check(H.ontology_version, quads(*base, *num)) and not check(H.ontology_version, quads(*base, *num, *file))
    assert len(check(H.ontology_version, quads(*base))) == 1 and len(check(H.ontology_version, quads(*base, *file))) == 1


GRAPH = [("g", "ont:G", "a", VOID + "Dataset"), ("g", "ont:G", "label", '"a graph"'), ("g", "ont:G", "ont:denotedBy", "ont:d"), ("g", "ont:d", "a", "ont:Description"), ("g", "ont:d", "ont:hasValue", '"text"'),
         ("g", "ont:G", "ont:outputOf", "ont:l"), ("g", "ont:l", "a", "ont:Process"), ("g", "ont:l", "ont:hasParticipant", "ont:me"), ("g", "ont:l", "ont:occupies", "ont:r"), ("g", "ont:r", "a", "ont:Region1D"),
         ("g", "ont:r", "ont:firstInstant", "ont:t0"), ("g", "ont:r", "ont:lastInstant", "ont:t1"), ("g", "ont:t0", "a", "ont:Instant"), ("g", "ont:t0", "ont:timestamp", '"2024-01-31T10:00:00Z"^^xsd:dateTimeStamp')]
ALL = (H.graph_metadata, H.load_process, H.instant, H.no_deprecated)


def test_graph_metadata(quads):
    assert not any(check(fn, quads(*GRAPH)) for fn in ALL)
    broken = [r if r[1:3] != ("ont:d", "a") else ("g", "ont:d", "a", "ont:Event") for r in GRAPH] + [("g", "ont:G", "a", "ont:Dataset")]
    broken = [r if r[1:3] != ("ont:t0", "a") else ("g", "ont:t0", "a", "ont:Region0D") for r in broken]
    got = [check(fn, quads(*broken)) for fn in ALL]
    assert [len(x) for x in got] == [1, 0, 0, 1]
    assert len(check(H.instant, quads(*broken), weaker_class=ONT + "Region0D")) == 1
    no_part = [r for r in GRAPH if r[2] != "ont:hasParticipant"]
    assert len(check(H.load_process, quads(*no_part))) == 1


def test_report_lists_every_shape(quads):
    q = P.union_graph(quads(("g", "ont:a", "a", "ont:Website")))
    rep = dict(rows(H.shape_report(H.run_shapes(q, schema=q)), "shape", "conforms"))
    assert len(rep) == 8 and rep["has_url"] is False and rep["no_punning"] is True


def test_verification(quads):
    q = quads(("g", "ont:s", "ont:id", '"https://orcid.example.org/1"'), ("g", "http://else/s", "ont:id", '"https://orcid.example.org/1"'), ("g", "ont:s2", "ont:id", "https://orcid.example.org/1"))
    assert rows(V.orcid_literals(q, ONT, r"^https://orcid\.example\.org/\d+$"), "s") == [(ONT + "s",)]
    ok = quads(("a", "ont:B1", "a", "owl:ObjectProperty"), ("a", "ont:C1", "a", "owl:Class"), ("a", "ont:C2", "owl:deprecated", '"true"'), ("a", "ont:dp", "a", "owl:ObjectProperty"))
    use = quads(("g", "ont:x", "ont:B1", "ont:y"), ("g", "ont:x", "ont:B2", "ont:y"), ("g", "ont:x", "ont:partOf", "ont:y"), *[("g", f"ont:C{i}", "a", "owl:Class") for i in (1, 2, 3)],
                *[("g", "ont:x", "a", f"ont:C{i}") for i in (1, 2, 3)], ("g", "ont:dp", "a", "owl:DatatypeProperty"), ("g", "ont:x", "ont:dp", '"1"'))
    assert rows(V.undeclared_predicates(use, ONT + "B", [], ok), "p") == [(ONT + "B2",)]
    assert rows(V.unapproved_classes(use, ok), "c") == [(ONT + "C3",)]
    assert rows(V.unapproved_properties(use, ok), "p") == [(ONT + "dp",)]
    dis = quads(("g", "ont:C", "owl:disjointWith", "ont:D"), ("g", "ont:x", "a", "ont:C"), ("g", "ont:x", "a", "ont:D"), ("g", "ont:y", "a", "ont:C"), ("g", "ont:E", "rdfs:subClassOf", "ont:D"), ("g", "ont:y", "a", "ont:E"))
    assert rows(V.disjoint_members(dis), "x") == [(ONT + "x",)]
    from kgspark.operators.closure import consistency_report
    assert {r.node for r in consistency_report(dis, dis).collect()} == {ONT + "x", ONT + "y"}
    assert rows(V.gate_report({"a": dis.limit(0), "b": dis}), "name", "status") == [("a", "PASS"), ("b", "FAIL")]
    assert rows(V.non_empty_report({"a": dis.limit(0), "b": dis})) == [("a", False), ("b", True)]


def test_output_gates(spark):
    df = spark.createDataFrame([("a", "<!DOCTYPE html><p>"), ("b", "@prefix x: <y> ."), ("c", "  "), ("d", "<s> <p> <o> .")], "path string, text string")
    got = {r.path: (r.ok, r.serialisation) for r in V.output_gates(df).collect()}
    assert got["a"][0] is False and got["b"] == (True, "turtle") and got["c"][0] is False and got["d"] == (True, "nquads")


def test_serialisations_by_their_text(spark):
    texts = {"trig": "@prefix a: <b> .\n<http://g> {\n}", "trig2": "GRAPH <http://g> {", "jsonld": ' [ {"@id": "x"} ]', "turtle": "@prefix a: <b> .", "nquads": "<a> <b> <c> .", "xml": "<?xml version='1.0'?>", "unknown": "{}",
             "late": " " * 70_000 + "\n<http://g> {"}
    got = {r.path: r.serialisation for r in V.output_gates(spark.createDataFrame([*texts.items()], "path string, text string")).collect()}
    assert got == {**{k: k for k in texts}, "trig2": "trig", "late": "trig"}
    assert V.output_gates(spark.createDataFrame([("late", texts["late"])], "path string, text string"), head=65536).first().serialisation == "unknown"


def test_repeated_triples_do_not_repeat_violations(quads):
    q = quads(*GRAPH, ("g", "ont:G", "a", "ont:Dataset"), ("g", "ont:w", "a", "ont:Website"), ("g", "ont:v", "a", "ont:OntologyVariant"), ("g", "ont:v", "ont:partOf", "ont:x"))
    twice = q.unionByName(q)
    for fn in (*ALL, H.has_url, H.ontology_variant):
        assert rows(fn(twice, twice), "focus", "path", "value") == check(fn, q)


def test_values_of_nodes_out_of_focus_are_not_counted(quads):
    q = quads(("g", "ont:a", "ont:hasUrl", '"u"'), ("g", "ont:b", "ont:hasUrl", '"v"'))
    assert rows(H.value_counts(q, ONT + "hasUrl", of=q.where(f"s = '{ONT}a'").selectExpr("s AS focus"))) == [(ONT + "a", 1)]


def test_common_and_rare_classes_are_verified_alike(quads, monkeypatch):
    q = quads(("g", "ont:C", "a", "owl:Class"), ("g", "ont:D", "a", "owl:Class"), ("g", "ont:E", "a", "owl:Class"), ("h", "ont:F", "a", "owl:Class"),
              ("g", "ont:c1", "a", "ont:C"), ("g", "ont:c2", "a", "ont:C"), ("g", "ont:c3", "a", "ont:C"), ("g", "ont:d1", "a", "ont:D"), ("g", "ont:e1", "a", "ont:E"),
              ("g", "ont:x1", "a", "ont:Elsewhere"), ("g", "ont:x2", "a", "ont:Elsewhere"))
    approved = quads(("h", "ont:E", "a", "owl:Class"))
    for common in (1, 2, 1000):  # with one, only ont:C is compared by the small table
        monkeypatch.setattr(V, "COMMON", common)
        assert rows(V.unapproved_classes(q.union(q), approved), "s", "c") == [(ONT + "c1", ONT + "C"), (ONT + "c2", ONT + "C"), (ONT + "c3", ONT + "C"), (ONT + "d1", ONT + "D")]
