import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kgspark.model import ONT, OWL, SAME_AS, TYPE
from kgspark.operators import closure as C, describe as D, pattern as P


def brute(pairs):
    known = {(a, b) for a, b in pairs if a != b}
    while True:
        new = {(a, d) for a, b in known for c, d in known if b == c} - known
        if not new:
            return known
        known |= new


def test_closure_with_cycle(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "d")], "a string, b string")
    assert rows(C.transitive_closure(df)) == sorted((x, y) for x in "abc" for y in "abc")


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    pairs = [(f"n{rnd.randrange(15)}", f"n{rnd.randrange(15)}") for _ in range(22)]
    got = rows(C.transitive_closure(spark.createDataFrame(pairs, "a string, b string")))
    assert got == sorted(brute(pairs))


def test_closure_guard(spark):
    df = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(6)], "a string, b string")
    with pytest.raises(RuntimeError):
        C.transitive_closure(df, max_rounds=2)


def test_components(spark):
    df = spark.createDataFrame([("e", "d"), ("d", "c"), ("c", "b"), ("x", "y"), ("b", "a")], "a string, b string")
    assert dict(rows(C.components(df))) == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "a", "x": "x", "y": "x"}


def test_ego_reads_its_triples_once_a_round(quads, monkeypatch):
    q = quads(("g", "ont:a", "ont:p", "ont:b"), ("h", "ont:a", "ont:p", "ont:b"), ("g", "ont:b", "ont:p", "ont:c"), ("g", "ont:b", "label", '"b"'), ("g", "ont:a", "ont:p", "ont:a"))
    scans, store = [], C.materialize

    def watched(df, name="step", *a, **k):
        if name == "ego":
            scans.append(df._jdf.queryExecution().executedPlan().toString().count("ExistingRDD"))
        return store(df, name, *a, **k)

    monkeypatch.setattr(C, "materialize", watched)
    got = rows(C.ego_subgraph(q, [ONT + "b"], hops=1), "s", "o", "depth")  # repeated triples, no union graph
    assert got == sorted([(ONT + "a", ONT + "a", 1), (ONT + "a", ONT + "b", 0), (ONT + "b", ONT + "c", 0), (ONT + "b", "b", 0)])
    assert scans == [2, 1]  # in the first round the start is the second one


def test_ego_rounds(quads):
    q = P.union_graph(quads(*[("g", f"ont:n{i}", "ont:p", f"ont:n{i + 1}") for i in range(4)]))
    assert C.ego_subgraph(q, [ONT + "n0"], hops=2, direction="out").count() == 3
    assert C.ego_subgraph(q, [ONT + "n0"], hops=-1, direction="out").count() == 4
    assert C.ego_subgraph(q, [ONT + "n2"], hops=0, direction="both").count() == 2
    assert C.ego_subgraph(q, [ONT + "n0"], hops=-1, limit=2, direction="out").count() == 2


SCHEMA = [("o", "ont:A", "rdfs:subClassOf", "ont:B"), ("o", "ont:B", "rdfs:subClassOf", "ont:C"), ("o", "ont:p", "rdfs:subPropertyOf", "ont:q"), ("o", "ont:q", "rdfs:domain", "ont:A"),
          ("o", "ont:q", "rdfs:range", "ont:D"), ("o", "ont:C", "owl:disjointWith", "ont:D")]


def test_rdfs_closure_and_idempotence(quads):
    data = quads(*SCHEMA, ("g", "ont:x", "ont:p", "ont:y"), ("g", "ont:z", "ont:q", '"5"'))
    t = P.union_graph(data)
    out = C.rdfs_closure(t)
    types = {(r.s[len(ONT):], r.o[len(ONT):]) for r in out.where(f"p = '{TYPE}'").collect()}
    assert types == {("x", "A"), ("x", "B"), ("x", "C"), ("y", "D"), ("z", "A"), ("z", "B"), ("z", "C")}
    assert out.where(f"s = '{ONT}x' and p = '{ONT}q'").count() == 1
    assert rows(C.rdfs_closure(out), "s", "p", "o") == rows(out, "s", "p", "o")
    assert {r.axiom_kind for r in C.inferred_only(t).collect()} == {"class_assertion", "subclass", "property_assertion"}


def test_owlrl(quads):
    data = quads(("g", "ont:p", "a", "owl:TransitiveProperty"), ("g", "ont:a", "ont:p", "ont:b"), ("g", "ont:b", "ont:p", "ont:c"), ("g", "ont:p", "owl:inverseOf", "ont:i"),
                 ("g", "ont:f", "a", "owl:FunctionalProperty"), ("g", "ont:a", "ont:f", "ont:k1"), ("g", "ont:a", "ont:f", "ont:k2"), ("g", "ont:k2", "ont:s", '"v"'),
                 ("g", "_:r", "owl:onProperty", "ont:p"), ("g", "_:r", "owl:someValuesFrom", "ont:T"), ("g", "ont:c", "a", "ont:T"), ("g", "_:r", "rdfs:subClassOf", "ont:Has"),
                 ("g", "ont:U", "owl:unionOf", "_:l1"), ("g", "_:l1", "rdf:first", "ont:T"), ("g", "_:l1", "rdf:rest", "_:l2"), ("g", "_:l2", "rdf:first", "ont:V"),
                 ("g", "ont:N", "owl:intersectionOf", "_:m1"), ("g", "_:m1", "rdf:first", "ont:T"), ("g", "_:m1", "rdf:rest", "_:m2"), ("g", "_:m2", "rdf:first", "ont:U"))
    out = {(r.s.replace(ONT, ""), r.p.replace(ONT, ""), r.o.replace(ONT, "")) for r in C.owlrl_closure(P.union_graph(data)).collect()}
    assert ("a", "p", "c") in out and ("c", "i", "a") in out
    assert ("k2", SAME_AS, "k1") in out and ("k1", "s", "v") in out
    assert ("b", TYPE, "Has") in out and ("a", TYPE, "Has") in out
    assert ("c", TYPE, "U") in out and ("c", TYPE, "N") in out


def test_isolation_and_recombination(quads):
    onto = quads(*SCHEMA)
    data = quads(("g1", "ont:x", "a", "ont:A"), ("g2", "ont:y", "a", "ont:A"), ("g2", "ont:y", "a", "ont:D"), ("g3", "ont:v", "a", "ont:A"), ("g4", "ont:v", "a", "ont:D"))
    r = C.per_graph_reason(data, onto)
    assert dict(rows(r["status"], "graph", "consistent")) == {"g1": True, "g2": False, "g3": True, "g4": True}
    assert {x.graph for x in r["inferences"].collect()} == {"g1", "g3"}
    meta = data.limit(0)
    out = D.recombine(data, r["inferences"], r["status"], meta)
    asserted = set(rows(data, "graph", "s", "o"))
    assert asserted <= set(rows(out, "graph", "s", "o"))
    assert out.where("graph = 'g2/inferences'").count() == 0 and out.where("o = 'INCONSISTENT'").count() == 1


def test_consistency_rules(quads):
    onto = quads(("o", "ont:t", "a", "owl:FunctionalProperty"), ("o", "ont:A", "rdfs:subClassOf", "owl:Nothing"))
    data = quads(("g", "ont:x", "ont:t", '"1"'), ("g", "ont:x", "ont:t", '"2"'), ("g", "ont:y", "a", "ont:A"), ("g", "ont:a", "owl:sameAs", "ont:b"), ("g", "ont:b", "owl:differentFrom", "ont:a"))
    assert {r.rule for r in C.consistency_report(data, onto).collect()} == {"functional_clash", "nothing_member", "same_and_different"}


def test_prefilter_and_inverse(spark, quads):
    q = quads(("g", "ont:a", "ont:p", "ont:bad"), ("g", "ont:bad", "ont:p", "ont:c"), ("g", "ont:a", "ont:p", "ont:c"), ("g", "ont:p", "owl:propertyChainAxiom", "_:x"), ("g", "ont:p", "owl:inverseOf", "ont:q"))
    out = P.drop_terms(q, spark.createDataFrame([(ONT + "bad",)], "t string"), ONT + "p", OWL + "propertyChainAxiom")
    assert out.count() == 2
    assert rows(C.inverse_materialise(q.where(f"o = '{ONT}c'"), q), "s", "o") == [(ONT + "c", ONT + "a"), (ONT + "c", ONT + "bad")]


def test_long_chain_and_long_list(spark, quads):
    chain = spark.range(10_000).selectExpr("cast(id as string) AS a", "cast(id + 1 as string) AS b")
    assert C.reach(chain, spark.createDataFrame([("0",)], "node string"), max_rounds=30).count() == 10_000
    n = 500
    links = spark.range(n).selectExpr("cast(id as string) AS a", "cast(id + 1 as string) AS b")
    assert C.transitive_closure(links, max_rounds=12).count() == n * (n + 1) // 2
    cells = [("g", f"_:l{i}", "rdf:first", f"ont:m{i}") for i in range(n)] + [("g", f"_:l{i}", "rdf:rest", f"_:l{i + 1}" if i < n - 1 else "rdf:nil") for i in range(n)]
    assert C.list_members(P.union_graph(quads(*cells))).where("l = '_:l0'").count() == n


def test_reach_on_random_graphs(spark):
    rnd = random.Random(3)
    for size, links in ((60, 70), (300, 310)):
        pairs = [(f"n{rnd.randrange(size)}", f"n{rnd.randrange(size)}") for _ in range(links)] + [(f"c{i}", f"c{i + 1}") for i in range(25)] + [("n0", "c0"), ("c25", "n1")]
        got = {r.node for r in C.reach(spark.createDataFrame(pairs, "a string, b string"), spark.createDataFrame([("n0",)], "node string")).collect()}
        seen, todo = set(), ["n0"]
        while todo:
            x = todo.pop()
            for a, b in pairs:
                if a == x and b not in seen:
                    seen.add(b)
                    todo.append(b)
        assert got == seen


def test_reach_holds_no_more_rows_than_edges(spark, monkeypatch):
    """Behind a chain of eleven a random graph of 1,500 nodes with two edges out, and cycles that nothing enters."""
    rnd = random.Random(5)
    pairs = {(f"c{i}", f"c{i + 1}") for i in range(11)} | {("c11", "n0")} | {(f"n{i}", f"n{rnd.randrange(1500)}") for i in range(1500) for _ in range(2)}
    pairs |= {("x0", "x1"), ("x1", "x0"), ("y0", "y1"), ("y1", "y2"), ("y2", "y0"), ("n3", "n3")}
    stored, keep = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, name="step", *a, **k: stored.append(keep(df, name, *a, **k)) or stored[-1])
    got = {r.node for r in C.reach(spark.createDataFrame([*pairs], "a string, b string"), spark.createDataFrame([("c0",)], "node string")).collect()}
    nexts, seen, todo = {}, set(), ["c0"]
    for a, b in pairs:
        nexts.setdefault(a, []).append(b)
    while todo:
        for b in nexts.get(todo.pop(), []):
            if b not in seen:
                seen.add(b)
                todo.append(b)
    assert got == seen
    assert all(df.count() <= len(pairs) for df in stored) and len(stored) < 80


def test_reach_contracts_chains(spark, monkeypatch):
    """Two chains that meet, a start inside a chain, and a start on a cycle."""
    rounds, keep = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, name="step", *a, **k: rounds.append(name) or keep(df, name, *a, **k))
    pairs = [(f"a{i}", f"a{i + 1}") for i in range(300)] + [(f"b{i}", f"b{i + 1}") for i in range(200)] + [("b200", "a150")] + [(f"k{i}", f"k{(i + 1) % 40}") for i in range(40)]
    start = [("b20",), ("k3",)]
    got = {r.node for r in C.reach(spark.createDataFrame(pairs, "a string, b string"), spark.createDataFrame(start, "node string")).collect()}
    assert got == {f"b{i}" for i in range(21, 201)} | {f"a{i}" for i in range(150, 301)} | {f"k{i}" for i in range(40)}
    assert len(rounds) <= 30


# --- the rules once more, one by one, on sets ---------------------------------------------------

def brute_owlrl(t):
    """Naive closure of (s, p, o) with the same rules; equal nodes are replaced by the smallest."""
    o_ = lambda x: "owl:" + x
    up = {}

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    def plus(edges):
        edges, before = set(edges), -1
        edges = {(a, b) for a, b in edges if a != b}
        out = set(edges)
        while len(out) != before:
            before = len(out)
            out |= {(a, d) for a, b in out for c, d in edges if b == c}
        return out

    t = set(t)
    while True:
        of = lambda p: {(s, o) for s, q, o in t if q == p}
        typed = lambda c: {s for s, o in of("a") if o == c}
        sub = plus(of("rdfs:subClassOf") | of(o_("equivalentClass")) | {(b, a) for a, b in of(o_("equivalentClass"))})
        subp = plus(of("rdfs:subPropertyOf") | of(o_("equivalentProperty")) | {(b, a) for a, b in of(o_("equivalentProperty"))})
        new = {(a, "rdfs:subClassOf", b) for a, b in sub} | {(a, "rdfs:subPropertyOf", b) for a, b in subp}
        new |= {(s, "a", d) for s, c in of("a") for e, d in sub if c == e} | {(s, d, o) for s, p, o in t for e, d in subp if p == e}
        for p, c in of("rdfs:domain"):
            new |= {(s, "a", c) for s, q, _ in t if q == p}
        for p, c in of("rdfs:range"):
            new |= {(o, "a", c) for _, q, o in t if q == p}
        inv = of(o_("inverseOf")) | {(b, a) for a, b in of(o_("inverseOf"))} | {(p, p) for p in typed(o_("SymmetricProperty"))}
        new |= {(o, q, s) for s, p, o in t for r, q in inv if p == r}
        for p in typed(o_("TransitiveProperty")):
            new |= {(a, p, d) for a, b in of(p) for c, d in of(p) if b == c}
        on = of(o_("onProperty"))
        for r, p in on:
            for v in [v for x, v in of(o_("hasValue")) if x == r]:
                new |= {(s, p, v) for s in typed(r)} | {(s, "a", r) for s, x in of(p) if x == v}
            for c in [c for x, c in of(o_("someValuesFrom")) if x == r]:
                new |= {(s, "a", r) for s, y in of(p) if y in typed(c) or c == o_("Thing")}
        rest = plus(of("rdf:rest"))
        member = of("rdf:first") | {(a, m) for a, b in rest for x, m in of("rdf:first") if x == b}
        for c, l in of(o_("unionOf")):
            new |= {(s, "a", c) for x, m in member if x == l for s in typed(m)}
        parts = {}
        for c, l in of(o_("intersectionOf")):
            parts.setdefault(c, set()).update(m for x, m in member if x == l)
        for c, ms in parts.items():
            if ms:
                new |= {(s, "a", c) for s in set.intersection(*(typed(m) for m in ms))}
            new |= {(s, "a", m) for s in typed(c) for m in ms}
        grown = t | new
        pairs = {(s, o) for s, p, o in grown if p == o_("sameAs")}
        for p in {s for s, q, c in grown if q == "a" and c == o_("FunctionalProperty")}:
            pairs |= {(x, y) for s, q, x in grown if q == p for s2, q2, y in grown if q2 == p and s2 == s}
        for p in {s for s, q, c in grown if q == "a" and c == o_("InverseFunctionalProperty")}:
            pairs |= {(x, y) for x, q, s in grown if q == p for y, q2, s2 in grown if q2 == p and s2 == s}
        for a, b in pairs:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
        now = {(find(s), find(p), find(o)) for s, p, o in grown if p != o_("sameAs")} | {(x, o_("sameAs"), find(x)) for x in [*up] if find(x) != x}
        if now == t:
            return now
        t = now


def test_owlrl_equals_brute_force(spark):
    """Random graphs whose nodes, classes, properties, lists and restrictions are merged on the way."""
    schema = "s STRING, s_kind STRING, p STRING, o STRING, o_kind STRING, o_datatype STRING, o_lang STRING"
    from kgspark.model import expand
    merged = 0
    for seed in range(6):
        r = random.Random(seed)
        nodes, props, classes = [f"ont:n{k}" for k in range(7)], [f"ont:p{k}" for k in range(4)], [f"ont:C{k}" for k in range(5)]
        t = {(r.choice(nodes), r.choice(props), r.choice(nodes)) for _ in range(9)} | {(r.choice(nodes), "a", r.choice(classes)) for _ in range(5)}
        axioms = [lambda: (r.choice(classes), r.choice(["rdfs:subClassOf", "owl:equivalentClass"]), r.choice(classes)), lambda: (r.choice(props), r.choice(["rdfs:subPropertyOf", "owl:inverseOf"]), r.choice(props)),
                  lambda: (r.choice(props), r.choice(["rdfs:domain", "rdfs:range"]), r.choice(classes)), lambda: (r.choice(props), "a", "owl:" + r.choice(["TransitiveProperty", "SymmetricProperty"])),
                  lambda: (r.choice(props[:2]), "a", "owl:" + r.choice(["FunctionalProperty", "InverseFunctionalProperty"])), lambda: tuple(r.sample(r.choice([nodes, classes, props]), 1)) + ("owl:sameAs",) + (r.choice(nodes + classes + props[2:]),)]
        t |= {r.choice(axioms)() for _ in range(5)}
        k = r.choice(classes)
        t |= {(k, "owl:onProperty", r.choice(props)), (k, *r.choice([("owl:hasValue", r.choice(nodes)), ("owl:someValuesFrom", r.choice([*classes, "owl:Thing"]))]))}
        t |= {(r.choice(classes), r.choice(["owl:unionOf", "owl:intersectionOf"]), "ont:l0"), ("ont:l0", "rdf:first", r.choice(classes)), ("ont:l0", "rdf:rest", "ont:l1"), ("ont:l1", "rdf:first", r.choice(classes))}
        df = spark.createDataFrame([(expand(s), "iri", expand(p), expand(o), "iri", None, "") for s, p, o in t], schema)
        got = {(x.s, x.p, x.o) for x in C.owlrl_closure(df, max_rounds=40).collect() if not (x.p == SAME_AS and x.s == x.o)}
        want = {tuple(map(expand, x)) for x in brute_owlrl(t)}
        assert got == want, (seed, sorted(got - want)[:5], sorted(want - got)[:5])
        merged += any(p == SAME_AS for _, p, _ in got)
    assert merged >= 3


def test_counts_without_texts_equal_the_rows(quads):
    data = quads(*SCHEMA, ("g1", "ont:x", "a", "ont:A"), ("g1", "ont:x", "a", "ont:B"), ("g1", "ont:x", "ont:p", "ont:y"), ("g2", "ont:x", "ont:p", '"v"'), ("g2", "ont:x", "ont:q", '"v"'),
                 ("g2", "ont:x", "ont:p", '"v"@en'), ("g2", "ont:x", "ont:p", '"v"^^xsd:string'))
    out = C.rdfs_closure(P.union_graph(data))
    want = {p: (len(r), len({s for s, *_ in r})) for p in {r["p"] for r in out.collect()} for r in [[tuple(x[c] for c in ("s", "o", "o_kind", "o_datatype", "o_lang")) for x in out.where(F.col("p") == p).collect()]]}
    got = C.counts_per_predicate(C.rdfs_closure(data, distinct=False))
    assert {r["p"]: (r["n"], r["subjects"]) for r in got.collect()} == want
    onto = quads(*SCHEMA[:5])
    r = C.per_graph_reason(data.where("graph <> 'o'"), onto)
    assert rows(r["counts"]) == rows(r["inferences"].groupBy("graph").count())
    both = D.recombine(data.where("graph <> 'o'"), r["inferences"], r["status"], r["inferences"].limit(0))
    assert rows(D.recombined_sizes(r["sizes"], r["counts"], r["status"], r["inferences"].limit(0))) == rows(both.groupBy("graph").count())


def test_reasoning_stores_no_inferred_rows(quads, monkeypatch):
    """Only the schema, the violations and the sizes are stored."""
    stored, write = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, name="step", *a, **k: stored.append(name) or write(df, name, *a, **k))
    C.per_graph_reason(quads(("g", "ont:x", "a", "ont:A")), quads(*SCHEMA))
    assert set(stored) == {"edges", "closure", "schema", "sides", "violations", "sizes"}


def test_many_terms_are_met_by_a_join(quads, monkeypatch):
    data, terms = quads(("g", "ont:x", "ont:p", "ont:y"), ("g", "ont:x", "a", "ont:A"), ("g", "ont:z", "ont:q", "ont:D")), quads(("o", "ont:p", "a", "ont:A"), ("o", "ont:p", "a", "ont:B")).select("s")
    few = rows(C.among(data, "p", terms), "s", "p", "o")
    assert len(few) == 1
    monkeypatch.setattr(C, "FEW_TERMS", 0)
    assert rows(C.among(data, "p", terms), "s", "p", "o") == few
