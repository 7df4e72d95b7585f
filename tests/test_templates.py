import json
import uuid

from conftest import rows
from pyspark.sql import functions as F

from kgspark.functions import scalars as S, text as X
from kgspark.model import BASE, LABEL, ONT, TYPE
from kgspark.operators import axioms as A, catalog as K, template as T
from kgspark.sources import scan


def sheet(spark, tabs):
    out = []
    for order, (tab, lines) in enumerate(tabs.items()):
        out += [(tab, str(order), i, cells) for i, cells in enumerate(lines, 1)]
    return scan.tabs_from_rows(spark.createDataFrame(out, "tab string, tab_order string, line_no bigint, cells array<string>"))


HEAD = [["id", "type", "name", "friends", "tags", "size"], ["ID", "TYPE", "A rdfs:label", f"I {ONT}knows SPLIT=|", f"A {ONT}tag SPLIT=;", f"AT {ONT}size^^xsd:integer"]]


def test_template(spark):
    data, dirs = sheet(spark, {
        "one": HEAD + [[BASE + "1", ONT + "P", "Ada", "BOB | nobody", "a; ;b", "3"], [" ", ONT + "P", "ghost", "", "", ""], [BASE + "2", "no iri", "Same", "", "", ""]],
        "two": HEAD + [[BASE + "3", ONT + "P", "Bob", "same", "", ""], [BASE + "4", ONT + "P", "same", "", "", ""]],
        "short": HEAD,
    })
    quads, missing = T.template_to_triples(data, dirs, "g")
    got = {(r.s[-1], r.p, r.o) for r in quads.collect()}
    assert ("1", ONT + "knows", BASE + "3") in got and ("3", ONT + "knows", BASE + "2") in got
    assert ("1", ONT + "tag", "b") in got and ("2", TYPE, "no iri") not in got and ("1", LABEL, "Ada") in got
    assert not [x for x in got if x[2] == "ghost"]
    assert [(r.tab, r.value) for r in missing.collect()] == [("one", "nobody")]
    assert quads.where(f"p = '{ONT}size'").first().o_datatype.endswith("#integer")
    assert rows(T.example_rows(data), "tab", "row") == [("one", 3), ("two", 3)]


def test_scan_tabs_from_files(spark, tmp_path):
    (tmp_path / "people.tsv").write_text("id\tname\nID\tA rdfs:label\nhttps://x/1\tJÃ¶rg\n\tblank\nhttps://x/2\tΣ JÃ¶rg\n", encoding="utf-8")
    (tmp_path / "empty.tsv").write_text("id\tname\nID\tA rdfs:label\n", encoding="utf-8")
    data, dirs = scan.scan_tabs(spark, str(tmp_path) + "/*.tsv", 2, repair=True)
    assert rows(data.select("tab", "row", F.col("cells")[1])) == [("people", 3, "Jörg"), ("people", 5, "Σ JÃ¶rg")]
    assert dirs.where("tab = 'people'").count() == 2
    whole, _ = scan.scan_tabs(spark, str(tmp_path) + "/*.tsv", 2, repair=True, scope="file")
    assert rows(whole.select("row", F.col("cells")[1])) == [(3, "JÃ¶rg"), (5, "Σ JÃ¶rg")]


def test_mojibake(spark):
    twice = "Jörg".encode().decode("latin-1").encode().decode("latin-1")
    df = spark.createDataFrame([(1, "JÃ¶rg"), (2, twice), (3, "Jörg"), (4, "Σ JÃ¶rg"), (5, None)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(X.fix_mojibake("t")).collect()] == ["Jörg", "Jörg", "Jörg", "Σ JÃ¶rg", None]


def test_uuid5_and_encoding(spark):
    ns = "12345678-1234-5678-1234-567812345678"
    keys = ["Jörg|contact", "", "a" * 200]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r[0] for r in df.select(S.uuid5("k", ns)).collect()] == [str(uuid.uuid5(uuid.UUID(ns), k)) for k in keys]
    assert str(uuid.uuid5(uuid.UUID(ns), "Jörg|contact")) == "bebabfa6-4b66-5ae8-acdb-102e692ccda3"


def test_percent_encoding(spark):
    def enc(u, mode="graph"):
        return spark.createDataFrame([(u,)], "u string").select(X.pct_encode("u", mode)).first()[0]

    assert enc("https://x.org/a b/ü?q=1 2#f g") == "https://x.org/a%20b/%C3%BC?q=1%202#f%20g"
    assert enc("https://x.org/a%20b (c);p q#f:1") == "https://x.org/a%20b%20%28c%29;p q#f%3A1"
    for same in ("https://x.org/J\u00f6rg", "urn:x y", "https://x.org/a%20b", "https://x.org/(b)", None):
        assert enc(same) == same
    assert enc("https://doi.org/10.1/a(b)%20\u00fc?x y#g h", "doi") == "https://doi.org/10.1/a(b)%2520%C3%BC?x%20y#g%20h"


def test_scalars(spark):
    def one(col, **cols):
        return spark.createDataFrame([tuple(cols.values())], list(cols)).select(col).first()[0]

    assert one(S.date_mdy("d"), d="2024-01-31T10:00:00Z") == "01/31/2024" and one(S.date_mdy("d"), d="soon") == "soon" and one(S.date_mdy("d"), d="2024-13-99") == "2024-13-99"
    assert one(S.sanitize("x"), x=" a\tb \n  c ") == "a b c"
    assert one(S.owner_repo("u"), u="https://github.com/acme/tool/tree/master") == "acme/tool" and one(S.owner_repo("u"), u="https://github.com/acme") is None
    assert one(S.owner_repo("u"), u="git@github.com:o/r.git") == "o/r" and one(S.owner_repo("u"), u="https://github.com/orgs/settings") is None
    assert one(S.record_id("r"), r="https://doi.org/10.5281/zenodo.12") == "12" and one(S.record_id("r"), r="77") == "77" and one(S.record_id("r"), r="x") is None
    assert one(S.literal_int("v"), v="3.0") == 3 and one(S.literal_int("v"), v="many") == 0
    assert one(S.human_total("n"), n=243059) == "~243K" and one(S.human_total("n"), n=1234567) == "~1.2M" and one(S.human_total("n"), n=7) == "7"
    assert one(S.excerpt("t"), t=" \n" + "x" * 700) == "x" * 600 + "\n…(truncated)" and one(S.url_tail("u"), u="https://h/a/b/?q=1") == "b"
    assert one(S.namespace("i"), i="http://a/b#c") == "http://a/b#" and one(S.namespace("i"), i="http://a/b/c") == "http://a/b/"
    pre = {"ont": ONT, "kg": BASE}
    assert one(S.curie("i", pre), i=ONT + "X") == "ont:X" and one(S.expand_curie("i", pre), i="kg:y") == BASE + "y" and one(S.expand_curie("i", pre), i="zz:y") == "zz:y"
    d = one(S.parse_directive("c"), c=f"AT {ONT}u^^xsd:anyURI SPLIT=;")
    assert tuple(d) == ("AT", ONT + "u", "xsd:anyURI", None, ";")
    label = "http://www.w3.org/2000/01/rdf-schema#label"
    for cell, want in (("A rdfs:label@en", ("A", label, None, "en", None)), (f"AT {ONT}v ^^xsd:anyURI", ("AT", ONT + "v", "xsd:anyURI", None, None)), ("C %", ("C", "%", None, None, None)),
                       (f"DOMAIN <{ONT}d>", ("DOMAIN", ONT + "d", None, None, None)), ("RANGE", ("RANGE", None, None, None, None)), (f"I {ONT}r, SPLIT=|", ("I", ONT + "r", None, None, "|")), ("Apple x", (None,) * 5), ("", (None,) * 5)):
        assert tuple(one(S.parse_directive("c"), c=cell)) == want, cell
    assert one(S.human_total("n"), n=1960000) == "~2.0M" and one(S.human_total("n"), n=999999) == "~999K"
    assert one(S.date_dmy("d"), d="2024-01-31") == "31.01.2024" and one(S.date_dmy("d"), d="next week") == "next week"
    assert one(S.normalize_doi("d"), d=" https://doi.org/10.1/AB/ ") == "10.1/ab" and one(S.safe_slug("d"), d=" doi: 10.1/A b ") == "10.1_ab" and one(S.safe_slug("d"), d="?") == "id"
    assert one(S.record_graph_iri("b:", "tbox", F.col("d")), d=" doi:10.5281/zenodo.7 ") == "b:snapshot/tbox/10.5281_zenodo.7"
    for u, want in (("https://github.com/o/r.git?x=1", "o/r"), ("github.com:o/r#a", "o/r"), ("https://github.com/-o/r", None), ("https://github.community/o/r", None), ("https://github.com/o/", None)):
        assert one(S.owner_repo("u"), u=u) == want, u
    assert one(S.is_english("t"), t="the cat is in the house with a dog") is True and one(S.is_english("t"), t="der Hund ist in dem Haus mit der Katze") is False


def test_catalog(spark):
    cols = "ord int, id string, title string, metadata_created string, license_id string, license_title string, contact_name string, contact_email string, publisher_name string, publisher_email string, publisher_uri string, organization_id string, organization_title string"
    df = spark.createDataFrame([
        (1, "d1", "One", "2024-01-31T10:00:00Z", "CC", "", "Ada;Bob", "ada@x", "Pub;Sec", "p@x", "", "o1", "First"),
        (2, "d2", "", "someday", "cc", "Creative", ";", "x@x;y@x", "", "mail@x", "", "o1", "Second"),
        (3, "", "skipped", "", "", "", "", "", "", "", "", "", "")], cols)
    t = K.Catalog(df).tables()
    assert len(t) == 12 and t["datasets"].count() == 2
    people = {r.label: r for r in t["persons"].collect()}
    assert set(people) == {"Ada", "Bob", "x@x"} and people["x@x"].quality == "nameless" and people["x@x"].denoted_by.count(";") == 1
    assert rows(t["organizations"], "label") == [("First",)]
    assert rows(t["licenses"], "label") == [("Creative",)]
    assert rows(t["dates"], "value") == [("01/31/2024",), ("someday",)]
    proc = {r.label: r for r in t["processes"].collect()}
    assert proc["dataset publishing process for One"].has_participant.count("|") == 1
    assert rows(t["agents"], "label") == [("ContactPoint: Pub",), ("ContactPoint: Sec",), ("ContactPoint: mail@x",)]


def test_intake(spark):
    rows_ = spark.createDataFrame([(1, "A", "ada|bob", "cc"), (2, "B", "ada|zed", ""), (3, "", "", ""), (4, "# c", "", "")], "row_id int, label string, creators string, license string")
    index = spark.createDataFrame([("ada", "i1"), ("bob", "i2")], "key string, iri string")
    ok = T.must_resolve(T.intake_guards(rows_), ["creators"], index)
    assert rows(ok) == [(1, True, ""), (2, False, "zed")]
    out = T.promote_rows(rows_.where("row_id = 1").withColumn("k", F.lit(0)), {"license": (ONT + "L", "licence of %s")}, BASE, 100, F.col("k"))
    assert rows(out, "part", "id", "label") == [("entity", BASE + "100", "A"), ("license", BASE + "101", "licence of A")]


def test_axiom_directives(spark):
    """C, DOMAIN and RANGE become class expressions with stable blank nodes; what is not found is reported."""
    head = [["id", "type", "name", "kind of", "made of", "both", "from", "to"],
            ["ID", "TYPE", "A rdfs:label", "C % SPLIT=|", f"C <{ONT}partOf> some (% or not 'Wood')", f"C {ONT}Thing and inverse {ONT}p min 2 %", "DOMAIN", f"RANGE {ONT}q only %"]]
    lines = [[BASE + "1", ONT + "K", "Wood", "", "", "", "", ""], [BASE + "2", ONT + "K", "Oak", "wood| stone", "oak", "Wood", "", ""], [BASE + "3", ONT + "K", "made", "", "", "", "Oak", "wood"]]
    data, dirs = sheet(spark, {"one": head + lines})
    quads, missing = T.template_to_triples(data, dirs, "g")
    got = [(r.s, r.p, r.o) for r in quads.collect()]
    assert sorted(map(tuple, T.template_to_triples(data, dirs, "g")[0].select("s", "p", "o").collect())) == sorted(got)
    assert [(r.id, r.header, r.value) for r in missing.collect()] == [(BASE + "2", "kind of", "stone")]
    tree = {}
    for a, p, o in got:
        tree.setdefault(a, []).append((p.rpartition("#")[2] if "#" in p else p.rpartition("/")[2], o))

    def show(x):
        if not x.startswith("_:"):
            return x.removeprefix(ONT).removeprefix(BASE).rpartition("#")[2]
        return {p: show(o) for p, o in tree[x]}

    ordered = lambda x: json.dumps(x, sort_keys=True)
    nil = lambda x: {"first": x, "rest": "nil"}
    of = lambda x, name: sorted((show(o) for p, o in tree[BASE + x] if p == name), key=ordered)
    assert of("2", "subClassOf") == sorted(["1", {
        "type": "Restriction", "onProperty": "partOf", "someValuesFrom": {"type": "Class", "unionOf": {"first": "2", "rest": nil({"type": "Class", "complementOf": "1"})}}}, {
        "type": "Class", "intersectionOf": {"first": "Thing", "rest": nil({"type": "Restriction", "onProperty": {"inverseOf": "p"}, "minQualifiedCardinality": "2", "onClass": "1"})}}], key=ordered)
    assert of("3", "domain") == ["2"] and of("3", "range") == [{"type": "Restriction", "onProperty": "q", "allValuesFrom": "1"}]
    assert {r.o_datatype.rpartition("#")[2] for r in quads.where("o = '2'").collect()} == {"nonNegativeInteger"}
    for bad in ("(a", "a some", "inverse a", "a b"):
        try:
            A.Expression(bad)
            raise AssertionError(bad)
        except ValueError:
            pass
