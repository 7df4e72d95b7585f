"""Registered queries: patterns, joins, sets, windows, limits."""

from pyspark.sql import functions as F

from kgspark.functions import scalars as S
from kgspark.model import BASE, LABEL, ONT, OWL, QUAD_COLS, RDFS, TERMS, TRIPLE_COLS, TYPE, expand
from kgspark.operators import harvest, metrics, pattern as P
from kgspark.operators.ordinal import with_ordinal
from kgspark.plans.registry import query
from kgspark.plans.sqltext import CLASS_TYPES, EN, NODE, PROP_TYPES, TRIPLE, UNION_GRAPH, e, left, ty, v

ALL_SIZES = "catalog datasets process events documents files meta assets ontology approved"
CATALOG = BASE + "g/catalog"
Q8 = ", ".join(QUAD_COLS)


def n(name):
    return F.count(F.lit(1)).alias(name)


@query("pattern_count", sql="SELECT p, count(*) AS matches FROM quads WHERE o_kind = 'literal' AND o_lang <> '' GROUP BY p")
def _(c):
    return P.match(c.quads, cond=(F.col("o_kind") == "literal") & (F.col("o_lang") != "")).groupBy("p").agg(n("matches"))


@query("pattern_graph", sql=f"SELECT graph, p, count(*) AS n FROM quads WHERE graph = '{CATALOG}' OR p = 'rdf:type' GROUP BY graph, p")
def _(c):
    a = P.match(c.quads, graph=CATALOG).where(F.col("p") != TYPE)
    return a.unionByName(P.match(c.quads, p=TYPE)).groupBy("graph", "p").agg(n("n"))


@query("list_graphs", sql=f"SELECT DISTINCT graph FROM quads WHERE starts_with(graph, '{BASE}f') ORDER BY graph LIMIT 2000")
def _(c):
    return metrics.list_graphs(c.quads, BASE + "f")


@query("kind_filters", sql="SELECT s_kind, o_kind, count(*) AS n, count(DISTINCT p) AS predicates FROM quads GROUP BY s_kind, o_kind")
def _(c):
    per_p = c.quads.groupBy("s_kind", "o_kind", "p").agg(n("k"))
    return per_p.groupBy("s_kind", "o_kind").agg(F.sum("k").alias("n"), n("predicates"))


@query("lang_filter", preds="rdfs:label", sql=f"SELECT o_lang, count(*) AS n FROM quads WHERE p = 'rdfs:label' AND {EN} GROUP BY o_lang")
def _(c):
    return P.match(c.quads, p=LABEL, cond=S.english("o_lang")).groupBy("o_lang").agg(n("n"))


@query("pred_in_list", graphs="catalog process", sql="SELECT p, count(*) AS n FROM quads WHERE p IN ('ont:hasInput', 'ont:locatedIn', 'ont:outputOf') "
       "AND p NOT IN ('ont:outputOf') GROUP BY p")
def _(c):
    q = c.quads.where(F.col("p").isin(TERMS.has_input, TERMS.located_in, TERMS.output_of))
    return q.where(~F.col("p").isin(TERMS.output_of)).groupBy("p").agg(n("n"))


@query("url_contains", preds="ont:hasUrl", sql="SELECT s, o AS url FROM quads WHERE p = 'ont:hasUrl' AND contains(lower(o), 'github.com')")
def _(c):
    return P.value(c.quads, TERMS.has_url, "s", "url", cond=F.lower("o").contains("github.com"))


@query("strip_bnodes", sql="SELECT graph, p, count(*) AS n FROM quads WHERE s_kind <> 'bnode' AND o_kind <> 'bnode' GROUP BY graph, p")
def _(c):
    return P.strip_bnodes(c.quads).groupBy("graph", "p").agg(n("n"))


TERMLIST = [ONT + "type/PROMO", ONT + "brand#7", OWL + "deprecated"]
TERMSQL = ", ".join(f"'{x}'" for x in TERMLIST)


@query("prefilter_terms", sql=f"""
    SELECT {Q8} FROM quads WHERE s NOT IN ({TERMSQL}) AND p NOT IN ({TERMSQL}) AND NOT (o_kind = 'iri' AND o IN ({TERMSQL}))
    AND NOT (s = 'ont:partOf' AND p = 'owl:propertyChainAxiom')""")
def _(c):
    terms = c.spark.createDataFrame([(t,) for t in TERMLIST], "t string")
    return P.drop_terms(c.quads, terms, TERMS.part_of, OWL + "propertyChainAxiom").select(QUAD_COLS)


@query("delete_where", sql=f"""
    SELECT {Q8} FROM quads WHERE NOT (s = 'ont:partOf' AND p = 'rdfs:subPropertyOf' AND o = 'ont:partOf')""")
def _(c):
    return P.delete_where(c.quads, TERMS.part_of, RDFS + "subPropertyOf", TERMS.part_of)


@query("drop_individuals", graphs="ontology assets datasets", sql=f"""
    WITH d AS (SELECT DISTINCT s AS o FROM quads WHERE p = 'rdf:type' AND o IN ('owl:Class', 'rdfs:Class')),
    bad AS (SELECT s FROM quads WHERE p = 'rdf:type' AND (o = 'owl:NamedIndividual' OR o IN (SELECT o FROM d)))
    SELECT s, p, o, o_lang FROM quads WHERE s NOT IN (SELECT s FROM bad)""")
def _(c):
    return P.drop_individuals(c.quads, OWL + "NamedIndividual", metrics.CLASS_TYPES).select("s", "p", "o", "o_lang")


@query("dataset_titles", graphs="datasets", preds="a label ont:denotedBy ont:literalTitle", sql=f"""
    SELECT graph, dataset, coalesce(nt, lt, bt) AS title
    FROM (SELECT DISTINCT graph, s AS dataset FROM quads WHERE p = 'rdf:type' AND o IN ('ont:Dataset', 'ont:LegacyDataset', 'ont:OpenDataset')) d
    LEFT JOIN (SELECT a.graph, a.s AS dataset, b.o AS nt FROM quads a JOIN quads b ON a.graph = b.graph AND a.o = b.s AND b.p = 'rdfs:label'
               JOIN quads k ON k.graph = a.graph AND k.s = a.o AND k.p = 'rdf:type' AND k.o = 'ont:Title' WHERE a.p = 'ont:denotedBy') USING (graph, dataset)
    LEFT JOIN {v('ont:literalTitle', 'dataset', 'lt', keep='graph, ')} USING (graph, dataset)
    LEFT JOIN {v('rdfs:label', 'dataset', 'bt', keep='graph, ')} USING (graph, dataset)""")
def _(c):
    return metrics.dataset_titles(c.quads)


# --- joins -----------------------------------------------------------------------------------

@query("bgp_star", graphs="process datasets", preds="a ont:hasInput ont:hasParticipant label", sql=f"""
    SELECT participant, count(*) AS pairs, count(DISTINCT label) AS labels FROM {ty('ont:Process', 'proc')}
    JOIN {e('ont:hasInput', 'proc', 'input')} USING (proc) JOIN {e('ont:hasParticipant', 'proc', 'participant')} USING (proc)
    JOIN {v('rdfs:label', 'input', 'label')} USING (input) GROUP BY participant""")
def _(c):
    q = c.quads
    rows = P.bgp(P.typed(q, TERMS.process, "proc"), P.link(q, TERMS.has_input, "proc", "input"), P.link(q, TERMS.participant, "proc", "participant"), P.labels(q, "input", "label"))
    per = rows.groupBy("participant", "label").agg(n("k"))
    return per.groupBy("participant").agg(F.sum("k").alias("pairs"), n("labels"))


@query("optional_block", graphs="catalog", preds="a label ont:denotedBy ont:externalId", sql=f"""
    SELECT person, label, email, id FROM {ty('ont:Person', 'person')} JOIN {v('rdfs:label', 'person', 'label')} USING (person)
    LEFT JOIN (SELECT person, o AS email FROM {e('ont:denotedBy', 'person', 'n')} JOIN {ty('ont:Email', 'n')} USING (n) JOIN (SELECT s AS n, o FROM quads WHERE p = 'rdfs:label') USING (n)) USING (person)
    LEFT JOIN {v('ont:externalId', 'person', 'id')} USING (person)""")
def _(c):
    q = c.quads
    base = P.typed(q, TERMS.person, "person").join(P.labels(q, "person", "label"), "person")
    return P.optional(base, P.via_node(q, TERMS.denoted_by, LABEL, "person", "email", TERMS.email), P.value(q, TERMS.external_id, "person", "id"))


@query("optional_nested", graphs="assets", preds="a label ont:hasLicense ont:hasLanguage", sql=f"""
    SELECT asset, lic, lic_label, lng, lng_label FROM {ty('owl:NamedIndividual', 'asset')}
    LEFT JOIN (SELECT * FROM {e('ont:hasLicense', 'asset', 'lic')} LEFT JOIN {v('rdfs:label', 'lic', 'lic_label')} USING (lic)) USING (asset)
    LEFT JOIN (SELECT * FROM {e('ont:hasLanguage', 'asset', 'lng')} LEFT JOIN {v('rdfs:label', 'lng', 'lng_label')} USING (lng)) USING (asset)""")
def _(c):
    q = c.quads
    lic = P.optional(P.link(q, TERMS.license, "asset", "lic"), P.labels(q, "lic", "lic_label"))
    lng = P.optional(P.link(q, TERMS.language, "asset", "lng"), P.labels(q, "lng", "lng_label"))
    return P.optional(P.typed(q, OWL + "NamedIndividual", "asset"), lic, lng).select("asset", "lic", "lic_label", "lng", "lng_label")


@query("label_lookup", preds="a label", sql=f"""
    SELECT graph, cls, n, label FROM (SELECT graph, o AS cls, count(*) AS n FROM quads WHERE p = 'rdf:type' GROUP BY graph, o)
    LEFT JOIN (SELECT DISTINCT s AS cls, o AS label FROM quads WHERE p = 'rdfs:label' AND {EN}) USING (cls)""")
def _(c):
    base = metrics.instance_counts(c.quads).withColumnRenamed("class_iri", "cls")
    return P.optional(base, P.english_labels(c.quads, "cls", "label")).select("graph", "cls", "n", "label")


@query("values_join", preds="a", sql="SELECT o AS cls, count(*) AS n FROM quads WHERE p = 'rdf:type' AND o IN ('ont:Person', 'ont:Process', 'ont:File') GROUP BY o")
def _(c):
    t = P.match(c.quads, p=TYPE).select(F.col("o").alias("cls"))
    return P.values_join(t, "cls", [TERMS.person, TERMS.process, TERMS.file]).groupBy("cls").agg(n("n"))


@query("not_exists", graphs="assets", preds="a label ont:hasLicense ont:isAbout ont:roleOf", sql=f"""
    SELECT s FROM {ty('owl:NamedIndividual', 's')} t WHERE NOT EXISTS (SELECT 1 FROM quads q WHERE q.s = t.s AND q.p = 'rdfs:label')
    OR (NOT EXISTS (SELECT 1 FROM quads q WHERE q.s = t.s AND q.p = 'ont:hasLicense') AND NOT EXISTS (SELECT 1 FROM quads q WHERE q.s = t.s AND q.p = 'ont:isAbout')
    AND NOT EXISTS (SELECT 1 FROM quads q WHERE q.s = t.s AND q.p = 'ont:roleOf'))""")
def _(c):
    q, t = c.quads, P.typed(c.quads, OWL + "NamedIndividual")
    a = P.not_exists(t, P.match(q, p=LABEL), on=["s"])
    b = P.not_exists(t, *[P.match(q, p=p) for p in (TERMS.license, TERMS.about, TERMS.role_of)], on=["s"])
    return a.unionByName(b).distinct()


@query("exists_semi", sql=f"SELECT DISTINCT a.p FROM quads a WHERE EXISTS (SELECT 1 FROM quads b WHERE b.p = a.p AND b.o_kind = 'iri')")
def _(c):
    return P.semi(c.quads.select("p").distinct(), c.quads.where("o_kind = 'iri'"), "p")


@query("disjoint_violation", graphs="documents ontology", preds="a owl:disjointWith", sql=f"""
    SELECT x, d.c, d.d FROM (SELECT DISTINCT s AS c, o AS d FROM quads WHERE p = 'owl:disjointWith') d
    JOIN (SELECT DISTINCT s AS x, o AS c FROM quads WHERE p = 'rdf:type') a USING (c) JOIN (SELECT DISTINCT s AS x, o AS d FROM quads WHERE p = 'rdf:type') b USING (x, d)""")
def _(c):
    from kgspark.operators.verify import disjoint_members
    return disjoint_members(c.quads)


@query("graph_var_join", graphs="meta files", sql=f"""
    SELECT q.graph, q.p, count(*) AS n FROM quads q WHERE q.graph IN (SELECT s FROM quads WHERE graph = 'g:meta' AND p = 'rdf:type' AND o = 'ont:File') GROUP BY q.graph, q.p""")
def _(c):
    meta, quads = c.graph("meta", preds=("a",)), c.graph("files")
    names = P.typed(meta, TERMS.file, "graph")
    return quads.groupBy("graph", "p").agg(n("n")).join(names, "graph")


# the second source: the assets graph as if it were a store of its own
@query("federated_join", graphs="datasets assets", preds="a ont:denotedBy ont:hasUrl ont:brand ont:externalId", sql="""
    WITH one AS (SELECT * FROM quads WHERE graph = 'g:datasets'), two AS (SELECT * FROM quads WHERE graph = 'g:assets')
    SELECT pub, doi, asset FROM (SELECT a.s AS pub, regexp_extract(b.o, '[0-9]+$', 0) AS doi FROM one a JOIN one b ON a.o = b.s AND b.p = 'ont:hasUrl' WHERE a.p = 'ont:externalId')
    JOIN (SELECT s AS asset, regexp_extract(o, '[0-9]+$', 0) AS doi FROM two WHERE p = 'ont:hasUrl') USING (doi) WHERE doi <> ''""")
def _(c):
    one, two = c.graph("datasets"), c.graph("assets")
    tail = lambda x: F.regexp_extract(x, "[0-9]+$", 0)
    left_ = P.via_node(one, TERMS.external_id, TERMS.has_url, "pub", "url").select("pub", tail("url").alias("doi"))
    right = P.value(two, TERMS.has_url, "asset", "url").select("asset", tail("url").alias("doi"))
    return left_.where("doi <> ''").join(right, "doi").select("pub", "doi", "asset")


@query("derived_key_join", graphs="catalog events", preds="ont:externalId ont:hasUrl label owl:sameAs", sql="""
    SELECT person, key, user_iri, label FROM (SELECT s AS person, regexp_replace(s, '^.*/', '') AS key FROM quads WHERE p = 'ont:externalId' AND contains(lower(o), 'orcid'))
    JOIN (SELECT s AS user_iri, regexp_replace(o, '^.*/', '') AS key FROM quads WHERE p = 'owl:sameAs') USING (key)
    LEFT JOIN (SELECT s AS person, o AS label FROM quads WHERE p = 'rdfs:label') USING (person)""")
def _(c):
    q, tail = c.quads, lambda x: F.regexp_replace(x, "^.*/", "")
    a = P.value(q, TERMS.external_id, "person", "id", cond=F.lower("o").contains("orcid")).select("person", tail("person").alias("key"))
    b = P.link(q, OWL + "sameAs", "user_iri", "same").select("user_iri", tail("same").alias("key"))
    return P.optional(a.join(b, "key"), P.labels(q, "person", "label")).select("person", "key", "user_iri", "label")


@query("vocab_reuse", graphs="catalog datasets process assets ontology", sql="""
    WITH t AS (SELECT DISTINCT s AS iri, CASE o WHEN 'owl:Class' THEN 'class' WHEN 'owl:ObjectProperty' THEN 'object' ELSE 'data' END AS kind FROM quads
      WHERE graph = 'g:ontology' AND p = 'rdf:type' AND s_kind = 'iri' AND o IN ('owl:Class', 'owl:ObjectProperty', 'owl:DatatypeProperty')),
    d AS (SELECT * FROM quads WHERE graph <> 'g:ontology'),
    used AS (SELECT graph, o AS iri, 'class' AS kind FROM d WHERE p = 'rdf:type' AND o_kind = 'iri' UNION SELECT graph, s, 'class' FROM d WHERE p = 'rdf:type' AND o IN ('owl:Class', 'rdfs:Class')
      UNION SELECT graph, p, 'object' FROM d WHERE o_kind <> 'literal' UNION SELECT graph, p, 'data' FROM d WHERE o_kind = 'literal')
    SELECT graph, kind, iri FROM used JOIN t USING (iri, kind)""")
def _(c):
    from kgspark.sources.scan import onto_terms
    return metrics.vocabulary_reuse(c.graph("catalog", "datasets", "process", "assets"), onto_terms(c.graph("ontology", preds=("a",))))


def _nine(name: str, rows: str) -> str:
    """The nine whole-graph figures of the triples ``rows``, named ``name``."""
    kind = lambda types: f"(SELECT s FROM {name}_t WHERE p = 'rdf:type' AND o IN {types})"
    return f"""{name}_t AS (SELECT DISTINCT {TRIPLE} FROM quads WHERE {rows}), {name} AS (SELECT 'triples' AS metric, count(*) AS v FROM {name}_t UNION ALL SELECT 'num_subjects', count(DISTINCT s) FROM {name}_t
      UNION ALL SELECT 'num_predicates', count(DISTINCT p) FROM {name}_t UNION ALL SELECT 'num_objects', count(*) FROM (SELECT DISTINCT o, o_kind, o_datatype, o_lang FROM {name}_t)
      UNION ALL SELECT 'num_literals', count(*) FROM {name}_t WHERE o_kind = 'literal' UNION ALL SELECT 'num_resources', count(*) FROM (SELECT s FROM {name}_t UNION SELECT p FROM {name}_t UNION SELECT o FROM {name}_t WHERE {NODE})
      UNION ALL SELECT 'num_classes', count(DISTINCT s) FROM {kind(CLASS_TYPES)} UNION ALL SELECT 'num_properties', count(DISTINCT s) FROM {kind(PROP_TYPES)}
      UNION ALL SELECT 'num_individuals', count(DISTINCT s) FROM {name}_t WHERE p = 'rdf:type' AND s NOT IN {kind(CLASS_TYPES)} AND s NOT IN {kind(PROP_TYPES)})"""


@query("kg_compare", graphs="catalog datasets", sql=f"""
    WITH {_nine('a', "graph = 'g:catalog'")}, {_nine('b', "graph = 'g:datasets'")} SELECT metric, a.v AS left_value, b.v AS right_value FROM a JOIN b USING (metric)""")
def _(c):
    stats = lambda g: metrics.kg_stats(P.union_graph(c.graph(g)))
    return metrics.compare(stats("catalog"), stats("datasets")).select("metric", "left_value", "right_value")


@query("record_lookup", graphs="files meta", sql="""
    WITH r AS (SELECT s AS graph, max(o) AS r FROM quads WHERE graph = 'g:meta' AND p = 'ont:partOf' GROUP BY s)
    SELECT g.graph, coalesce(r.r, split_part(g.graph, '/graph/', 1)) AS record FROM (SELECT DISTINCT graph FROM quads) g LEFT JOIN r USING (graph)""")
def _(c):
    part = P.link(c.graph("meta", preds=("ont:partOf",)), TERMS.part_of, "graph", "record")
    return harvest.record_lookup(c.quads.select("graph").distinct(), part)


@query("path_chain", graphs="process", preds="ont:occupies ont:firstInstant ont:timestamp", sql="""
    SELECT a.s AS proc, d.o AS began FROM quads a JOIN quads b ON a.o = b.s AND b.p = 'ont:firstInstant' JOIN quads d ON b.o = d.s AND d.p = 'ont:timestamp' WHERE a.p = 'ont:occupies'""")
def _(c):
    start = P.link(c.quads, TERMS.occupies, "proc", "reg")
    return P.path_chain(start, c.quads, "reg", (TERMS.first_instant, "i"), (TERMS.timestamp, "began")).select("proc", "began")


@query("discover_endpoints", graphs="assets", preds="a ont:hasUrl ont:denotedBy", sql=f"""
    SELECT endpoint, url, dataset FROM {ty('ont:Endpoint', 'endpoint')} JOIN (SELECT DISTINCT s AS endpoint, o AS url FROM quads WHERE p = 'ont:hasUrl' AND (starts_with(o, 'http://') OR starts_with(o, 'https://'))) USING (endpoint)
    LEFT JOIN (SELECT DISTINCT s AS dataset, o AS endpoint FROM quads WHERE p = 'ont:denotedBy' AND {NODE}) USING (endpoint)""")
def _(c):
    return harvest.discover_endpoints(c.quads, TERMS.endpoint, TERMS.has_url, TERMS.denoted_by)


@query("migrate_terms", graphs="datasets", preds="a", sql="""
    SELECT CASE o WHEN 'ont:LegacyDataset' THEN 'ont:Dataset' WHEN 'ont:Article' THEN 'ont:Publication' ELSE o END AS o, count(*) AS n FROM quads WHERE p = 'rdf:type' GROUP BY 1""")
def _(c):
    m = c.spark.createDataFrame(list(TERMS.replacements.items()), "old string, new string")
    return harvest.migrate_terms(P.match(c.quads, p=TYPE), "o", m).groupBy("o").agg(n("n"))


# --- sets ---------------------------------------------------------------------------------------

@query("merge_graphs", graphs="documents files ontology approved", sql=f"SELECT p, count(*) AS n FROM (SELECT DISTINCT {TRIPLE} FROM quads) GROUP BY p")
def _(c):
    parts = [c.graph(g) for g in ("documents", "files", "ontology", "approved")]
    return P.merge(*parts, graph=BASE + "g/merged").groupBy("p").agg(n("n"))


@query("pattern_union", graphs="catalog ontology", preds="a label", sql="""
    SELECT s, count(*) AS n FROM (SELECT s FROM quads WHERE p = 'rdf:type' AND o = 'owl:Class' UNION ALL SELECT s FROM quads WHERE p = 'rdfs:label') GROUP BY s""")
def _(c):
    a, b = P.match(c.quads, p=TYPE, o=OWL + "Class").select("s"), P.match(c.quads, p=LABEL).select("s")
    return P.pattern_union(a, b).groupBy("s").agg(n("n"))


@query("insert_absent", graphs="documents files", sql=f"""
    WITH t AS (SELECT {TRIPLE} FROM quads WHERE graph = 'g:documents'), f AS (SELECT DISTINCT {TRIPLE} FROM quads WHERE graph <> 'g:documents')
    SELECT p, count(*) AS n FROM (SELECT * FROM t UNION ALL (SELECT * FROM f EXCEPT SELECT * FROM t)) GROUP BY p""")
def _(c):
    old, new = c.graph("documents").select(TRIPLE_COLS), c.graph("files").select(TRIPLE_COLS)
    return P.insert_absent(old, new).groupBy("p").agg(n("n"))


@query("registry_union", graphs="meta", sql="SELECT graph, p, count(*) AS n FROM (SELECT graph, p FROM quads UNION ALL SELECT 'urn:default', p FROM quads) GROUP BY graph, p")
def _(c):
    from kgspark.operators.describe import registry_union
    return registry_union(c.quads, BASE + "g/meta").groupBy("graph", "p").agg(n("n"))


@query("record_union", graphs="meta files", sql="""
    SELECT r.record, q.p, count(*) AS n FROM (SELECT DISTINCT record, s, p, o, o_lang FROM (SELECT s AS graph, o AS record FROM quads WHERE graph = 'g:meta' AND p = 'ont:partOf') JOIN quads USING (graph)) q
    JOIN (SELECT DISTINCT o AS record FROM quads WHERE graph = 'g:meta' AND p = 'ont:partOf') r USING (record) GROUP BY r.record, q.p""")
def _(c):
    from kgspark.operators.describe import record_union
    files = P.link(c.graph("meta", preds=("ont:partOf",)), TERMS.part_of, "graph", "record")
    return record_union(c.graph("files"), files).groupBy("record", "p").agg(n("n"))


# --- windows, sorts, limits ---------------------------------------------------------------------

@query("topn_per_graph", sql="""
    SELECT graph, p, n FROM (SELECT *, row_number() OVER (PARTITION BY graph ORDER BY n DESC, p) AS r FROM (SELECT graph, p, count(*) AS n FROM quads GROUP BY graph, p)) WHERE r <= 3""")
def _(c):
    return P.top_n(c.quads.groupBy("graph", "p").agg(n("n")), 3, ["graph"], ["-n", "p"])


@query("top25", sql=f"""
    WITH {UNION_GRAPH}, sch AS (SELECT s FROM u WHERE p = 'rdf:type' AND o IN ('owl:Class', 'rdfs:Class', 'rdf:Property', 'owl:ObjectProperty', 'owl:DatatypeProperty', 'owl:AnnotationProperty')),
    t AS (SELECT 'type' AS kind, o AS term, count(*) AS count FROM u WHERE p = 'rdf:type' AND s NOT IN (SELECT s FROM sch) GROUP BY o ORDER BY 3 DESC, 2 LIMIT 25),
    r AS (SELECT 'predicate' AS kind, p AS term, count(*) AS count FROM u GROUP BY p ORDER BY 3 DESC, 2 LIMIT 25)
    SELECT * FROM t UNION ALL SELECT * FROM r""")
def _(c):
    t = P.union_graph(c.quads)
    return metrics.type_counter(t).select(F.lit("type").alias("kind"), "term", "count").unionByName(
        metrics.predicate_counter(t).select(F.lit("predicate").alias("kind"), "term", "count"))


@query("order_limit", graphs="catalog", preds="label ont:balance", sql="""
    SELECT s, o FROM quads WHERE p = 'ont:balance' ORDER BY o DESC, s LIMIT 100""")
def _(c):
    return P.order_limit(P.value(c.quads, ONT + "balance", "s", "o"), 100, "-o", "s")


@query("page_slice", graphs="catalog", sql="SELECT s, p, o FROM quads ORDER BY s, p, o, o_lang LIMIT 1000 OFFSET 2000")
def _(c):
    return P.page(c.quads.select("s", "p", "o", "o_lang"), 2000, 1000, "s", "p", "o").select("s", "p", "o")


@query("capped", graphs="process", preds="ont:hasInput", sql="SELECT s, p, o FROM quads WHERE p = 'ont:hasInput' ORDER BY o, s LIMIT 5000")
def _(c):
    return P.order_limit(c.quads.select("s", "p", "o"), 5000, "o", "s")


@query("sorted_out", graphs="meta", preds="ont:hasUrl", sql="SELECT s, o AS url FROM quads WHERE p = 'ont:hasUrl' ORDER BY url, s")
def _(c):
    return P.value(c.quads, TERMS.has_url, "s", "url").orderBy("url", "s")


@query("ordinals", sql="SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + 1 AS row_no FROM orders")
def _(c):
    # sheet rows start at 2
    return with_ordinal(c.t("orders").select("o_orderkey"), ["o_orderkey"], "row_no", start=2)


@query("distinct_keys", preds="ont:hasParticipant", sql="SELECT o, count(DISTINCT s) AS n FROM quads GROUP BY o")
def _(c):
    return c.quads.select("o", "s").distinct().groupBy("o").agg(n("n"))


@query("sample_min", preds="label", sql=f"SELECT s, min(o) AS label FROM quads WHERE p = 'rdfs:label' AND {EN} GROUP BY s")
def _(c):
    return P.sample_labels(c.quads, "s", "label")


@query("first_last_wins", sql="""
    SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS first_status, arg_max(o_orderstatus, o_orderkey) AS last_status FROM orders GROUP BY o_custkey""")
def _(c):
    o = c.t("orders")
    first = P.first_wins(o, "o_custkey", "o_orderstatus", "o_orderkey").withColumnRenamed("o_orderstatus", "first_status")
    last = P.first_wins(o, "o_custkey", "o_orderstatus", "o_orderkey", last=True).withColumnRenamed("o_orderstatus", "last_status")
    return first.join(last, "o_custkey")


@query("literal_accessors", sql="""
    SELECT CASE WHEN o_lang <> '' THEN 'rdf:langString' ELSE coalesce(o_datatype, 'xsd:string') END AS datatype, o_lang AS lang, count(*) AS n, max(length(o)) AS longest
    FROM quads WHERE o_kind = 'literal' GROUP BY 1, 2""")
def _(c):
    return c.quads.where("o_kind = 'literal'").groupBy(S.literal_datatype().alias("datatype"), F.col("o_lang").alias("lang")).agg(n("n"), F.max(F.length("o")).cast("bigint").alias("longest"))


@query("cast_literal", graphs="assets", preds="void:entities", sql="SELECT s, CAST(TRY_CAST(o AS DOUBLE) AS BIGINT) AS n, coalesce(CAST(TRY_CAST(o AS DOUBLE) AS BIGINT), 0) AS n0 FROM quads WHERE p = 'void:entities'")
def _(c):
    return c.quads.select("s", S.literal_int("o", None).alias("n"), S.literal_int("o").alias("n0"))


@query("label_fallback", graphs="ontology", preds="a label", sql=f"""
    SELECT c, coalesce(l, CASE WHEN contains(c, '#') THEN substr(c, instr(c, '#') + 1) ELSE '' END) AS strict_label,
      coalesce(l, CASE WHEN contains(c, '#') THEN substr(c, instr(c, '#') + 1) ELSE regexp_extract(c, '([^/]*)/?$', 1) END) AS loose_label
    FROM (SELECT DISTINCT s AS c FROM quads WHERE p = 'rdf:type' AND o = 'owl:Class') LEFT JOIN (SELECT DISTINCT s AS c, o AS l FROM quads WHERE p = 'rdfs:label' AND {EN}) USING (c)""")
def _(c):
    cls = P.typed(c.quads, OWL + "Class", "c")
    return P.optional(cls, P.english_labels(c.quads, "c", "l")).select("c", S.label_fallback("l", "c").alias("strict_label"), S.label_fallback("l", "c", strict=False).alias("loose_label"))


@query("namespace_of", sql="""
    SELECT CASE WHEN contains(o, '#') THEN split_part(o, '#', 1) || '#' ELSE regexp_extract(o, '^(.*/)', 1) END AS ns, count(*) AS n FROM quads WHERE o_kind = 'iri' GROUP BY 1""")
def _(c):
    return c.quads.where("o_kind = 'iri'").groupBy(S.namespace("o").alias("ns")).agg(n("n"))


CURIES = {"kgo": ONT, "kg": BASE, "ow": OWL, "rs": RDFS}


@query("curie", sql="SELECT short, " + "n FROM (SELECT " + "CASE " + " ".join(f"WHEN starts_with(o, '{ns}') THEN '{k}:' || substr(o, {len(ns) + 1})" for k, ns in CURIES.items())
       + " ELSE o END AS short, count(*) AS n FROM quads WHERE o_kind = 'iri' GROUP BY 1)")
def _(c):
    return c.quads.where("o_kind = 'iri'").groupBy(S.curie("o", CURIES).alias("short")).agg(n("n"))


@query("find_by_label", graphs="datasets catalog", preds="a label", sql="""
    SELECT DISTINCT s FROM quads WHERE p = 'rdfs:label' AND lower(trim(regexp_replace(o, '\\s+', ' ', 'g'))) = 'red widget'
    AND s IN (SELECT s FROM quads WHERE p = 'rdf:type' AND o IN ('ont:Publication', 'ont:Person'))""")
def _(c):
    from kgspark.operators.closure import find_by_label
    return find_by_label(c.quads, "  Red   WIDGET ", [ONT + "Publication", TERMS.person])


@query("term_signature", sql="""
    SELECT DISTINCT term FROM (SELECT s AS term FROM quads WHERE s_kind = 'iri' UNION ALL SELECT p FROM quads UNION ALL SELECT o FROM quads WHERE o_kind = 'iri')
    WHERE NOT starts_with(term, 'b:asset') AND NOT starts_with(term, 'owl:')""")
def _(c):
    from kgspark.operators.closure import term_signature
    return term_signature(c.quads, [BASE + "asset", OWL])


@query("onto_labels", graphs="ontology", sql="""
    SELECT l.s, label, declared, coalesce(n, 0) AS synonyms, coalesce(names, '') AS synonym_list FROM
    (SELECT s, min(o) AS label, bool_or(s_kind = 'iri') AS declared FROM (SELECT s, s_kind, o, rank() OVER (PARTITION BY s ORDER BY o_lang) AS r FROM quads WHERE p = 'rdfs:label') WHERE r = 1 GROUP BY s) l
    LEFT JOIN (SELECT s, count(DISTINCT o) AS n, string_agg(DISTINCT o, '|' ORDER BY o) AS names FROM quads WHERE p = 'obo:IAO_0000118' GROUP BY s) a ON a.s = l.s""")
def _(c):
    from kgspark.sources.scan import onto_labels
    return onto_labels(c.quads, "o_lang")


@query("onto_terms", graphs="ontology", preds="a", sql="""
    SELECT DISTINCT s AS iri, CASE o WHEN 'owl:Class' THEN 'class' WHEN 'owl:ObjectProperty' THEN 'object' ELSE 'data' END AS kind
    FROM quads WHERE p = 'rdf:type' AND s_kind = 'iri' AND o IN ('owl:Class', 'owl:ObjectProperty', 'owl:DatatypeProperty')""")
def _(c):
    from kgspark.sources.scan import onto_terms
    return onto_terms(c.quads)
