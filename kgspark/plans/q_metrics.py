"""Registered queries: metric tables, statistics, construct counts, latest views."""

from pyspark.sql import functions as F

from kgspark.functions import scalars as S
from kgspark.model import BASE, METRIC_TABLES, ONT, TERMS, TYPE
from kgspark.operators import describe, metrics as M, pattern as P, questions as Q
from kgspark.operators.ordinal import chunk_lines
from kgspark.plans.registry import VIEWS, query
from kgspark.plans.sqltext import CLASS_TYPES, EN, NODE, PROP_TYPES, TERM, TRIPLE, UNION_GRAPH, e, ty, v
from kgspark.sources import sinks

DS = "('ont:Dataset', 'ont:LegacyDataset', 'ont:OpenDataset')"
SAMPLE = f"(SELECT s AS cls, min(o) AS label FROM quads WHERE p = 'rdfs:label' AND {EN} GROUP BY s)"


def n(name):
    return F.count(F.lit(1)).alias(name)


@query("graph_sizes", sql="SELECT graph, count(*) AS triples, count(DISTINCT s) AS subjects FROM quads GROUP BY graph")
def _(c):
    return M.graph_sizes(c.quads)


def _classes(limit: int, names: str, cond: str = "TRUE") -> str:
    a, b, d = names.split()
    return f"""SELECT graph, cls AS {a}, label AS {b}, n AS "{d}" FROM (SELECT *, row_number() OVER (PARTITION BY graph ORDER BY n DESC, cls) AS r
      FROM (SELECT graph, o AS cls, count(*) AS n FROM quads WHERE p = 'rdf:type' AND {cond} GROUP BY graph, o)) LEFT JOIN {SAMPLE} USING (cls) WHERE r <= {limit}"""


@query("class_counts", preds="a label", sql=_classes(200, "class_iri class_label instances"))
def _(c):
    return M.class_counts(c.quads, c.quads)


@query("entity_type_counts", preds="a label", sql=_classes(500, "concept_iri concept_label count"))
def _(c):
    return M.entity_type_counts(c.quads, c.quads)


@query("dataset_type_counts", preds="a label", sql=_classes(10**9, "dataset_type_iri dataset_type_label count", f"o IN {DS}"))
def _(c):
    return M.dataset_type_counts(c.quads, c.quads)


@query("top_concepts", preds="a label", sql=f"""
    SELECT graph, cls AS concept_iri, coalesce(label, cls) AS concept_label, n AS "count", r AS "rank" FROM (SELECT *, row_number() OVER (PARTITION BY graph ORDER BY n DESC, cls) AS r
    FROM (SELECT graph, o AS cls, count(*) AS n FROM quads WHERE p = 'rdf:type' GROUP BY graph, o)) LEFT JOIN {SAMPLE} USING (cls) WHERE r <= 10""")
def _(c):
    return M.top_concepts(c.quads, c.quads)


@query("property_counts", sql="""
    SELECT graph, p AS property_iri, n AS usage_count FROM (SELECT *, row_number() OVER (PARTITION BY graph ORDER BY n DESC, p) AS r
    FROM (SELECT graph, p, count(*) AS n FROM quads GROUP BY graph, p)) WHERE r <= 100""")
def _(c):
    return M.property_counts(c.quads)


@query("class_property_flow", sql=f"""
    WITH f AS (SELECT t.graph, t.o AS c, q.p, count(*) AS n FROM quads t JOIN quads q ON t.graph = q.graph AND t.s = q.s AND q.p <> 'rdf:type' WHERE t.p = 'rdf:type' GROUP BY ALL),
    lab AS (SELECT DISTINCT s, o FROM quads WHERE p = 'rdfs:label' AND {EN}),
    x AS (SELECT graph, c AS source_iri, coalesce(a.o, c) AS source_label, f.p AS target_iri, coalesce(b.o, f.p) AS target_label, n AS value
      FROM f LEFT JOIN lab a ON a.s = f.c LEFT JOIN lab b ON b.s = f.p)
    SELECT graph, source_iri, source_label, target_iri, target_label, value FROM
    (SELECT *, row_number() OVER (PARTITION BY graph ORDER BY value DESC, source_iri, target_iri, source_label, target_label) AS r FROM x) WHERE r <= 300""")
def _(c):
    return M.class_property_flow(c.quads, c.graph(preds=("label",)))


@query("content_counts", preds="", sql=f"""
    SELECT graph, count(DISTINCT CASE WHEN p = 'rdf:type' AND o IN {DS} THEN s END) AS datasets,
      count(DISTINCT CASE WHEN p = 'rdf:type' AND o IN ('ont:Publication', 'ont:Article') THEN s END) AS publications,
      count(DISTINCT CASE WHEN p = 'rdf:type' AND o = 'ont:Event' THEN s END) AS events FROM quads GROUP BY graph""")
def _(c):
    return M.content_counts(c.quads)


@query("dataset_list", graphs="datasets", preds="a label ont:denotedBy ont:literalTitle ont:hasPart ont:hasUrl", sql=f"""
    WITH t AS (SELECT d.graph, dataset, coalesce(nt, lt, bt) AS title FROM (SELECT DISTINCT graph, s AS dataset FROM quads WHERE p = 'rdf:type' AND o IN {DS}) d
      LEFT JOIN (SELECT a.s AS dataset, b.o AS nt FROM quads a JOIN quads b ON a.o = b.s AND b.p = 'rdfs:label' JOIN quads k ON k.s = a.o AND k.p = 'rdf:type' AND k.o = 'ont:Title'
        WHERE a.p = 'ont:denotedBy') USING (dataset)
      LEFT JOIN {v('ont:literalTitle', 'dataset', 'lt')} USING (dataset) LEFT JOIN {v('rdfs:label', 'dataset', 'bt')} USING (dataset)),
    part AS (SELECT a.s AS dataset, b.o AS l FROM quads a JOIN quads b ON a.o = b.s AND b.p = 'rdfs:label' WHERE a.p = 'ont:hasPart'),
    x AS (SELECT DISTINCT graph, dataset AS dataset_iri, title, c.l AS creator, f.l AS creator_affiliation, link FROM t LEFT JOIN part c USING (dataset) LEFT JOIN part f USING (dataset)
      LEFT JOIN (SELECT a.s AS dataset, b.o AS link FROM quads a JOIN quads b ON a.o = b.s AND b.p = 'ont:hasUrl' WHERE a.p = 'ont:denotedBy') USING (dataset))
    SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY graph ORDER BY dataset_iri, title, creator, creator_affiliation, link) AS r FROM x) WHERE r <= 500""")
def _(c):
    return M.dataset_list(c.quads)


def _per_target(p, member, target, names, limit):
    k, lab, cnt = names.split()
    return f"""SELECT graph, {k}, label AS {lab}, {cnt} FROM (SELECT *, row_number() OVER (PARTITION BY graph ORDER BY {cnt} DESC, {k}) AS r FROM
      (SELECT graph, {k}, count(DISTINCT m) AS {cnt} FROM {ty(member, 'm')} JOIN {e(p, 'm', k, keep='graph, ')} USING (m) JOIN {ty(target, k)} USING ({k}) GROUP BY graph, {k}))
      LEFT JOIN (SELECT s AS {k}, min(o) AS label FROM quads WHERE p = 'rdfs:label' AND {EN} GROUP BY s) USING ({k}) WHERE r <= {limit}"""


@query("orgs_by_city", graphs="catalog", preds="a label ont:locatedIn", sql=_per_target("ont:locatedIn", "ont:Organization", "ont:City", "city_iri city_label org_count", 200))
def _(c):
    return M.orgs_by_city(c.quads)


@query("orgs_by_people", graphs="catalog", preds="a label ont:participatesIn", sql=_per_target("ont:participatesIn", "ont:Person", "ont:Organization", "org_iri org_label people_count", 50))
def _(c):
    return M.orgs_by_people(c.quads)


RDF_STATS = f"""SELECT graph, count(*) AS triples, count(DISTINCT s) AS subjects, count(DISTINCT p) AS predicates, count(DISTINCT {TERM}) AS objects,
    count(*) FILTER (p = 'rdf:type') AS type_assertions, count(DISTINCT CASE WHEN p = 'rdf:type' THEN {TERM} END) AS distinct_type_objects FROM quads GROUP BY graph"""


@query("rdf_stats", sql=RDF_STATS)
def _(c):
    return M.rdf_stats(c.quads)


VOID_SQL = """SELECT graph, count(*) AS triples, count(DISTINCT s) AS subjects, count(DISTINCT p) AS predicates, count(DISTINCT CASE WHEN p = 'rdf:type' AND o_kind = 'iri' THEN o END) AS classes
    FROM quads GROUP BY graph"""
VOID_PARTS = """SELECT graph, kind, iri, "count", r AS "rank" FROM (SELECT *, row_number() OVER (PARTITION BY graph, kind ORDER BY "count" DESC, iri) AS r FROM
    (SELECT graph, 'class' AS kind, o AS iri, count(*) AS "count" FROM quads WHERE p = 'rdf:type' AND o_kind = 'iri' GROUP BY graph, o
     UNION ALL SELECT graph, 'property', p, count(*) FROM quads GROUP BY graph, p)) WHERE r <= 20"""


@query("void_stats", sql=f"SELECT * FROM ({VOID_SQL}) JOIN (SELECT graph, count(*) AS partitions FROM ({VOID_PARTS}) GROUP BY graph) USING (graph)")
def _(c):
    parts = M.void_partitions(c.quads).groupBy("graph").agg(n("partitions"))
    return M.void_stats(c.quads).join(parts, "graph")


@query("void_partitions", sql=VOID_PARTS)
def _(c):
    return M.void_partitions(c.quads)


@query("kg_stats", sql=f"""
    WITH {UNION_GRAPH}, cls AS (SELECT DISTINCT s FROM u WHERE p = 'rdf:type' AND o IN {CLASS_TYPES}), prp AS (SELECT DISTINCT s FROM u WHERE p = 'rdf:type' AND o IN {PROP_TYPES})
    SELECT 'triples' AS metric, count(*) AS value FROM u UNION ALL SELECT 'num_subjects', count(DISTINCT s) FROM u UNION ALL SELECT 'num_predicates', count(DISTINCT p) FROM u
    UNION ALL SELECT 'num_objects', count(DISTINCT {TERM}) FROM u UNION ALL SELECT 'num_literals', count(*) FROM u WHERE o_kind = 'literal'
    UNION ALL SELECT 'num_resources', count(DISTINCT x) FROM (SELECT s AS x FROM u UNION ALL SELECT p FROM u UNION ALL SELECT o FROM u WHERE {NODE})
    UNION ALL SELECT 'num_classes', count(*) FROM cls UNION ALL SELECT 'num_properties', count(*) FROM prp
    UNION ALL SELECT 'num_individuals', count(DISTINCT s) FROM u WHERE p = 'rdf:type' AND s NOT IN (SELECT s FROM cls) AND s NOT IN (SELECT s FROM prp)""")
def _(c):
    return M.kg_stats(P.union_graph(c.quads))


def _construct_sql() -> str:
    rows = []
    for k, m in M.CONSTRUCTS.items():
        terms = [f"(SELECT count(*) FROM u WHERE p = 'owl:{p}')" for p in m.get("p", [])]
        terms += [f"(SELECT count(*) FROM u WHERE p = 'rdfs:{p}')" for p in m.get("rdfs", [])]
        terms += [f"(SELECT count(*) FROM u WHERE p = 'rdf:type' AND o = 'owl:{t}')" for t in m.get("t", [])]
        kind = lambda x: "= 'literal'" if x == "literal" else "<> 'literal'"
        if "value" in m:
            terms.append(f"(SELECT count(*) FROM u WHERE p = 'owl:hasValue' AND o_kind {kind(m['value'])})")
        if "some" in m:
            terms.append(f"(SELECT count(*) FROM u WHERE p = 'owl:someValuesFrom' AND o {'=' if m['some'] == 'thing' else '<>'} 'owl:Thing')")
        if "one_of" in m:
            terms.append(f"(SELECT count(*) FROM u a JOIN u b ON a.o = b.s AND b.p = 'rdf:first' AND b.o_kind {kind(m['one_of'])} WHERE a.p = 'owl:oneOf')")
        if "card" in m:
            has = lambda p, o: f"EXISTS (SELECT 1 FROM u x WHERE x.s = r.s AND x.p = 'owl:{p}'" + (f" AND x.o = '{o}')" if o else ")")
            tops = (has("onClass", "owl:Thing"), has("onDataRange", "rdfs:Literal"))
            cond = (f"{tops[0]} OR {tops[1]}" if m["card"] == "top" else
                    f"(NOT {tops[0]} AND {has('onClass', None)}) OR (NOT {tops[1]} AND {has('onDataRange', None)})")
            terms.append(f"(SELECT count(*) FROM u r WHERE r.p IN ('owl:minQualifiedCardinality', 'owl:qualifiedCardinality', 'owl:maxQualifiedCardinality') AND ({cond}))")
        rows.append(f"SELECT '{k}' AS construct, {' + '.join(terms)} AS \"count\"")
    return f"WITH {UNION_GRAPH} " + " UNION ALL ".join(rows)


@query("dl_constructs", sql=_construct_sql())
def _(c):
    return M.dl_constructs(P.union_graph(c.quads))


@query("local_counts", sql="""
    SELECT graph, count(DISTINCT CASE WHEN p = 'rdf:type' AND s_kind = 'iri' AND o = 'owl:Class' THEN s END) AS classes, count(DISTINCT CASE WHEN p = 'rdf:type' AND s_kind = 'iri' AND o = 'owl:ObjectProperty' THEN s END) AS object_properties,
    count(DISTINCT CASE WHEN p = 'rdf:type' AND s_kind = 'iri' AND o = 'owl:DatatypeProperty' THEN s END) AS data_properties, count(DISTINCT CASE WHEN p = 'rdf:type' AND s_kind = 'iri' THEN s END) AS instances FROM quads GROUP BY graph""")
def _(c):
    return M.local_counts(c.quads)


@query("endpoint_counts", sql=f"""
    WITH g AS (SELECT DISTINCT graph FROM quads), t AS (SELECT * FROM quads WHERE p = 'rdf:type'), d AS (SELECT DISTINCT graph, s AS o FROM t WHERE o IN {CLASS_TYPES}),
    gen AS (SELECT DISTINCT graph, s FROM t WHERE o = 'rdf:Property')
    SELECT graph, coalesce(nullif((SELECT count(DISTINCT s) FROM t WHERE t.graph = g.graph AND o IN {CLASS_TYPES} AND s_kind = 'iri'), 0), (SELECT count(DISTINCT o) FROM t WHERE t.graph = g.graph AND o_kind = 'iri')) AS classes,
    coalesce(nullif((SELECT count(DISTINCT s) FROM (SELECT graph, s FROM t WHERE o = 'owl:ObjectProperty' UNION SELECT gen.graph, gen.s FROM gen JOIN quads q ON q.graph = gen.graph AND q.p = gen.s AND q.o_kind = 'iri') z WHERE z.graph = g.graph), 0),
      (SELECT count(DISTINCT p) FROM quads q WHERE q.graph = g.graph AND o_kind = 'iri' AND p <> 'rdf:type')) AS object_properties,
    coalesce(nullif((SELECT count(DISTINCT s) FROM (SELECT graph, s FROM t WHERE o = 'owl:DatatypeProperty' UNION SELECT gen.graph, gen.s FROM gen JOIN quads q ON q.graph = gen.graph AND q.p = gen.s AND q.o_kind = 'literal') z WHERE z.graph = g.graph), 0),
      (SELECT count(DISTINCT p) FROM quads q WHERE q.graph = g.graph AND o_kind = 'literal')) AS data_properties,
    coalesce(nullif((SELECT count(DISTINCT s) FROM t JOIN d USING (graph, o) WHERE graph = g.graph AND s_kind = 'iri'), 0), (SELECT count(DISTINCT s) FROM t WHERE t.graph = g.graph AND s_kind = 'iri' AND o_kind = 'iri')) AS instances FROM g""")
def _(c):
    return M.endpoint_counts(c.repeated)


@query("instances_per_class", preds="a label", sql=f"""
    WITH t AS (SELECT DISTINCT graph, s, o, o_kind FROM quads WHERE p = 'rdf:type' AND s_kind = 'iri'), d AS (SELECT DISTINCT graph, s AS o FROM quads WHERE p = 'rdf:type' AND o IN {CLASS_TYPES}),
    m AS (SELECT graph, o, count(DISTINCT s) AS n FROM t JOIN d USING (graph, o) GROUP BY graph, o),
    x AS (SELECT * FROM m UNION ALL SELECT graph, o, count(DISTINCT s) FROM t WHERE o_kind = 'iri' AND graph NOT IN (SELECT graph FROM m) GROUP BY graph, o)
    SELECT graph, o AS class_iri, coalesce(l, CASE WHEN contains(o, '#') THEN substr(o, instr(o, '#') + 1) ELSE '' END) AS label, n FROM x
    LEFT JOIN (SELECT graph, s AS o, min(o) AS l FROM quads WHERE p = 'rdfs:label' AND {EN} GROUP BY graph, s) USING (graph, o)""")
def _(c):
    return M.instances_per_class(c.quads)


@query("vocab_namespaces", sql="""
    SELECT DISTINCT graph, CASE WHEN contains(t, '#') THEN split_part(t, '#', 1) || '#' ELSE regexp_extract(t, '^(.*/)', 1) END AS vocabulary FROM
    (SELECT graph, o AS t FROM quads WHERE p = 'rdf:type' AND s_kind = 'iri' AND o_kind = 'iri' UNION SELECT graph, p FROM quads) WHERE regexp_matches(t, '^https?://')""")
def _(c):
    return M.vocabularies(c.quads)


@query("status_rollup", sql="""
    SELECT kind, status, count(*) AS graphs, CAST(sum(n) AS BIGINT) AS total FROM (SELECT regexp_extract(graph, '^(.*[/:])[^/:]*$', 1) AS kind, CASE WHEN max(CASE WHEN p = 'rdf:type' AND o = 'ont:Event' THEN 1 ELSE 0 END) = 1 THEN 'inconsistent' ELSE 'consistent' END AS status, count(*) AS n
    FROM quads GROUP BY graph) GROUP BY ROLLUP (kind, status)""")
def _(c):
    hot = F.max(F.when((F.col("p") == TYPE) & (F.col("o") == TERMS.event), 1).otherwise(0))
    per = c.quads.groupBy("graph").agg(hot.alias("e"), n("n")).select(F.regexp_extract("graph", "^(.*[/:])[^/:]*$", 1).alias("kind"), F.when(F.col("e") == 1, "inconsistent").otherwise("consistent").alias("status"), "n")
    return M.status_rollup(per, "kind", "status", "n")


@query("bounded_list", preds="a", sql="""
    WITH d AS (SELECT DISTINCT o AS cls, s FROM quads), r AS (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY s) AS k, count(*) OVER (PARTITION BY cls) AS total FROM d)
    SELECT cls, string_agg(s, ', ' ORDER BY s) FILTER (k <= 50) || CASE WHEN max(total) > 50 THEN ' ... (+' || CAST(max(total) - 50 AS VARCHAR) || ' more)' ELSE '' END AS items, max(total) AS total FROM r GROUP BY cls""")
def _(c):
    return M.bounded_list(c.quads.select(F.col("o").alias("cls"), "s"), "cls", "s")


@query("human_total", sql="""
    SELECT graph, CASE WHEN n >= 1000000 THEN printf('~%.1fM', n / 1000000) WHEN n >= 1000 THEN '~' || CAST(n // 1000 AS VARCHAR) || 'K' ELSE CAST(n AS VARCHAR) END AS shown
    FROM (SELECT graph, count(*) AS n FROM quads GROUP BY graph)""")
def _(c):
    return c.quads.groupBy("graph").agg(n("n")).select("graph", S.human_total("n").alias("shown"))


# --- statistics over the union graph ------------------------------------------------------------

@query("stat_concepts", preds="a label", sql=f"""
    SELECT DISTINCT concept, label FROM (SELECT DISTINCT o AS concept FROM quads WHERE p = 'rdf:type') LEFT JOIN (SELECT DISTINCT s AS concept, o AS label FROM quads WHERE p = 'rdfs:label' AND {EN}) USING (concept)
    ORDER BY concept, label LIMIT 999""")
def _(c):
    return Q.concepts(c.quads)


@query("stat_entities_per_concept", preds="a label", sql=f"""
    WITH {UNION_GRAPH} SELECT concept, label, n AS "count" FROM (SELECT o AS concept, count(*) AS n FROM u WHERE p = 'rdf:type' GROUP BY o)
    LEFT JOIN (SELECT DISTINCT s AS concept, o AS label FROM quads WHERE p = 'rdfs:label' AND {EN}) USING (concept) ORDER BY n DESC, concept, label LIMIT 999""")
def _(c):
    return Q.entities_per_concept(c.quads)


for key, name, sql, fn in [
    ("stat_entities", "entities", "SELECT count(DISTINCT s) AS entities FROM quads", lambda q: Q.count_distinct(q, "s", "entities")),
    ("stat_triples", "triples", f"WITH {UNION_GRAPH} SELECT count(*) AS triples FROM u", lambda q: Q.triples_where(q, F.lit(True), "triples")),
    ("stat_classes", "classes", "SELECT count(DISTINCT o) AS classes FROM quads WHERE p = 'rdf:type'", lambda q: Q.count_distinct(q, "o", "classes", F.col("p") == TYPE)),
    ("stat_properties", "properties", "SELECT count(DISTINCT p) AS properties FROM quads", lambda q: Q.count_distinct(q, "p", "properties")),
    ("stat_avg_triples", "avg", f"WITH {UNION_GRAPH} SELECT round(avg(n), 6) AS avg_triples FROM (SELECT count(*) AS n FROM u GROUP BY s)", lambda q: M.average_triples(q)),
    ("stat_literals", "literals", f"WITH {UNION_GRAPH} SELECT count(*) AS literals FROM u WHERE o_kind = 'literal'", lambda q: Q.triples_where(q, F.col("o_kind") == "literal", "literals")),
    ("stat_out_degree", "out", f"WITH {UNION_GRAPH} SELECT s, count(*) AS out_degree FROM u GROUP BY s ORDER BY 2 DESC, s LIMIT 10", lambda q: Q.out_degree(q)),
    ("stat_untyped", "no_type", "SELECT count(DISTINCT s) AS no_type FROM quads WHERE s NOT IN (SELECT s FROM quads WHERE p = 'rdf:type')", lambda q: Q.subjects_without(q, TYPE, "no_type")),
    ("stat_unlabeled", "no_label", "SELECT count(DISTINCT s) AS no_label FROM quads WHERE s NOT IN (SELECT s FROM quads WHERE p = 'rdfs:label')", lambda q: Q.subjects_without(q, expand_label(), "no_label")),
    ("stat_blank_nodes", "n", f"WITH {UNION_GRAPH} SELECT count(*) AS blank FROM u WHERE s_kind = 'bnode' OR o_kind = 'bnode'", lambda q: Q.triples_where(q, (F.col("s_kind") == "bnode") | (F.col("o_kind") == "bnode"), "blank")),
    ("stat_languages", "n", f"WITH {UNION_GRAPH} SELECT o_lang AS lang, count(*) AS \"count\" FROM u WHERE o_kind = 'literal' AND o_lang <> '' GROUP BY 1", lambda q: Q.languages(q)),
    ("stat_datatypes", "n", f"WITH {UNION_GRAPH} SELECT CASE WHEN o_lang <> '' THEN 'rdf:langString' ELSE coalesce(o_datatype, 'xsd:string') END AS datatype, count(*) AS \"count\" FROM u WHERE o_kind = 'literal' GROUP BY 1", lambda q: Q.datatypes(q)),
    ("stat_unused_classes", "n", "SELECT DISTINCT c AS class, label FROM (SELECT DISTINCT s AS c FROM quads WHERE p = 'rdf:type' AND o = 'owl:Class') LEFT JOIN (SELECT s AS c, o AS label FROM quads WHERE p = 'rdfs:label') USING (c) WHERE c NOT IN (SELECT o FROM quads WHERE p = 'rdf:type')", lambda q: Q.unused_classes(q)),
    ("stat_external", "n", f"SELECT count(DISTINCT o) AS external_links FROM quads WHERE {NODE} AND regexp_matches(o, '^https?://') AND NOT starts_with(o, '{BASE}')", lambda q: Q.external_links(q, BASE)),
    ("stat_same_as", "n", f"WITH {UNION_GRAPH} SELECT count(*) AS same_as FROM u WHERE p = 'owl:sameAs'", lambda q: Q.triples_where(q, F.col("p") == "http://www.w3.org/2002/07/owl#sameAs", "same_as")),
]:
    query(key, sql=sql, preds={"stat_classes": "a", "stat_same_as": "owl:sameAs", "stat_unused_classes": "a label"}.get(key, ""))(lambda c, key=key, fn=fn: fn(c.repeated if key == "stat_avg_triples" else c.quads))


def expand_label():
    return "http://www.w3.org/2000/01/rdf-schema#label"


@query("stat_top_properties", sql=f"""
    WITH {UNION_GRAPH} SELECT property, label, n AS "count" FROM (SELECT p AS property, count(*) AS n FROM u GROUP BY p) LEFT JOIN (SELECT DISTINCT s AS property, o AS label FROM quads WHERE p = 'rdfs:label' AND {EN}) USING (property)
    ORDER BY n DESC, property, label LIMIT 10""")
def _(c):
    return Q.top_properties(c.quads)


# --- named graphs ------------------------------------------------------------------------------------

@query("ng_list", sql="SELECT DISTINCT graph FROM quads ORDER BY graph")
def _(c):
    return c.quads.select("graph").distinct().orderBy("graph")


@query("ng_triples", sql="SELECT graph, count(*) AS triples FROM quads GROUP BY graph ORDER BY 2 DESC, 1")
def _(c):
    return P.order_limit(c.quads.groupBy("graph").agg(n("triples")), None, "-triples", "graph")


@query("ng_spo", sql=f"SELECT graph, count(DISTINCT s) AS subjects, count(DISTINCT p) AS predicates, count(DISTINCT {TERM}) AS objects FROM quads GROUP BY graph")
def _(c):
    return M.rdf_stats(c.quads).select("graph", "subjects", "predicates", "objects")


def ng(key, preds, sql, fn):
    query(key, graphs="meta", preds=preds, sql=sql)(lambda c: fn(c.quads))


FILE = f"{ty('ont:File', 'file_graph')} JOIN {v('ont:partOf', 'file_graph', 'record')} USING (file_graph)"
ng("ng_description", "a ont:denotedBy ont:hasValue", f"""
    SELECT DISTINCT graph, description FROM {ty('ont:Dataset', 'graph')} JOIN {e('ont:denotedBy', 'graph', 'd')} USING (graph) JOIN {ty('ont:Description', 'd')} USING (d) JOIN {v('ont:hasValue', 'd', 'description')} USING (d)""",
   lambda q: Q.graph_descriptions(q, TERMS.data_collection))
ng("ng_times", "a ont:outputOf ont:occupies ont:firstInstant ont:lastInstant ont:timestamp", f"""
    SELECT DISTINCT graph, "begin", "end" FROM {ty('ont:Dataset', 'graph')} JOIN {e('ont:outputOf', 'graph', 'pr')} USING (graph) JOIN {e('ont:occupies', 'pr', 'r')} USING (pr)
    JOIN {e('ont:firstInstant', 'r', 'b')} USING (r) JOIN {e('ont:lastInstant', 'r', 'l')} USING (r) JOIN {v('ont:timestamp', 'b', '"begin"')} USING (b) JOIN {v('ont:timestamp', 'l', '"end"')} USING (l)""",
   lambda q: Q.graph_times(q, TERMS.data_collection))
ng("ng_files", "a label ont:partOf", f"SELECT DISTINCT file_graph, label, record FROM {FILE} LEFT JOIN {v('rdfs:label', 'file_graph', 'label')} USING (file_graph) ORDER BY record, file_graph, label LIMIT 999", lambda q: Q.file_graphs(q))
ng("ng_files_per_record", "a ont:partOf", f"SELECT record, count(DISTINCT file_graph) AS files FROM {FILE} GROUP BY record ORDER BY 2 DESC, 1 LIMIT 999", lambda q: Q.files_per_record(q))
ng("ng_downloads", "a ont:partOf ont:hasUrl", f"SELECT DISTINCT record, file_graph, url FROM {FILE} JOIN {v('ont:hasUrl', 'file_graph', 'url')} USING (file_graph) ORDER BY record, file_graph, url LIMIT 999", lambda q: Q.file_downloads(q))
ng("ng_file_descriptions", "a label ont:partOf ont:denotedBy ont:hasValue", f"""
    SELECT DISTINCT record, file_graph, label, description FROM {FILE} JOIN {e('ont:denotedBy', 'file_graph', 'd')} USING (file_graph) JOIN {ty('ont:Description', 'd')} USING (d)
    JOIN (SELECT s AS d FROM quads WHERE p = 'rdfs:label' AND o = 'description') USING (d) JOIN {v('ont:hasValue', 'd', 'description')} USING (d) LEFT JOIN {v('rdfs:label', 'file_graph', 'label')} USING (file_graph)
    ORDER BY record, file_graph, label, description LIMIT 999""", lambda q: Q.file_descriptions(q))
ng("ng_harvest_times", "a ont:outputOf ont:occupies ont:firstInstant ont:timestamp", f"""
    SELECT DISTINCT file_graph, harvested_at FROM {ty('ont:File', 'file_graph')} JOIN {e('ont:outputOf', 'file_graph', 'pr')} USING (file_graph) JOIN {e('ont:occupies', 'pr', 'r')} USING (pr)
    JOIN {e('ont:firstInstant', 'r', 'b')} USING (r) JOIN {v('ont:timestamp', 'b', 'harvested_at')} USING (b) ORDER BY harvested_at DESC, file_graph LIMIT 999""", lambda q: Q.harvest_times(q))
ng("ng_registered_from", "stat:registeredFrom stat:version", f"SELECT DISTINCT file_graph, url, version FROM {v('stat:registeredFrom', 'file_graph', 'url')} LEFT JOIN {v('stat:version', 'file_graph', 'version')} USING (file_graph)",
   lambda q: Q.registered_from(q, BASE + "stat/registeredFrom", BASE + "stat/version"))


@query("ng_file_triples", graphs="meta files", sql=f"""
    SELECT file_graph, count(*) AS triples FROM {FILE.replace("FROM quads WHERE", "FROM quads WHERE graph = 'g:meta' AND")} JOIN (SELECT graph AS file_graph FROM quads) USING (file_graph) GROUP BY file_graph ORDER BY 2 DESC, 1 LIMIT 999""")
def _(c):
    return Q.file_graph_triples(c.graph("meta", preds=("a", "ont:partOf")), c.graph("files"))


@query("ng_partitions", graphs="assets", preds="void:classPartition void:class void:entities", sql=f"""
    SELECT DISTINCT dataset, class, CAST(TRY_CAST(n AS DOUBLE) AS BIGINT) AS entities FROM {e('void:classPartition', 'dataset', 'cp')} JOIN {v('void:class', 'cp', 'class')} USING (cp) JOIN {v('void:entities', 'cp', 'n')} USING (cp)""")
def _(c):
    return Q.class_partitions(c.quads)


# --- latest views --------------------------------------------------------------------------------------
# Snapshots: one per day, graph and two keys of the event stream.

VIEWS["snap"] = ("SELECT substr(CAST(ts AS STRING), 1, 10) AS ts_utc, 'https://kg.example.org/g/' || event_type AS graph, 'k' || CAST(user_id AS STRING) AS k1, "
                 "'p' || regexp_extract(props, '[0-9]+', 0) AS k2, count(*) AS n FROM {events} GROUP BY 1, 2, 3, 4")


def _snapshot_columns(table: str) -> list[tuple[str, str]]:
    schema, key = METRIC_TABLES[table]
    keys = [k for k in (key or []) if k != "graph"]
    out = []
    for f in schema:
        if f.name in ("ts_utc", "graph"):
            out.append((f.name, f.name))
        elif f.name in keys:
            out.append((f.name, "k1" if f.name == keys[0] else "k2"))
        else:
            out.append((f.name, "n" if f.dataType.simpleString() == "bigint" else "'about ' || k1 || k2"))
    return out


def _latest(table: str) -> None:
    key, cols = METRIC_TABLES[table][1], _snapshot_columns(table)
    sel = ", ".join(f'{expr} AS "{name}"' for name, expr in cols)
    prefix = "https://kg.example.org/g/"
    src = f"(SELECT {sel} FROM snap WHERE starts_with(graph, '{prefix}'))"
    if key:
        ks = ", ".join(key)
        rest = ", ".join(f'"{name}"' for name, _ in cols if name not in key and name != "ts_utc")
        src = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {ks} ORDER BY ts_utc DESC{', ' + rest if rest else ''}) AS rn FROM {src}) WHERE rn = 1)"
    names = ", ".join(f'"{name}"' for name, _ in cols)

    @query("latest_" + table, views="snap", sql=f"SELECT {names} FROM {src}")
    def _(c):
        snap = c.view("snap").selectExpr(*[f"{expr} AS `{name}`" for name, expr in cols])
        return sinks.latest_views({table: snap}, prefix)[table]


for _t in METRIC_TABLES:
    _latest(_t)


@query("chunk_statements", graphs="catalog datasets files", sql="""
    WITH l AS (SELECT graph, CASE WHEN s_kind = 'iri' THEN '<' || s || '>' ELSE s END || ' <' || p || '> ' || CASE WHEN o_kind = 'iri' THEN '<' || o || '>' ELSE
      '"' || replace(replace(replace(replace(replace(o, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') || '"' || CASE WHEN o_lang <> '' THEN '@' || o_lang WHEN o_datatype IS NOT NULL THEN '^^<' || o_datatype || '>' ELSE '' END END
      || ' <' || graph || '> .' AS line FROM quads WHERE s_kind <> 'bnode' AND o_kind <> 'bnode'),
    r AS (SELECT graph, line, CAST(floor(coalesce(sum(strlen(line) + 1) OVER (PARTITION BY graph ORDER BY sha1(line) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 100000) AS BIGINT) AS chunk FROM l)
    SELECT graph, chunk, count(*) AS lines, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes FROM r GROUP BY graph, chunk""")
def _(c):
    out = chunk_lines(sinks.nquads_lines(c.quads), 100000, text=False)
    return out.groupBy("graph", "chunk").agg(n("lines"), F.sum("bytes").alias("bytes"))


@query("nt_term", graphs="documents events catalog", sql="""
    SELECT s, p, CASE WHEN o_kind = 'iri' THEN '<' || o || '>' WHEN o_kind = 'bnode' THEN o ELSE
      '"' || replace(replace(replace(replace(replace(o, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') || '"' || CASE WHEN o_lang <> '' THEN '@' || o_lang WHEN o_datatype IS NOT NULL THEN '^^<' || o_datatype || '>' ELSE '' END END AS term FROM quads""")
def _(c):
    return c.quads.select("s", "p", S.nt_term().alias("term"))


# --- views of a source -------------------------------------------------------------------------------------

LAB = f"(SELECT DISTINCT s AS x, o AS l FROM quads WHERE p = 'rdfs:label' AND {EN})"
NAMED = f"""n AS (SELECT c, coalesce(l, CASE WHEN contains(c, '#') THEN substr(c, instr(c, '#') + 1) ELSE '' END) AS label
    FROM (SELECT DISTINCT s AS c FROM quads WHERE p = 'rdf:type' AND o IN {CLASS_TYPES} AND s_kind = 'iri') LEFT JOIN {LAB} ON x = c)"""


@query("view_classes", graphs="ontology", preds="a label", sql=f"WITH {NAMED} SELECT c AS s, 'rdf:type' AS p, 'owl:Class' AS o FROM n UNION SELECT c, 'rdfs:label', label FROM n")
def _(c):
    return describe.view_classes(c.quads).select("s", "p", "o").distinct()


@query("view_hierarchy", graphs="ontology", preds="a label rdfs:subClassOf", sql=f"""
    WITH {NAMED}, h AS (SELECT c, label, parent, CASE WHEN parent IS NOT NULL THEN coalesce(l, CASE WHEN contains(parent, '#') THEN substr(parent, instr(parent, '#') + 1) ELSE '' END) END AS pl
      FROM n LEFT JOIN (SELECT DISTINCT s AS c, o AS parent FROM quads WHERE p = 'rdfs:subClassOf') USING (c) LEFT JOIN {LAB} ON x = parent)
    SELECT c AS s, 'rdf:type' AS p, 'owl:Class' AS o FROM h UNION SELECT c, 'rdfs:label', label FROM h UNION SELECT c, 'rdfs:subClassOf', parent FROM h WHERE parent IS NOT NULL UNION SELECT parent, 'rdfs:label', pl FROM h WHERE parent IS NOT NULL""")
def _(c):
    return describe.view_hierarchy(c.quads).select("s", "p", "o").distinct()


@query("view_tbox", graphs="ontology", sql=f"""
    WITH {UNION_GRAPH}, k AS (SELECT s, o AS kind FROM u WHERE p = 'rdf:type')
    SELECT 'all' AS mode, s, p, o, o_lang FROM u WHERE s IN (SELECT s FROM k WHERE kind IN ('owl:Class', 'rdfs:Class', 'owl:ObjectProperty', 'rdf:Property', 'owl:DatatypeProperty'))
    UNION ALL SELECT DISTINCT 'local', s, p, o, o_lang FROM u WHERE
      (p IN ('rdfs:label', 'rdf:type', 'rdfs:subClassOf', 'owl:equivalentClass', 'owl:disjointWith') AND s IN (SELECT s FROM k WHERE kind = 'owl:Class'))
      OR (p IN ('rdfs:label', 'rdf:type', 'rdfs:domain', 'rdfs:range', 'owl:inverseOf', 'owl:equivalentProperty', 'owl:propertyDisjointWith') AND s IN (SELECT s FROM k WHERE kind = 'owl:ObjectProperty'))
      OR (p IN ('rdfs:label', 'rdf:type', 'rdfs:domain', 'rdfs:range', 'owl:equivalentProperty', 'owl:propertyDisjointWith') AND s IN (SELECT s FROM k WHERE kind = 'owl:DatatypeProperty'))""")
def _(c):
    cols = ["s", "p", "o", "o_lang"]
    a = describe.view_schema(c.quads).select(F.lit("all").alias("mode"), *cols)
    return a.unionByName(describe.view_schema(c.quads, "local").select(F.lit("local").alias("mode"), *cols))
