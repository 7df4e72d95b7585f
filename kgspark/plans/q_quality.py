"""Registered queries: shapes, verification queries, gates."""


from pyspark.sql import functions as F

from kgspark.model import BASE, ONT, TERMS, TRIPLE_COLS
from kgspark.operators import shapes as H, verify as V
from kgspark.plans.registry import QUERIES, query
from kgspark.plans.sqltext import NODE, TERM, TRIPLE
from kgspark.session import materialize
from kgspark.sources import sinks

SUB = f"""sub AS (SELECT s AS a, o AS b FROM quads WHERE p = 'rdfs:subClassOf' AND {NODE} AND s <> o UNION SELECT sub.a, q.o FROM sub JOIN quads q ON q.s = sub.b AND q.p = 'rdfs:subClassOf')"""
U = f"u AS (SELECT DISTINCT {TRIPLE} FROM quads)"


def members(classes, var="focus", deep=True):
    ins = ", ".join(f"'{c}'" for c in ([classes] if isinstance(classes, str) else classes))
    below = f" OR o IN (SELECT a FROM sub WHERE b IN ({ins}))" if deep else ""
    return f"(SELECT DISTINCT s AS {var} FROM u WHERE p = 'rdf:type' AND (o IN ({ins}){below}))"


def card(target, path, lo, hi, shape, msg):
    bad = f"n < {lo}" + (f" OR n > {hi}" if hi is not None else "")
    return f"""SELECT '{shape}' AS shape, focus, '{path}' AS path, CAST(n AS VARCHAR) AS value, '{msg}' AS message FROM (SELECT focus, coalesce(n, 0) AS n FROM {target}
      LEFT JOIN (SELECT s AS focus, count(DISTINCT {TERM}) AS n FROM u WHERE p = '{path}' GROUP BY s) USING (focus)) WHERE {bad}"""


def not_iri(target, path, shape, msg):
    return f"SELECT '{shape}', s, '{path}', o, '{msg}' FROM u WHERE p = '{path}' AND o_kind <> 'iri' AND s IN (SELECT focus FROM {target})"


def values_in(target, path, classes, shape, msg):
    return f"""SELECT DISTINCT '{shape}', s, '{path}', o, '{msg}' FROM u WHERE p = '{path}' AND s IN (SELECT focus FROM {target}) AND ({NODE.replace('<>', '=')} OR o NOT IN (SELECT v FROM {members(classes, 'v')}))"""


def qmin(target, path, classes, also, shape, msg):
    return f"""SELECT '{shape}', focus, '{path}', CAST(q AS VARCHAR), '{msg}' FROM (SELECT focus, coalesce(q, 0) AS q FROM {target} LEFT JOIN (SELECT s AS focus, count(DISTINCT o) AS q FROM u
      WHERE p = '{path}' AND {NODE} AND o IN (SELECT v FROM {members(classes, 'v')}) AND o IN ({also}) GROUP BY s) USING (focus)) WHERE q < 1"""


TEXT = members("ont:TextualEntity")
ROLE = members("ont:Role")
SHAPES = {
    "textual_entity": card(TEXT, "ont:isAbout", 1, None, "textual_entity", "a textual entity must be about something"),
    "no_punning": card(members("owl:NamedIndividual", deep=False), "rdfs:subClassOf", 0, 0, "no_punning", "a named individual cannot be a subclass of something"),
    "role_bearer": card(ROLE, "ont:roleOf", 1, None, "role_bearer", "a role must be the role of something") + " UNION "
    + card(ROLE, "ont:realizedIn", 1, None, "role_bearer", "a role must be realized in some process"),
    "role_realized": card(ROLE, "ont:realizedIn", 1, None, "role_realized", "a role must be realized in something"),
    "ontology_variant": card(members("ont:OntologyVariant"), "ont:partOf", 1, None, "ontology_variant", "an ontology variant must be part of an ontology") + " UNION "
    + values_in(members("ont:OntologyVariant"), "ont:partOf", "ont:Ontology", "ontology_variant", "an ontology variant must be part of an ontology"),
    "ontology_version": f"""SELECT 'ontology_version' AS shape, focus, 'ont:isSubjectOf' AS path, CAST(n AS VARCHAR) AS value, 'an ontology version must be subject of a version number or IRI' AS message FROM (
      SELECT focus, coalesce(n, 0) AS n, coalesce(q1, 0) AS q1, coalesce(q2, 0) AS q2 FROM {members('ont:OntologyVersion')} LEFT JOIN (SELECT s AS focus, count(DISTINCT {TERM}) AS n,
        count(DISTINCT CASE WHEN o IN (SELECT v FROM {members(['ont:VersionNumber', 'ont:VersionIri', 'ont:Website'], 'v', False)}) THEN o END) AS q1,
        count(DISTINCT CASE WHEN o IN (SELECT v FROM {members(['ont:VersionNumber', 'ont:VersionIri', 'ont:Website', 'ont:File', 'ont:Repository'], 'v', False)}) THEN o END) AS q2
        FROM u WHERE p = 'ont:isSubjectOf' GROUP BY s) USING (focus)) WHERE NOT ((n <= 1 AND q1 >= 1) OR (n >= 2 AND q2 >= 1))""",
    "has_value": card(TEXT, "ont:hasValue", 1, None, "has_value", "an e-mail address or textual entity must have a value"),
    "has_url": card(members("ont:Website"), "ont:hasUrl", 1, None, "has_url", "a URL instance must have a url"),
}
VD = members("void:Dataset", deep=False)
M1, M2, M3 = ("a published graph must carry a label", "a published graph must be denoted by a textual description with a value", "a published graph must be the output of exactly one load process")
LP = f"(SELECT DISTINCT o AS focus FROM u WHERE p = 'ont:outputOf' AND {NODE})"
L1, L2 = "a load process must record a participant", "a load process must occupy exactly one region with first and last instant"
IM = "an instant must record its time as one dateTimeStamp"
STAMP = r"^-?\d{4,}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
DOC = {
    "graph_metadata": " UNION ".join([
        card(VD, "rdfs:label", 1, None, "graph_metadata", M1), card(VD, "ont:denotedBy", 1, None, "graph_metadata", M2), not_iri(VD, "ont:denotedBy", "graph_metadata", M2),
        qmin(VD, "ont:denotedBy", "ont:Description", "SELECT s FROM u WHERE p = 'ont:hasValue' AND length(o) >= 1", "graph_metadata", M2),
        card(VD, "ont:outputOf", 1, 1, "graph_metadata", M3), not_iri(VD, "ont:outputOf", "graph_metadata", M3), values_in(VD, "ont:outputOf", "ont:Process", "graph_metadata", M3)]),
    "load_process": " UNION ".join([
        card(LP, "ont:hasParticipant", 1, None, "load_process", L1), not_iri(LP, "ont:hasParticipant", "load_process", L1), card(LP, "ont:occupies", 1, 1, "load_process", L2), not_iri(LP, "ont:occupies", "load_process", L2),
        qmin(LP, "ont:occupies", "ont:Region1D", "SELECT s FROM u WHERE p = 'ont:firstInstant' AND s IN (SELECT s FROM u WHERE p = 'ont:lastInstant')", "load_process", L2)]),
    "instant": card(members("ont:Instant"), "ont:timestamp", 1, 1, "instant", IM) + f""" UNION SELECT 'instant', s, 'ont:timestamp', o, '{IM}' FROM u WHERE p = 'ont:timestamp' AND s IN (SELECT focus FROM {members('ont:Instant')})
        AND NOT (coalesce(o_datatype, '') = 'xsd:dateTimeStamp' AND regexp_matches(o, '{STAMP}'))""",
    "no_deprecated": f"SELECT 'no_deprecated' AS shape, s AS focus, 'rdf:type' AS path, o AS value, 'deprecated class on a published graph' AS message FROM u WHERE p = 'rdf:type' AND o = 'ont:Dataset' AND s IN (SELECT focus FROM {VD})",
}


def shape(key, graphs, name, fn):
    sql = {**SHAPES, **DOC}[name]
    query(key, graphs=graphs, sql=f"WITH {SUB}, {U} {sql}")(lambda c: _run(c, fn))


def _run(c, fn):
    return fn(c.repeated, c.repeated)


for _key, _name in [
    ("shape_textual_entity", "textual_entity"), ("shape_no_punning", "no_punning"), ("shape_role_bearer", "role_bearer"), ("shape_role_realized", "role_realized"), ("shape_variant", "ontology_variant"),
    ("shape_version", "ontology_version"), ("shape_has_value", "has_value"), ("shape_has_url", "has_url"), ("shape_graph_metadata", "graph_metadata"), ("shape_load_process", "load_process"),
    ("shape_instant", "instant"), ("shape_no_deprecated", "no_deprecated"),
]:
    shape(_key, "", _name, {**H.EXECUTED, **H.DOCUMENTED}[_name])


@query("shape_targets", preds="a rdfs:subClassOf", sql=f"WITH {SUB}, {U} SELECT focus FROM {members('ont:Continuant')}")
def _(c):
    return H.targets(c.quads, ONT + "Continuant", c.quads)


@query("shape_targets_obj", preds="ont:occupies", sql="SELECT DISTINCT o AS focus FROM quads WHERE p = 'ont:occupies'")
def _(c):
    return H.targets_of_object(c.quads, TERMS.occupies)


@query("shape_cardinality", preds="a rdfs:subClassOf ont:hasInput ont:occupies", sql=f"""
    WITH {SUB}, {U} {card(members('ont:Occurrent'), 'ont:hasInput', 1, 1, 'one_input', 'exactly one input')}""")
def _(c):
    t = c.repeated
    return H.cardinality(t, materialize(H.targets(t, ONT + "Occurrent", t), "focus"), TERMS.has_input, "one_input", "exactly one input", 1, 1)


@query("shape_report", sql=f"WITH {SUB}, {U}, v AS ("
       + " UNION ALL ".join(f"SELECT shape FROM ({s})" for s in SHAPES.values()) + ") SELECT n.shape, count(v.shape) AS violations, count(v.shape) = 0 AS conforms FROM (SELECT unnest(["
       + ", ".join(f"'{k}'" for k in SHAPES) + "]) AS shape) n LEFT JOIN v ON v.shape = n.shape GROUP BY n.shape")
def _(c):
    t = c.repeated
    return H.shape_report(H.run_shapes(t, schema=t))


# --- verification -----------------------------------------------------------------------------------

ORCID = r"^https://orcid\.example\.org/\d+$"
VERIFY = {
    "verify_orcid": ("", rf"SELECT s, p, o FROM quads WHERE starts_with(s, '{BASE}') AND o_kind = 'literal' AND regexp_matches(o, '{ORCID}')"),
    "verify_predicates": ("", """SELECT DISTINCT p FROM quads WHERE starts_with(p, 'ont:') AND p NOT IN ('ont:partOf', 'ont:hasPart')
        AND p NOT IN (SELECT s FROM quads WHERE graph = 'g:approved' AND p = 'rdf:type' AND o = 'owl:ObjectProperty')"""),
    "verify_classes": ("", """WITH l AS (SELECT DISTINCT s AS c, o AS ctype FROM quads WHERE graph <> 'g:approved' AND p = 'rdf:type' AND o IN ('owl:Class', 'rdfs:Class')),
        a AS (SELECT * FROM quads WHERE graph = 'g:approved')
        SELECT DISTINCT q.s, q.o AS c FROM quads q JOIN l ON l.c = q.o WHERE q.graph <> 'g:approved' AND q.p = 'rdf:type' AND q.o_kind = 'iri' AND NOT starts_with(q.o, 'owl:')
        AND NOT EXISTS (SELECT 1 FROM a WHERE a.s = l.c AND ((a.p = 'rdf:type' AND a.o = l.ctype) OR (a.p = 'owl:deprecated' AND a.o = 'true') OR (a.p = 'rdf:type' AND a.o = 'owl:DeprecatedClass')))"""),
    "verify_properties": ("", """SELECT DISTINCT d.s AS p, d.o AS ptype FROM quads d JOIN quads q ON q.p = d.s AND q.graph <> 'g:approved' WHERE d.graph <> 'g:approved' AND d.p = 'rdf:type'
        AND d.o IN ('owl:DatatypeProperty', 'owl:ObjectProperty') AND NOT EXISTS (SELECT 1 FROM quads a WHERE a.graph = 'g:approved' AND a.s = d.s AND a.p = 'rdf:type' AND a.o = d.o)"""),
    "verify_disjoint": ("", """SELECT DISTINCT x.s AS x, d.s AS c, d.o AS d FROM quads d JOIN quads x ON x.p = 'rdf:type' AND x.o = d.s JOIN quads y ON y.p = 'rdf:type' AND y.s = x.s AND y.o = d.o WHERE d.p = 'owl:disjointWith'"""),
}


def _split(c, repeats=False):
    q = c.repeated if repeats else c.quads
    return q.where(F.col("graph") != BASE + "g/approved"), q.where(F.col("graph") == BASE + "g/approved")


CHECKS = {
    "verify_orcid": lambda c: V.orcid_literals(c.quads, BASE, ORCID),
    "verify_predicates": lambda c: V.undeclared_predicates(c.quads, ONT, [TERMS.part_of, TERMS.has_part], _split(c)[1]),
    "verify_classes": lambda c: V.unapproved_classes(*_split(c, repeats=True)),
    "verify_properties": lambda c: V.unapproved_properties(*_split(c)),
    "verify_disjoint": lambda c: V.disjoint_members(c.quads),
}
for _key, (_graphs, _sql) in VERIFY.items():
    query(_key, graphs=_graphs, sql=_sql)(CHECKS[_key])


def _only(key):
    return f"SELECT '{key}' AS name, count(*) AS rows, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({VERIFY[key][1]})"


@query("verify_report", sql=" UNION ALL ".join(_only(k) for k in VERIFY))
def _(c):
    return V.gate_report({k: QUERIES[k](c.spark, c.t.dir) for k in CHECKS})


def _serialisation() -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{k}'" for k, p in V.SERIALISATIONS.items()) + " ELSE 'unknown' END"


@query("output_gates", sql=f"""
    WITH l AS (SELECT CASE WHEN s_kind = 'iri' THEN '<' || s || '>' ELSE s END || ' <' || p || '> ' || CASE WHEN o_kind = 'iri' THEN '<' || o || '>' ELSE
      '"' || replace(replace(replace(replace(replace(o, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') || '"' || CASE WHEN o_lang <> '' THEN '@' || o_lang WHEN o_datatype IS NOT NULL THEN '^^<' || o_datatype || '>' ELSE '' END END
      || ' <' || graph || '> .' AS line FROM quads WHERE s_kind <> 'bnode' AND o_kind <> 'bnode'),
    f AS (SELECT 'page/' || CAST(page_id AS VARCHAR) AS path, html AS text FROM pages UNION ALL SELECT 'line/' || sha1(line), line FROM l),
    g AS (SELECT path, length(trim(text)) > 0 AS non_empty, regexp_matches(text, '{V.HTML}') AS is_html, {_serialisation()} AS serialisation FROM f)
    SELECT *, non_empty AND NOT is_html AS ok FROM g""", graphs="documents")
def _(c):
    files = c.t("pages").select(F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("path"), F.col("html").alias("text"))
    lines = sinks.nquads_lines(c.graph("documents")).select(F.concat(F.lit("line/"), F.sha1("line")).alias("path"), F.col("line").alias("text"))
    return V.output_gates(files.unionByName(lines))
