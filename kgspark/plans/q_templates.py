"""Registered queries: templates, catalogue normalisation, intake, scalar functions."""

from pyspark.sql import functions as F

from kgspark.functions import scalars as S, text as X
from kgspark.model import BASE, LABEL, ONT, TERMS, TYPE
from kgspark.operators import catalog as K, pattern as P, template as T
from kgspark.operators.ordinal import with_ordinal
from kgspark.plans.registry import ORACLES, VIEWS, query
from kgspark.plans.sqltext import e, uuid5, v
from kgspark.sources import scan, sinks

# --- template tabs: one tab per product type, one row per part -------------------------------------

CELLS = [f"c{i}" for i in range(8)]
DIRECTIVES = ["ID", "TYPE", f"A {LABEL}", f"A {ONT}alt SPLIT=;", f"AT {ONT}size^^xsd:integer", f"AI {ONT}homepage", f"I {ONT}related SPLIT=|", f"I {ONT}maker"]
HEADERS = ["id", "type", "name", "aliases", "size", "homepage", "related", "maker"]


def _head(line: int, cells: list[str]) -> str:
    return f"SELECT DISTINCT 'tab_' || p_type AS tab, p_type AS tab_order, CAST({line} AS BIGINT) AS line_no, " + ", ".join(f"'{x}' AS c{i}" for i, x in enumerate(cells)) + " FROM {part}"


VIEWS["sheet"] = (_head(1, HEADERS) + " UNION ALL " + _head(2, DIRECTIVES) + f"""
    UNION ALL SELECT 'tab_' || p_type, p_type, p_partkey + 3, CASE WHEN p_size = 2 THEN '  ' ELSE '{BASE}item/' || CAST(p_partkey AS STRING) END,
    CASE WHEN p_size = 3 THEN 'not an iri' ELSE '{ONT}' || replace(p_brand, '#', '_') END, CASE WHEN p_size = 4 THEN '' ELSE 'Part ' || CAST(p_partkey AS STRING) END,
    p_name || '; ' || p_brand || CASE WHEN p_size % 5 = 0 THEN ' ;; x' ELSE '' END, CAST(p_size AS STRING), 'https://items.example.org/' || CAST(p_partkey AS STRING),
    'PART ' || CAST(p_partkey + 1 AS STRING) || ' | part ' || CAST(CAST(floor(p_partkey / 3) AS BIGINT) AS STRING) || CASE WHEN p_size % 7 = 0 THEN '|missing thing' ELSE '' END,
    CASE WHEN p_size % 2 = 0 THEN 'part ' || CAST(p_size AS STRING) END FROM {{part}}""".replace("{{", "{").replace("}}", "}"))


def _tabs(c):
    sheet = c.view("sheet").select("tab", "tab_order", "line_no", F.array(*CELLS).alias("cells"))
    return scan.tabs_from_rows(sheet)


DATA = "d AS (SELECT *, trim(c0) AS id FROM sheet WHERE line_no >= 3 AND trim(coalesce(c0, '')) <> '')"
INDEX = "ix AS (SELECT lower(trim(c2)) AS key, arg_min(id, (tab_order, line_no, id)) AS iri FROM d WHERE trim(coalesce(c2, '')) <> '' GROUP BY 1)"
REFS = f"""refs AS (SELECT tab, tab_order, line_no, id, header, prop, trim(x) AS value FROM (SELECT tab, tab_order, line_no, id, 'related' AS header, '{ONT}related' AS prop, unnest(string_split(c6, '|')) AS x FROM d WHERE trim(coalesce(c6, '')) <> ''
    UNION ALL SELECT tab, tab_order, line_no, id, 'maker', '{ONT}maker', unnest(string_split(c7, '|')) FROM d WHERE trim(coalesce(c7, '')) <> '') WHERE trim(x) <> ''),
    res AS (SELECT refs.*, ix.iri FROM refs LEFT JOIN ix ON ix.key = lower(value))"""


@query("scan_template", views="sheet", sql=f"WITH {DATA} SELECT tab, line_no AS row, id, c2 AS name FROM d")
def _(c):
    data, _d = _tabs(c)
    return data.select("tab", "row", F.trim(F.col("cells")[0]).alias("id"), F.col("cells")[2].alias("name"))


@query("resolve_labels", views="sheet", sql=f"WITH {DATA}, {INDEX}, {REFS} SELECT tab, line_no AS row, header, value, iri FROM res")
def _(c):
    data, dirs = _tabs(c)
    cells = T.cells(data, dirs)
    return T.resolve(T.split_cells(cells.where("kind = 'I'"), "|"), T.label_index(cells)).select("tab", "row", "header", "value", "iri")


TRIPLES = f"""tr AS (SELECT DISTINCT s, p, o, o_kind, o_datatype FROM (
    SELECT id AS s, 'rdf:type' AS p, trim(c1) AS o, 'iri' AS o_kind, NULL::VARCHAR AS o_datatype FROM d WHERE regexp_matches(c1, '^https?://')
    UNION ALL SELECT id, 'rdfs:label', c2, 'literal', NULL FROM d WHERE trim(coalesce(c2, '')) <> ''
    UNION ALL SELECT id, '{ONT}alt', trim(x), 'literal', NULL FROM (SELECT id, unnest(string_split(c3, ';')) AS x FROM d) WHERE trim(x) <> ''
    UNION ALL SELECT id, '{ONT}size', c4, 'literal', 'xsd:integer' FROM d UNION ALL SELECT id, '{ONT}homepage', c5, 'iri', NULL FROM d
    UNION ALL SELECT id, prop, iri, 'iri', NULL FROM res WHERE iri IS NOT NULL))"""


@query("template_to_triples", views="sheet", sql=f"WITH {DATA}, {INDEX}, {REFS}, {TRIPLES} SELECT s, p, o, o_kind, o_datatype FROM tr UNION ALL SELECT id, 'unresolved', value, header, NULL FROM res WHERE iri IS NULL")
def _(c):
    quads, missing = T.template_to_triples(*_tabs(c), BASE + "g/sheet")
    null = F.lit(None).cast("string")
    return quads.select("s", "p", "o", "o_kind", "o_datatype").unionByName(
        missing.select(F.col("id").alias("s"), F.lit("unresolved").alias("p"), F.col("value").alias("o"), F.col("header").alias("o_kind"), null.alias("o_datatype")))


# A tab of class axioms: superclasses, a restriction with the cell as filler, and a range.
SOME = f"C <{ONT}madeOf> some % SPLIT=|"
AXIOM_DIRECTIVES = ["ID", "TYPE", f"A {LABEL}", "C %", SOME, "RANGE"]


def _axiom_head(line: int, cells: list[str]) -> str:
    return f"SELECT DISTINCT 'axioms_' || p_brand AS tab, p_brand AS tab_order, CAST({line} AS BIGINT) AS line_no, " + ", ".join(f"'{x}' AS c{i}" for i, x in enumerate(cells)) + " FROM {part}"


VIEWS["axiom_sheet"] = (_axiom_head(1, ["id", "type", "name", "kinds", "made of", "range"]) + " UNION ALL " + _axiom_head(2, AXIOM_DIRECTIVES) + f"""
    UNION ALL SELECT 'axioms_' || p_brand, p_brand, p_partkey + 3, '{BASE}class/' || CAST(p_partkey AS STRING), '{ONT}Class', 'Class ' || CAST(p_partkey AS STRING),
    CASE WHEN p_size % 3 = 0 THEN ' CLASS ' || CAST(p_size AS STRING) WHEN p_size % 3 = 1 THEN '{ONT}Thing' END,
    'class ' || CAST(p_partkey + 1 AS STRING) || ' | class ' || CAST(CAST(floor(p_partkey / 5) AS BIGINT) AS STRING), CASE WHEN p_size < 9 THEN 'Class 7|nothing' END FROM {{part}}""".replace("{{", "{").replace("}}", "}"))
_NODE_LABEL = f"'_:' || substr(sha1(id || '|' || '{SOME}' || '|' || value || '|0.0.0r'), 1, 20)"


@query("template_axioms", views="axiom_sheet", sql=f"""
    WITH d AS (SELECT *, trim(c0) AS id FROM axiom_sheet WHERE line_no >= 3),
    ix AS (SELECT lower(trim(c2)) AS key, arg_min(id, (tab_order, line_no, id)) AS iri FROM d GROUP BY 1),
    v AS (SELECT id, header, trim(x) AS value FROM (SELECT id, 'kinds' AS header, unnest(string_split(c3, '|')) AS x FROM d UNION ALL SELECT id, 'made of', unnest(string_split(c4, '|')) FROM d
      UNION ALL SELECT id, 'range', unnest(string_split(c5, '|')) FROM d) WHERE trim(x) <> ''),
    r AS (SELECT v.*, CASE WHEN regexp_matches(value, '^https?://') THEN value ELSE iri END AS iri FROM v LEFT JOIN ix ON ix.key = lower(value)),
    m AS (SELECT id, {_NODE_LABEL} AS b, iri FROM r WHERE header = 'made of' AND iri IS NOT NULL)
    SELECT DISTINCT id AS s, 'rdfs:subClassOf' AS p, iri AS o FROM r WHERE header = 'kinds' AND iri IS NOT NULL UNION SELECT id, 'rdfs:range', iri FROM r WHERE header = 'range' AND iri IS NOT NULL
    UNION SELECT id, 'rdfs:subClassOf', b FROM m UNION SELECT b, 'rdf:type', 'owl:Restriction' FROM m UNION SELECT b, 'owl:onProperty', '{ONT}madeOf' FROM m UNION SELECT b, 'owl:someValuesFrom', iri FROM m
    UNION ALL SELECT id, 'unresolved ' || header, value FROM r WHERE iri IS NULL""")
def _(c):
    sheet = c.view("axiom_sheet").select("tab", "tab_order", "line_no", F.array(*CELLS[:6]).alias("cells"))
    quads, missing = T.template_to_triples(*scan.tabs_from_rows(sheet), BASE + "g/axioms")
    axioms = quads.where(~F.col("p").isin(LABEL) & ~((F.col("p") == TYPE) & (F.col("s_kind") == "iri")))
    return axioms.select("s", "p", "o").unionByName(missing.select(F.col("id").alias("s"), F.concat(F.lit("unresolved "), "header").alias("p"), F.col("value").alias("o")))


@query("parse_directive", views="sheet", sql="""
    WITH x AS (SELECT tab, col, any_value(h) AS header, trim(any_value(t)) AS t FROM (SELECT a.tab, u.col, u.h, w.t FROM sheet a, LATERAL (SELECT unnest(range(8)) AS col, unnest([c0, c1, c2, c3, c4, c5, c6, c7]) AS h) u
      JOIN (SELECT tab AS tb, unnest(range(8)) AS col2, unnest([c0, c1, c2, c3, c4, c5, c6, c7]) AS t FROM sheet WHERE line_no = 2) w ON w.tb = a.tab AND w.col2 = u.col WHERE a.line_no = 1) GROUP BY tab, col)
    SELECT tab, CAST(col AS INTEGER) AS col, header, split_part(t, ' ', 1) AS kind, nullif(split_part(split_part(t, ' ', 2), '^^', 1), '') AS property, nullif(split_part(split_part(t, ' ', 2), '^^', 2), '') AS datatype, CAST(NULL AS VARCHAR) AS lang, nullif(regexp_extract(t, 'SPLIT=(.+)$', 1), '') AS split FROM x""")
def _(c):
    _data, dirs = _tabs(c)
    return dirs.select("tab", "col", "header", F.inline(F.array(S.parse_directive("directive"))))


@query("template_columns", views="sheet", sql=f"""
    WITH p AS (SELECT DISTINCT tab FROM sheet), c AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{h}', '{d.split()[0]}', {repr(d.split()[1].split('^^')[0]) if ' ' in d else 'NULL'})" for i, (h, d) in enumerate(zip(HEADERS, DIRECTIVES)))}) AS t(col, header, kind, property))
    SELECT tab, CAST(col AS INTEGER) AS col, header, kind, property, CASE WHEN property = '{ONT}size' THEN 'size in units' WHEN property = '{ONT}related' THEN 'related to' END AS meaning,
      property IS NOT NULL AND property NOT IN ('{ONT}size', '{ONT}related') AS unlabeled FROM p CROSS JOIN c""")
def _(c):
    labels = c.spark.createDataFrame([(ONT + "size", "size in units"), (ONT + "related", "related to")], "iri string, meaning string")
    return T.template_columns(_tabs(c)[1], labels)


@query("example_row", views="sheet", sql=f"""
    WITH {DATA}, f AS (SELECT tab, line_no AS row, c0 AS id, len(list_filter([c0, c1, c2, c3, c4, c5, c6, c7], lambda x: trim(coalesce(x, '')) <> '')) AS filled FROM d WHERE regexp_matches(c0, '^https?://'))
    SELECT tab, row, id, CAST(filled AS INTEGER) AS filled FROM (SELECT *, row_number() OVER (PARTITION BY tab ORDER BY filled DESC, row) AS r FROM f) WHERE r = 1""")
def _(c):
    return T.example_rows(_tabs(c)[0])


@query("value_type_owner", views="sheet", sql=f"""
    WITH {DATA}, {INDEX}, {REFS}, n AS (SELECT trim(d.c1) AS value_type, res.tab, res.tab_order, count(*) AS refs FROM res JOIN d ON d.id = res.iri WHERE trim(coalesce(d.c1, '')) <> '' GROUP BY ALL)
    SELECT value_type, tab, refs FROM (SELECT *, row_number() OVER (PARTITION BY value_type ORDER BY refs DESC, tab_order) AS r FROM n) WHERE r = 1""")
def _(c):
    data, dirs = _tabs(c)
    cells = T.cells(data, dirs)
    refs = T.resolve(T.split_cells(cells.where("kind = 'I'"), "|"), T.label_index(cells))
    return T.value_type_owners(cells, refs)


@query("related_patterns", views="sheet", sql=f"WITH {DATA}, {INDEX}, {REFS} SELECT DISTINCT res.tab, d.tab AS related FROM res JOIN d ON d.id = res.iri WHERE res.tab <> d.tab")
def _(c):
    data, dirs = _tabs(c)
    cells = T.cells(data, dirs)
    refs = T.resolve(T.split_cells(cells.where("kind = 'I'"), "|"), T.label_index(cells))
    return T.related_tabs(cells, refs)


@query("pattern_unit_test", views="sheet", sql=f"""
    WITH {DATA} SELECT tab, 'entity_label' AS form, count(DISTINCT id) FILTER (trim(coalesce(c2, '')) <> '') AS matches, count(DISTINCT id) FILTER (trim(coalesce(c2, '')) <> '') > 0 AS ok FROM d GROUP BY tab""")
def _(c):
    data, dirs = _tabs(c)
    quads, _missing = T.template_to_triples(data, dirs, BASE + "g/sheet")
    return T.pattern_unit_test(T.cells(data, dirs), quads, TERMS.denoted_by)


# --- intake -------------------------------------------------------------------------------------------

VIEWS["intake"] = """SELECT c_custkey AS row_id, CASE WHEN c_nationkey = 4 THEN '' WHEN c_nationkey = 5 THEN '# note' ELSE c_name END AS label,
    'supplier#' || lpad(CAST(c_custkey % 120 AS STRING), 9, '0') || ' | Supplier#' || lpad(CAST(c_nationkey AS STRING), 9, '0') AS creators,
    CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS license, CASE WHEN c_acctbal > 0 THEN 'https://data.example.org/' || CAST(c_custkey AS STRING) END AS link FROM {customer}"""
VIEWS["people_index"] = f"SELECT lower(s_name) AS key, '{BASE}org/' || CAST(s_suppkey AS STRING) AS iri FROM {{supplier}}"
GUARD = "g AS (SELECT * FROM intake WHERE trim(label) <> '' AND NOT starts_with(trim(label), '#') AND row_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'))"


def _intake(c):
    done = c.t("orders").where("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'").select(F.col("o_custkey").alias("row_id"))
    return T.intake_guards(c.view("intake"), done)


@query("row_guards", views="intake", sql=f"WITH {GUARD} SELECT row_id, label FROM g")
def _(c):
    return _intake(c).select("row_id", "label")


MUST = f"""{GUARD}, r AS (SELECT row_id, trim(x) AS value FROM (SELECT row_id, unnest(string_split(creators, '|')) AS x FROM g) WHERE trim(x) <> ''),
    m AS (SELECT row_id, bool_and(iri IS NOT NULL) AS promoted, coalesce(string_agg(DISTINCT value, ', ' ORDER BY value) FILTER (iri IS NULL), '') AS missing FROM r LEFT JOIN people_index ON key = lower(value) GROUP BY row_id)"""


@query("must_resolve", views="intake people_index", sql=f"WITH {MUST} SELECT * FROM m")
def _(c):
    return T.must_resolve(_intake(c), ["creators"], c.view("people_index"))


VALUE_CLASSES = {"license": (ONT + "License", "licence of %s"), "link": (ONT + "Website", "link of %s")}


@query("promote_rows", views="intake people_index", sql=f"""
    WITH {MUST}, n AS (SELECT g.*, row_number() OVER (ORDER BY row_id) AS k FROM g JOIN m USING (row_id) WHERE promoted)
    SELECT row_id, 'entity' AS part, '{BASE}' || CAST(1700000000000 + k * 3 AS VARCHAR) AS id, NULL AS cls, label, label AS value FROM n
    UNION ALL SELECT row_id, 'license', '{BASE}' || CAST(1700000000000 + k * 3 + 1 AS VARCHAR), '{ONT}License', 'licence of ' || label, license FROM n WHERE trim(coalesce(license, '')) <> ''
    UNION ALL SELECT row_id, 'link', '{BASE}' || CAST(1700000000000 + k * 3 + 2 AS VARCHAR), '{ONT}Website', 'link of ' || label, link FROM n WHERE trim(coalesce(link, '')) <> ''""")
def _(c):
    rows = _intake(c)
    ok = T.must_resolve(rows, ["creators"], c.view("people_index")).where("promoted").select("row_id")
    numbered = with_ordinal(rows.join(ok, "row_id", "left_semi"), ["row_id"], "k")
    return T.promote_rows(numbered, VALUE_CLASSES, BASE, 1700000000000, F.col("k"))


# --- catalogue records ------------------------------------------------------------------------------------

VIEWS["catalog_records"] = """SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 500 = 7 THEN '' ELSE 'ds-' || CAST(o_orderkey AS STRING) END AS id,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN ' ' ELSE '  Order ' || CAST(o_orderkey AS STRING) || chr(9) || 'of   ' || c_name END AS title, 'about ' || o_orderpriority AS description,
    CASE WHEN o_orderstatus = 'P' THEN 'around ' || substr(CAST(o_orderdate AS STRING), 1, 4) ELSE substr(CAST(o_orderdate AS STRING), 1, 10) || 'T10:00:00Z' END AS metadata_created,
    CASE WHEN c_nationkey = 3 THEN '' ELSE upper(c_mktsegment) END AS license_id, CASE WHEN c_nationkey = 4 THEN 'Licence ' || c_mktsegment ELSE '' END AS license_title,
    CASE WHEN c_nationkey > 20 THEN '' ELSE 'org-' || CAST(c_nationkey AS STRING) END AS organization_id, CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'Nation ' || CAST(c_nationkey AS STRING) || o_orderstatus END AS organization_title,
    'desc ' || CAST(o_orderkey AS STRING) AS organization_description, 'https://a.example.org/' || CAST(o_orderkey AS STRING) || ' ; ; https://b.example.org/' AS resource_urls,
    c_name || '; ' || CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'Second ' || c_mktsegment END AS contact_name, 'C' || CAST(o_custkey AS STRING) || '@Example.org;second@example.org;third@example.org' AS contact_email,
    CASE WHEN o_orderpriority = '5-LOW' THEN c_mktsegment ELSE '' END AS contributor_name, CASE WHEN o_orderpriority = '2-HIGH' THEN 'x' || CAST(o_custkey AS STRING) || '@example.org' ELSE '' END AS contributor_email,
    CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'Jörg ' || c_mktsegment || ';Publisher ' || CAST(c_nationkey AS STRING) END AS publisher_name, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'pub@example.org' ELSE '' END AS publisher_email,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'https://pub.example.org/' || c_mktsegment ELSE '' END AS publisher_uri FROM {orders} JOIN {customer} ON c_custkey = o_custkey"""


def clean(x):
    return f"trim(regexp_replace(regexp_replace(coalesce({x}, ''), '[\\t\\r\\n]', ' ', 'g'), '\\s{{2,}}', ' ', 'g'))"


def items(x):
    return f"list_filter(list_transform(string_split({clean(x)}, ';'), lambda y: trim(y)), lambda y: y <> '')"


def mint(x):
    return f"'{BASE}' || {uuid5(x)}"


MDY = "CASE WHEN regexp_matches({0}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN strftime(CAST(substr({0}, 1, 10) AS DATE), '%m/%d/%Y') ELSE {0} END"


def at(lst, i="i"):
    return f"coalesce({lst}[{i}], '')"


REC = f"""r AS (SELECT *, '{BASE}' || {clean('id')} AS ds, {clean('title')} AS label, {mint(f"'{BASE}' || {clean('id')} || '/publishing-process'")} AS proc, {MDY.format(clean('metadata_created'))} AS day FROM catalog_records WHERE {clean('id')} <> '')"""
PPL = "ppl AS (" + " UNION ALL ".join(
    f"""SELECT ord, {side} AS side, '{role}' AS role, i, {at('ns')} AS name, {at('es')} AS email FROM (SELECT ord, {items(role + '_name')} AS ns, {items(role + '_email')} AS es,
      unnest(range(1, greatest(len({items(role + '_name')}), len({items(role + '_email')})) + 1)) AS i FROM r)""" for side, role in enumerate(("contact", "contributor"))) + "), " + \
    f"pp AS (SELECT *, {mint('name || chr(124) || role')} AS iri FROM ppl)"
PUB = f"""pub0 AS (SELECT ord, ds, label, proc, i, {at('ns')} AS name, {at('es')} AS email, {at('us')} AS uri FROM (SELECT ord, ds, label, proc, {items('publisher_name')} AS ns, {items('publisher_email')} AS es, {items('publisher_uri')} AS us,
      unnest(range(1, greatest(len({items('publisher_name')}), len({items('publisher_email')}), len({items('publisher_uri')})) + 1)) AS i FROM r)),
    pub1 AS (SELECT *, CASE WHEN name <> '' THEN name ELSE uri END AS ak, coalesce(nullif(name, ''), nullif(email, ''), uri) AS shown FROM pub0 WHERE name <> '' OR email <> '' OR uri <> ''),
    pub AS (SELECT *, {mint('ak')} AS agent, CASE WHEN shown <> '' THEN {mint("'written-name|' || shown")} ELSE '' END AS written, {mint(f"proc || '/' || {mint('ak')}")} AS role_iri FROM pub1)"""
LK = f"coalesce(nullif({clean('license_id')}, ''), {clean('license_title')})"
EMAIL = mint("lower(email)")
O = ONT  # noqa: E741
CATALOG_SQL = {
    "datasets": f"""SELECT ds AS "ID", '{O}Dataset' AS "TYPE", label, CASE WHEN label <> '' THEN {mint("ds || '/title'")} ELSE '' END AS denoted_by_title, {clean('description')} AS description,
      CASE WHEN {LK} <> '' THEN {mint(f'lower({LK})')} ELSE '' END AS license, proc AS publishing_process, array_to_string({items('resource_urls')}, ';') AS has_url FROM r""",
    "titles": f"""SELECT iri AS "ID", '{O}Title' AS "TYPE", arg_max(label, ord) AS label, arg_max(label, ord) AS value FROM (SELECT ord, label, {mint("ds || '/title'")} AS iri FROM r WHERE label <> '') GROUP BY iri""",
    "organizations": f"""SELECT '{BASE}' || oid AS "ID", '{O}Organization' AS "TYPE", arg_min(coalesce(nullif({clean('organization_title')}, ''), oid), ord) AS label, arg_min({clean('organization_description')}, ord) AS description
      FROM (SELECT *, {clean('organization_id')} AS oid FROM r) WHERE oid <> '' GROUP BY oid""",
    "persons": f"""SELECT p.iri AS "ID", '{O}Person' AS "TYPE", p.label, coalesce(l.c, '') AS denoted_by, CASE WHEN p.n = '' THEN 'nameless' ELSE '' END AS quality FROM
      (SELECT iri, arg_min(coalesce(nullif(name, ''), nullif(email, ''), name || '|' || role), (ord, side, i)) AS label, min(name) AS n FROM pp GROUP BY iri) p LEFT JOIN
      (SELECT iri, string_agg(d, ';' ORDER BY d) AS c FROM (SELECT DISTINCT iri, d FROM (SELECT iri, {EMAIL} AS d FROM pp WHERE email <> '' UNION ALL SELECT iri, {mint("'written-name|' || name")} FROM pp WHERE name <> '')) GROUP BY iri) l ON l.iri = p.iri""",
    "emails": f"""SELECT iri AS "ID", '{O}Email' AS "TYPE", arg_max(value, (ord, side, i)) AS label, arg_max(value, (ord, side, i)) AS value FROM
      (SELECT ord, side, i, email AS value, {EMAIL} AS iri FROM (SELECT ord, side, i, email FROM pp UNION ALL SELECT ord, 2, i, email FROM pub) WHERE email <> '') GROUP BY iri""",
    "websites": f"""SELECT DISTINCT {mint('uri')} AS "ID", '{O}Website' AS "TYPE", uri AS label, uri AS url FROM pub WHERE uri <> ''""",
    "written_names": f"""SELECT DISTINCT {mint("'written-name|' || n")} AS "ID", '{O}WrittenName' AS "TYPE", n AS label, n AS value FROM (SELECT name AS n FROM pp UNION SELECT shown FROM pub) WHERE n <> ''""",
    "licenses": f"""SELECT iri AS "ID", '{O}License' AS "TYPE", arg_max(l, ord) AS label, arg_max(l, ord) AS value FROM (SELECT ord, {mint(f'lower({LK})')} AS iri, coalesce(nullif({clean('license_title')}, ''), {clean('license_id')}) AS l FROM r WHERE {LK} <> '') GROUP BY iri""",
    "processes": f"""SELECT b.iri AS "ID", '{O}PublishingProcess' AS "TYPE", b.label, coalesce(a.c, '') AS has_participant, coalesce(o.c, '') AS realizes_role, b.d AS occupies_temporal_region, '' AS standard FROM
      (SELECT proc AS iri, arg_min('dataset publishing process for ' || coalesce(nullif(label, ''), ds), ord) AS label, arg_min(CASE WHEN day <> '' THEN {mint("'publishing-date|' || day")} ELSE '' END, ord) AS d FROM r GROUP BY proc) b
      LEFT JOIN (SELECT proc, string_agg(agent, '|' ORDER BY k) AS c FROM (SELECT proc, agent, min((ord, i)) AS k FROM pub GROUP BY proc, agent) GROUP BY proc) a ON a.proc = b.iri
      LEFT JOIN (SELECT proc, string_agg(role_iri, ',' ORDER BY k) AS c FROM (SELECT proc, role_iri, min((ord, i)) AS k FROM pub GROUP BY proc, role_iri) GROUP BY proc) o ON o.proc = b.iri""",
    "agents": f"""SELECT agent AS "ID", '{O}ContactPoint' AS "TYPE", arg_min('ContactPoint: ' || shown, (ord, i)) AS label, arg_min(written, (ord, i)) AS denoted_by_written_name FROM pub GROUP BY agent""",
    "roles": f"""SELECT role_iri AS "ID", '{O}ContactPointRole' AS "TYPE", arg_max('ContactPointRole for ' || coalesce(nullif(label, ''), ds), (ord, i)) AS label, arg_max(CASE WHEN email <> '' THEN {EMAIL} ELSE '' END, (ord, i)) AS role_email,
      arg_max(CASE WHEN uri <> '' THEN {mint('uri')} ELSE '' END, (ord, i)) AS role_website, arg_max(written, (ord, i)) AS written_name, arg_max(agent, (ord, i)) AS role_of FROM pub GROUP BY role_iri""",
    "dates": f"""SELECT DISTINCT {mint("'publishing-date|' || day")} AS "ID", '{O}TemporalRegion' AS "TYPE", 'DatasetPublishingDate' AS label, day AS value FROM r WHERE day <> ''""",
}
NEEDS = {"persons": f"{REC}, {PPL}", "emails": f"{REC}, {PPL}, {PUB}", "written_names": f"{REC}, {PPL}, {PUB}", "websites": f"{REC}, {PUB}", "processes": f"{REC}, {PUB}", "agents": f"{REC}, {PUB}", "roles": f"{REC}, {PUB}"}
for _t, _sql in CATALOG_SQL.items():
    query("catalog_" + _t, views="catalog_records", sql=f"WITH {NEEDS.get(_t, REC)} {_sql}")(lambda c, t=_t: getattr(K.Catalog(c.view("catalog_records")), t)())


@query("zip_lists", views="catalog_records", sql=f"WITH {REC}, {PUB} SELECT ord, CAST(i - 1 AS INTEGER) AS pos, name, email, uri FROM pub0")
def _(c):
    r = c.view("catalog_records").where(S.sanitize("id") != "")
    return K.zip_lists(r, {"name": "publisher_name", "email": "publisher_email", "uri": "publisher_uri"}).select("ord", "pos", "name", "email", "uri")


@query("ordered_members", sql="""
    SELECT l_orderkey, string_agg(m, '|' ORDER BY k) AS members FROM (SELECT l_orderkey, 'S' || CAST(l_suppkey AS VARCHAR) AS m, min(l_linenumber) AS k FROM lineitem GROUP BY l_orderkey, l_suppkey)
    WHERE TRUE GROUP BY l_orderkey HAVING count(DISTINCT k) = count(*)""")
def _(c):
    li = c.t("lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("m"))
    # orders in which two members start on the same line have no defined order
    at_ = li.groupBy("l_orderkey", "m").agg(F.min("l_linenumber").alias("k"))
    clear = at_.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("a"), F.count_distinct("k").alias("b")).where("a = b")
    return K.ordered_members(li.join(clear, "l_orderkey", "left_semi"), "l_orderkey", "l_linenumber", "m", "|", "members")


@query("org_match", sql="""
    WITH reg AS (SELECT s_suppkey AS id, s_suppkey AS pos, s_nationkey AS country, unnest([s_name, 'alias ' || CAST(s_suppkey AS VARCHAR), 'S' || CAST(s_suppkey AS VARCHAR)]) AS n FROM supplier),
    w AS (SELECT c_custkey AS row_id, c_nationkey AS country, CASE WHEN c_mktsegment = 'BUILDING' THEN 'ALIAS ' || CAST(c_custkey % 100 AS VARCHAR) WHEN c_mktsegment = 'MACHINERY' THEN 'alias of none' ELSE 's' || CAST(c_custkey % 100 AS VARCHAR) END AS name FROM customer),
    hit AS (SELECT row_id, id, pos, 1 AS x FROM w JOIN reg ON lower(trim(reg.n)) = lower(trim(w.name)) AND reg.country = w.country
      UNION ALL SELECT row_id, id, pos, 0 FROM w JOIN reg ON split_part(lower(trim(reg.n)), ' ', 1) = split_part(lower(trim(w.name)), ' ', 1) AND reg.country = w.country)
    SELECT row_id, arg_min(id, (-x, pos, id)) AS registry_id, CASE WHEN max(x) = 1 THEN 'exact' ELSE 'candidate' END AS matched_by FROM hit GROUP BY row_id""")
def _(c):
    from kgspark.operators.harvest import match_organizations
    reg = c.t("supplier").select(F.col("s_suppkey").alias("registry_id"), F.col("s_suppkey").alias("position"), F.col("s_nationkey").alias("country"), F.col("s_name").alias("name"),
                                 F.array(F.concat(F.lit("alias "), F.col("s_suppkey").cast("string"))).alias("aliases"), F.array(F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))).alias("acronyms"))
    k = (F.col("c_custkey") % 100).cast("string")
    want = c.t("customer").select(F.col("c_custkey").alias("row_id"), F.col("c_nationkey").alias("country"), F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("ALIAS "), k)).when(
        F.col("c_mktsegment") == "MACHINERY", "alias of none").otherwise(F.concat(F.lit("s"), k)).alias("name"))
    return match_organizations(want, reg)


# --- scalar functions over whole tables -------------------------------------------------------------------

@query("sanitize", views="catalog_records", sql=f"SELECT ord, {clean('title')} AS clean, array_to_string({items('contact_name')}, '|') AS parts FROM catalog_records")
def _(c):
    return c.view("catalog_records").select("ord", S.sanitize("title").alias("clean"), F.array_join(S.split_list("contact_name"), "|").alias("parts"))


@query("parse_date", views="catalog_records", sql=f"SELECT ord, {MDY.format(clean('metadata_created'))} AS day, CASE WHEN regexp_matches(metadata_created, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') THEN strftime(CAST(metadata_created AS DATE), '%d.%m.%Y') ELSE metadata_created END AS dmy FROM catalog_records")
def _(c):
    return c.view("catalog_records").select("ord", S.date_mdy("metadata_created").alias("day"), S.date_dmy("metadata_created").alias("dmy"))


@query("utc_stamp", sql="SELECT event_id, strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') AS seconds, strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS micros FROM events")
def _(c):
    e_ = c.t("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return e_.select("event_id", S.utc_stamp("ts").alias("seconds"), S.utc_stamp("ts", False).alias("micros"))


@query("slugify", sql="""
    SELECT p_partkey, trim(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '-') AS slug, trim(regexp_replace(t, '[^A-Za-z0-9._-]+', '_', 'g'), '_') AS segment,
    regexp_replace(lower('https://doi.org/10.5281/Zenodo.' || CAST(p_partkey AS VARCHAR)), '^(https?://(dx\\.)?doi\\.org/|doi:)', '') AS doi,
    replace(regexp_replace(lower('https://doi.org/10.5281/Zenodo.' || CAST(p_partkey AS VARCHAR)), '^(https?://(dx\\.)?doi\\.org/|doi:)', ''), '/', '_') AS folder,
    substr(sha1('b:g/' || CAST(p_partkey AS VARCHAR)), 1, 16) AS stem FROM (SELECT p_partkey, ' ' || p_name || ' (' || p_brand || ')' AS t FROM part)""")
def _(c):
    t, k = F.concat(F.lit(" "), "p_name", F.lit(" ("), "p_brand", F.lit(")")), F.col("p_partkey").cast("string")
    doi = F.concat(F.lit("https://doi.org/10.5281/Zenodo."), k)
    return c.t("part").select("p_partkey", S.slug(t).alias("slug"), S.safe_segment(t).alias("segment"), S.normalize_doi(doi).alias("doi"), S.doi_folder(doi).alias("folder"), S.graph_stem(F.concat(F.lit(BASE + "g/"), k)).alias("stem"))


VIEWS["refs"] = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'https://doi.org/10.5281/zenodo.' || CAST(o_orderkey AS STRING) WHEN '2-HIGH' THEN 'https://zenodo.org/records/' || CAST(o_orderkey AS STRING) || '?x=1'
    WHEN '3-MEDIUM' THEN ' ' || CAST(o_orderkey AS STRING) || ' ' WHEN '4-NOT SPECIFIED' THEN 'https://GitHub.com/Org-' || CAST(o_custkey AS STRING) || '/Repo.' || CAST(o_orderkey AS STRING) || '.git'
    ELSE 'https://github.com/orgs/' || CASE WHEN o_orderstatus = 'F' THEN 'issues' ELSE 'tool/tree/x' END END AS ref FROM {orders}"""


@query("parse_refs", views="refs", sql=r"""
    SELECT o_orderkey, coalesce(nullif(regexp_extract(trim(ref), '(?i)10\.5281/zenodo\.(\d+)', 1), ''), nullif(regexp_extract(trim(ref), '(?i)zenodo\.org/records/(\d+)', 1), ''), nullif(regexp_extract(trim(ref), '^(\d+)$', 1), '')) AS record,
    CASE WHEN contains(lower(ref), 'github.com') THEN 'github' WHEN contains(lower(ref), 'zenodo.') THEN 'zenodo' END AS source,
    CASE WHEN contains(lower(ref), 'github.com') AND lower(split_part(ref, '/', 5)) NOT IN ('issues') THEN split_part(ref, '/', 4) || '/' || regexp_replace(split_part(ref, '/', 5), '\.git$', '') END AS repo FROM refs""")
def _(c):
    return c.view("refs").select("o_orderkey", S.record_id("ref").alias("record"), S.infer_source("ref").alias("source"), S.owner_repo("ref").alias("repo"))


@query("mint_uuid5", sql=f"SELECT c_custkey, {uuid5(chr(39) + 'Jörg' + chr(39) + ' || c_name')} AS id, '{BASE}part/' || substr(sha1(c_name || ' ' || c_mktsegment), 1, 24) AS partition FROM customer")
def _(c):
    return c.t("customer").select("c_custkey", S.uuid5(F.concat(F.lit("Jörg"), "c_name"), K.NAMESPACE).alias("id"), S.partition_iri("c_name", "c_mktsegment", BASE + "part/").alias("partition"))


VIEWS["urls"] = "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '  ' || url || '/ ' WHEN page_id % 5 = 1 THEN 'ftp://' || CAST(page_id AS STRING) ELSE url END AS u FROM {pages}"


@query("url_canon", views="urls", sql="SELECT page_id, regexp_replace(trim(u), '/$', '') AS canon, CASE WHEN regexp_matches(trim(u), '^https?://') THEN trim(u) END AS http FROM urls")
def _(c):
    return c.view("urls").select("page_id", S.url_canon("u").alias("canon"), S.http_url("u").alias("http"))


@query("url_tail", sql="SELECT page_id, regexp_extract(regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', ''), '([^/]+)/*$', 1) AS tail FROM pages")
def _(c):
    return c.t("pages").select("page_id", F.coalesce(S.url_tail("url"), F.lit("")).alias("tail"))


@query("excerpt", sql="SELECT doc_id, CASE WHEN length(t) <= 600 THEN t ELSE substr(t, 1, 600) || chr(10) || '…(truncated)' END AS excerpt FROM (SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM documents)")
def _(c):
    return c.t("documents").select("doc_id", S.excerpt("text").alias("excerpt"))


@query("is_english", sql=f"""
    WITH w AS (SELECT lang, text, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: x <> '') AS w FROM documents)
    SELECT lang, length(trim(text)) >= 20 AND CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: list_contains({S.STOPWORDS_EN!r}, x))) / len(w) ELSE 0 END >= 0.12 AS english, count(*) AS n FROM w GROUP BY ALL""")
def _(c):
    d = c.t("documents").select("lang", S.is_english("text").alias("english"))
    return d.groupBy("lang", "english").agg(F.count(F.lit(1)).alias("n"))


@query("fix_mojibake", sql="SELECT doc_id, CAST(CASE WHEN text IS NOT NULL THEN TRUE END AS BOOLEAN) AS repaired FROM documents")
def _(c):
    bad = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    d = c.t("documents").select("doc_id", "text", X.fix_mojibake(bad).alias("fixed"))
    return d.select("doc_id", (F.col("fixed") == F.col("text")).alias("repaired"))


def _quoted(part, safe):
    keep = "^[A-Za-z0-9_.~" + "".join("\\" + x for x in safe).replace("'", "''") + "-]$"
    return f"array_to_string(list_transform(string_split({part}, ''), lambda x: CASE WHEN regexp_matches(x, '{keep}') THEN x ELSE regexp_replace(hex(encode(x)), '(..)', '%\\1', 'g') END), '')"


def _encoded(keep: str, source: str) -> str:
    """SELECT of the columns ``keep`` and ``encoded`` from ``source`` (keep.., iri)."""
    unsafe = X.UNSAFE.replace("'", "''")
    return f"""WITH i AS ({source}), p AS (SELECT *, regexp_extract(iri, '(?s)^(https?://[^/?#]*)', 1) AS host, regexp_replace(iri, '(?s)^https?://[^/?#]*', '') AS rest FROM i),
    q AS (SELECT *, regexp_replace(rest, '(?s)[?#].*$', '') AS path, regexp_extract(rest, '(?s)^[^?#]*\\?([^#]*)', 1) AS query, regexp_extract(rest, '(?s)^[^#]*#(.*)$', 1) AS frag FROM p),
    r AS (SELECT *, regexp_extract(path, '(?s)^(?:.*/)?[^/;]*(;[^/]*)$', 1) AS params FROM q)
    SELECT {keep}, CASE WHEN host = '' OR NOT regexp_matches(iri, '{unsafe}') THEN iri ELSE host || {_quoted("substr(path, 1, length(path) - length(params))", X.GRAPH_SAFE["path"])} || params
      || CASE WHEN query <> '' THEN '?' || {_quoted("query", X.GRAPH_SAFE["query"])} ELSE '' END || CASE WHEN frag <> '' THEN '#' || {_quoted("frag", "")} ELSE '' END END AS encoded FROM r"""


@query("pct_encode", sql=_encoded("page_id", "SELECT page_id, url || '/' || html AS iri FROM pages"))
def _(c):
    return c.t("pages").select("page_id", X.pct_encode(F.concat(F.col("url"), F.lit("/"), F.col("html"))).alias("encoded"))


@query("normalize_iris", graphs="documents files", sql="SELECT graph, s, p, encoded AS o FROM (" + _encoded(
    "graph, s, p", "SELECT graph, s, p, CASE WHEN p = 'rdfs:label' THEN 'b:t/' || o ELSE o END AS iri FROM quads") + ")")
def _(c):
    """Labels stand in for IRIs with characters of all kinds."""
    label = F.col("p") == LABEL
    q = c.quads.withColumn("o", F.when(label, F.concat(F.lit(BASE + "t/"), "o")).otherwise(F.col("o"))).withColumn("o_kind", F.when(label, "iri").otherwise(F.col("o_kind")))
    enc = lambda x, k: F.when(F.col(k) == "iri", X.pct_encode(x)).otherwise(F.col(x))
    return q.select("graph", enc("s", "s_kind").alias("s"), X.pct_encode("p").alias("p"), enc("o", "o_kind").alias("o"))


ORACLES["sink_tsv"] = f"""SELECT 'ID' AS "ID", 'TYPE' AS "TYPE", 'A {LABEL}' AS label, 'A {ONT}comment' AS description UNION ALL SELECT "ID", "TYPE", label, description FROM ({ORACLES["catalog_organizations"]})"""


@query("sink_tsv", views="catalog_records")
def _(c):
    """Written with its directive row and read back."""
    path = c.scratch("tsv")
    sinks.write_tsv(K.Catalog(c.view("catalog_records")).organizations(), path, ["ID", "TYPE", f"A {LABEL}", f"A {ONT}comment"])
    t = c.spark.read.options(sep="\t", header=True).csv(path)
    return t.select(*[F.coalesce(x, F.lit("")).alias(x) for x in t.columns])
