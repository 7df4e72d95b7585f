"""Descriptions written as quads: per graph, file, endpoint, record and release.

One row of facts becomes its triples through one exploded array of templates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kgspark.functions.scalars import excerpt, label_fallback, partition_iri
from kgspark.model import (
    COMMENT, DEFAULT_GRAPH, LABEL, OWL, PREFIXES, QUAD_COLS, RDFS, SEE_ALSO, SUBCLASS, TERMS, TRIPLE_COLS, TYPE, VOID, XSD, Terms)
from kgspark.operators.metrics import CLASS_TYPES
from kgspark.operators.pattern import english_labels, semi

STAT = PREFIXES["stat"]


def _s(x) -> Column:
    return F.lit(x) if isinstance(x, str) else x


def iri(s, p: str, o, when: Column | None = None) -> Column:
    return _triple(s, p, o, "iri", None, when)


def lit(s, p: str, o, dt: str | None = None, when: Column | None = None) -> Column:
    return _triple(s, p, o, "literal", dt, when)


def _triple(s, p, o, kind, dt, when) -> Column:
    o = _s(o)
    row = F.struct(_s(s).alias("s"), F.lit("iri").alias("s_kind"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"),
                   F.lit(dt).cast("string").alias("o_datatype"), F.lit("").alias("o_lang"))
    cond = o.isNotNull() if when is None else when & o.isNotNull()
    return F.when(cond, row)


def explode_triples(facts: DataFrame, graph, *triples: Column) -> DataFrame:
    return facts.select(_s(graph).alias("graph"), F.inline(F.array_compact(F.array(*triples)))).select(QUAD_COLS)


def _node(base: str, suffix: str) -> Column:
    return F.concat(F.col(base), F.lit(suffix))


def _lines(*pairs) -> Column:
    """'key: value' lines; a null value reads NA."""
    return F.concat_ws("\n", *[F.concat(F.lit(k), F.coalesce(v.cast("string"), F.lit("NA"))) for k, v in pairs])


def _load(root: str, begin, end, process: str, region: str, t0: str, t1: str, t: Terms) -> list[Column]:
    p, r, a, b = (_node(root, x) for x in (process, region, t0, t1))
    out = [iri(p, TYPE, t.process), iri(p, t.occupies, r), iri(r, TYPE, t.region), iri(r, t.first_instant, a), iri(r, t.last_instant, b),
           iri(a, TYPE, t.instant), lit(a, t.timestamp, begin, XSD + "dateTimeStamp")]
    if t1 != t0:
        out += [iri(b, TYPE, t.instant), lit(b, t.timestamp, end, XSD + "dateTimeStamp")]
    return out


def graph_metadata(facts: DataFrame, terms: Terms = TERMS) -> DataFrame:
    """``facts``: root, graph, stage, run_id, started_at, ended_at and the six RDF statistics."""
    t = terms
    text = _lines(("Published data graph: ", F.col("graph")), ("run_id: ", F.col("run_id")), ("stage: ", F.col("stage")),
                  ("Statistics:\n  triples: ", F.col("triples")), ("  subjects: ", F.col("subjects")),
                  ("  predicates: ", F.col("predicates")), ("  objects: ", F.col("objects")),
                  ("  rdf:type assertions: ", F.col("type_assertions")), ("  distinct rdf:type objects: ", F.col("distinct_type_objects")))
    root, d, u, i = F.col("root"), _node("root", "/description"), _node("root", "/url"), _node("root", "/identifier")
    return explode_triples(
        facts, F.col("root"), iri(root, TYPE, t.data_collection), iri(root, t.output_of, _node("root", "/publish-process")),
        iri(root, t.external_id, i), iri(root, t.denoted_by, d), iri(root, t.denoted_by, u),
        iri(d, TYPE, t.description), lit(d, t.has_value, text), iri(u, TYPE, t.website), lit(u, t.has_url, root, XSD + "anyURI"),
        iri(i, TYPE, t.identifier), lit(i, t.has_value, F.col("run_id")),
        *_load("root", F.col("started_at"), F.col("ended_at"), "/publish-process", "/temporal-region", "/begin", "/end", t))


def graph_provenance(facts: DataFrame, terms: Terms = TERMS) -> DataFrame:
    """``facts``: graph, record, file_key, download_url, harvested_at, consistent (null = pending),
    checked_at, log. Written to the default graph."""
    t = terms
    g, d, v = F.col("graph"), _node("graph", "/description"), _node("graph", "/validation")
    about = _lines(("Imported RDF graph.\nfile: ", F.col("file_key")), ("record: ", F.col("record")),
                   ("download_url: ", F.coalesce("download_url", F.lit(""))), ("harvested_at: ", F.col("harvested_at")))
    status = F.when(F.col("consistent").isNull(), F.lit("status: pending")).otherwise(F.concat(
        F.when(F.col("consistent"), F.lit("status: consistent")).otherwise("status: INCONSISTENT"),
        F.lit("\nchecked_at: "), F.coalesce("checked_at", F.lit("")), F.lit("\nsummary: "), excerpt("log")))
    return explode_triples(
        facts, DEFAULT_GRAPH, iri(F.col("record"), t.has_part, g), iri(g, TYPE, t.file), lit(g, LABEL, F.col("file_key")),
        iri(g, t.part_of, F.col("record")), iri(g, t.output_of, _node("graph", "/harvest-process")), iri(g, t.denoted_by, d),
        iri(g, t.denoted_by, v), lit(g, t.has_url, F.col("download_url"), XSD + "anyURI"),
        iri(d, TYPE, t.description), lit(d, LABEL, "description"), lit(d, t.has_value, about),
        iri(v, TYPE, t.description), lit(v, LABEL, "validation"), lit(v, t.has_value, status),
        lit(v, COMMENT, "INCONSISTENT", when=F.coalesce(~F.col("consistent"), F.lit(False))),
        *_load("graph", F.col("harvested_at"), None, "/harvest-process", "/harvest-temporal", "/harvest-instant", "/harvest-instant", t))


def dump_metadata(facts: DataFrame, terms: Terms = TERMS) -> DataFrame:
    """``facts``: dump, stage, version, file, ontology_version, doi (may be null), published, triples."""
    t = terms
    d, v, f = F.col("dump"), _node("dump", "/version"), _node("dump", "/file")
    url = F.when(F.col("doi").isNotNull(), F.concat(F.lit("https://doi.org/"), "doi")).otherwise(F.concat("dump", F.lit("/download")))
    return explode_triples(
        facts, DEFAULT_GRAPH, iri(d, TYPE, t.data_collection), lit(d, LABEL, F.concat("stage", F.lit(" "), "version")),
        iri(d, t.denoted_by, v), iri(v, TYPE, t.identifier), lit(v, t.has_value, F.col("version")), iri(d, t.has_part, f),
        iri(f, TYPE, t.file), lit(f, LABEL, F.col("file")), lit(f, t.has_url, url, XSD + "anyURI"),
        lit(d, STAT + "ontologyVersion", F.col("ontology_version")), lit(d, VOID + "triples", F.col("triples").cast("string"), XSD + "integer"),
        lit(d, STAT + "published", F.col("published")))


def void_description(facts: DataFrame, partitions: DataFrame, terms: Terms = TERMS) -> DataFrame:
    """Self-description of harvested files inside their graph, and the registry in the default graph.

    ``facts``: graph, subject, type (null for known entities), key, path, file_name, version,
    landing, download_url, content_type, sha256, harvested_at, registered_from, kind, triples, subjects,
    predicates, classes. ``partitions``: graph, kind, iri, count.
    """
    t = terms
    g, desc, src, proc = F.col("graph"), _node("graph", "#desc"), _node("graph", "#source"), _node("graph", "#load")
    num = lambda c: F.col(c).cast("string")
    text = _lines(("Imported RDF graph from ", F.col("kind")), ("source: ", F.col("key")), ("registered_as: ", F.col("registered_from")), ("file: ", F.col("path")),
                  ("version: ", F.coalesce("version", F.lit(""))), ("landing_page: ", F.col("landing")), ("download_url: ", F.col("download_url")),
                  ("content_type: ", F.col("content_type")), ("sha256: ", F.col("sha256")), ("harvested_at: ", F.col("harvested_at")),
                  ("Statistics:\n  triples: ", F.col("triples")), ("  subjects: ", F.col("subjects")),
                  ("  predicates: ", F.col("predicates")), ("  classes: ", F.col("classes")))
    inside = explode_triples(
        facts, g, iri(g, TYPE, VOID + "Dataset"), iri(g, TYPE, t.data_collection), lit(g, LABEL, F.concat_ws(" — ", "key", "file_name")),
        *[lit(g, VOID + p, num(c), XSD + "integer") for p, c in (("triples", "triples"), ("distinctSubjects", "subjects"), ("classes", "classes"), ("properties", "predicates"))],
        lit(g, VOID + "dataDump", F.col("download_url"), XSD + "anyURI"), iri(g, t.output_of, proc), iri(g, t.denoted_by, desc),
        iri(desc, TYPE, t.description), lit(desc, LABEL, "description"), lit(desc, t.has_value, text),
        lit(proc, LABEL, F.concat(F.lit("graph load of "), "file_name")), iri(proc, t.has_input, src),
        iri(src, TYPE, t.file), lit(src, LABEL, F.col("file_name")), lit(src, t.has_url, F.col("download_url"), XSD + "anyURI"),
        lit(src, t.has_value, F.concat(F.lit("sha256:"), "sha256")),
        *_load("graph", F.col("harvested_at"), None, "#load", "#tr", "#t0", "#t0", t))
    p = partitions.join(facts.select("graph"), "graph", "left_semi").withColumn("part", F.concat("graph", F.lit("#part-"), F.substring(F.sha1(F.concat_ws(" ", "kind", "iri")), 1, 24)))
    is_c = F.col("kind") == "class"
    parts = explode_triples(
        p, g, iri(g, VOID + "classPartition", F.col("part"), is_c), iri(F.col("part"), VOID + "class", F.col("iri"), is_c),
        lit(F.col("part"), VOID + "entities", num("count"), XSD + "integer", is_c), iri(g, VOID + "propertyPartition", F.col("part"), ~is_c),
        iri(F.col("part"), VOID + "property", F.col("iri"), ~is_c), lit(F.col("part"), VOID + "triples", num("count"), XSD + "integer", ~is_c))
    ver, sub, land = _node("graph", "/version"), F.col("subject"), F.concat("subject", F.lit("/landing"))
    registry = explode_triples(
        facts, DEFAULT_GRAPH, lit(sub, LABEL, F.col("key")), iri(sub, TYPE, F.col("type")), iri(sub, t.denoted_by, land), iri(land, TYPE, t.website),
        lit(land, t.has_url, F.col("landing"), XSD + "anyURI"), iri(sub, t.has_part, g), iri(g, TYPE, t.file), lit(g, LABEL, F.col("file_name")),
        iri(g, t.part_of, sub), lit(g, t.has_url, F.col("download_url"), XSD + "anyURI"),
        iri(g, t.denoted_by, ver, F.col("version").isNotNull()), iri(ver, TYPE, t.identifier, F.col("version").isNotNull()),
        lit(ver, LABEL, "version", when=F.col("version").isNotNull()), lit(ver, t.has_value, F.col("version")),
        lit(g, STAT + "registeredFrom", F.col("registered_from")), lit(g, STAT + "sourceType", F.col("kind")), lit(g, STAT + "sourceFile", F.col("path")),
        lit(g, STAT + "triples", num("triples"), XSD + "integer"), lit(g, STAT + "harvestedAt", F.col("harvested_at"), XSD + "dateTimeStamp"),
        lit(g, STAT + "landing", F.col("landing"), XSD + "anyURI"), lit(g, STAT + "version", F.col("version")))
    return inside.unionByName(parts).unionByName(registry).distinct()


def endpoint_void(counts: DataFrame, per_class: DataFrame, vocabularies: DataFrame, reuse: DataFrame, base: str) -> DataFrame:
    """VoID statistics of sources: counts, class partitions, vocabularies in use, reused terms."""
    g = F.col("graph")
    num = lambda c: F.col(c).cast("string")
    head = explode_triples(counts, DEFAULT_GRAPH, iri(g, TYPE, VOID + "Dataset"), *[
        lit(g, p, num(c), XSD + "integer") for p, c in (
            (VOID + "classes", "classes"), (STAT + "objectProperties", "object_properties"), (STAT + "dataProperties", "data_properties"),
            (VOID + "entities", "instances"))])
    part = per_class.withColumn("part", partition_iri("graph", "class_iri", base))
    parts = explode_triples(part, DEFAULT_GRAPH, iri(g, VOID + "classPartition", F.col("part")), iri(F.col("part"), VOID + "class", F.col("class_iri")),
                            lit(F.col("part"), VOID + "entities", num("n"), XSD + "integer"), lit(F.col("part"), LABEL, F.col("label"), when=F.col("label") != ""))
    voc = explode_triples(vocabularies, DEFAULT_GRAPH, iri(g, VOID + "vocabulary", F.col("vocabulary")))
    kind = F.col("kind")
    used = explode_triples(reuse, DEFAULT_GRAPH, *[iri(g, STAT + "reused" + k.title(), F.col("iri"), kind == k) for k in ("class", "object", "data")])
    return head.unionByName(parts).unionByName(voc).unionByName(used).distinct()


def catalog_merge(catalog: DataFrame, summaries: DataFrame, reuse: DataFrame) -> DataFrame:
    """Catalogue triples plus snapshot links, counts and reuse lists of records.

    ``summaries``: record, classes_graph, hierarchy_graph, schema_graph and the local counts;
    ``reuse``: record, kind, iri.
    """
    r = F.col("record")
    links = explode_triples(
        summaries, DEFAULT_GRAPH, *[iri(r, STAT + c, F.col(c)) for c in ("classes_graph", "hierarchy_graph", "schema_graph")],
        *[lit(r, STAT + c, F.col(c).cast("string"), XSD + "integer") for c in ("classes", "object_properties", "data_properties", "instances")])
    kind = F.col("kind")
    used = explode_triples(reuse, DEFAULT_GRAPH, *[iri(r, STAT + "reused" + k.title(), F.col("iri"), kind == k) for k in ("class", "object", "data")])
    return catalog.select(QUAD_COLS).unionByName(links).unionByName(used).distinct()


RECORD_CLASSES = {
    "figure": ["image"], "software": ["software"],
    "publication": ["publication", "article", "conferencepaper", "book", "section", "thesis", "report", "workingpaper", "preprint",
                    "softwaredocumentation", "presentation", "poster", "lesson"],
}


def record_class(kind: Column, iris: dict[str, str], default: str) -> Column:
    out = F.lit(default)
    for name, kinds in RECORD_CLASSES.items():
        out = F.when(F.lower(kind).isin(kinds), iris[name]).otherwise(out)
    return out


def record_triples(records: DataFrame, class_iris: dict[str, str], default_class: str, url_base: str, terms: Terms = TERMS) -> DataFrame:
    """``records``: subject, id, resource_type, upload_type, title."""
    kind = F.coalesce(F.nullif(F.col("resource_type"), F.lit("")), F.nullif(F.col("upload_type"), F.lit("")), F.lit(""))
    s, n = F.col("subject"), F.concat("subject", F.lit("/0"))
    has = F.coalesce(F.col("title"), F.lit("")) != ""
    return explode_triples(records, DEFAULT_GRAPH, iri(s, TYPE, record_class(kind, class_iris, default_class)), lit(s, LABEL, F.concat(F.lit(url_base), "id")),
                           iri(s, terms.denoted_by, n, has), lit(n, LABEL, F.col("title"), when=has), lit(n, terms.literal_title, F.col("title"), when=has))


# --- views of a source --------------------------------------------------------------------------

def _named_classes(quads: DataFrame) -> DataFrame:
    c = quads.where((F.col("p") == TYPE) & F.col("o").isin(CLASS_TYPES) & (F.col("s_kind") == "iri")).select(F.col("s").alias("c")).distinct()
    return c.join(english_labels(quads, "c", "l"), "c", "left").select("c", label_fallback("l", "c").alias("label"))


def view_classes(quads: DataFrame) -> DataFrame:
    c = F.col("c")
    return explode_triples(_named_classes(quads), "", iri(c, TYPE, OWL + "Class"), lit(c, LABEL, F.col("label"))).drop("graph").distinct()


def view_hierarchy(quads: DataFrame) -> DataFrame:
    sub = quads.where((F.col("p") == SUBCLASS) & (F.col("o_kind") != "literal")).select(F.col("s").alias("c"), F.col("o").alias("parent")).distinct()
    h = _named_classes(quads).join(sub, "c", "left").join(english_labels(quads, "parent", "pl"), "parent", "left")
    h = h.withColumn("pl", F.when(F.col("parent").isNotNull(), label_fallback("pl", "parent")))
    c, p = F.col("c"), F.col("parent")
    pk = F.when(F.startswith("parent", F.lit("_:")), "bnode").otherwise("iri")
    out = explode_triples(h, "", iri(c, TYPE, OWL + "Class"), lit(c, LABEL, F.col("label")), iri(c, SUBCLASS, p), lit(p, LABEL, F.col("pl"), when=p.isNotNull()))
    fix = lambda k, v: F.when(F.startswith(v, F.lit("_:")) & (F.col(k) == "iri"), "bnode").otherwise(F.col(k))
    return out.drop("graph").withColumn("s_kind", fix("s_kind", "s")).withColumn("o_kind", fix("o_kind", "o")).distinct()


SCHEMA_KINDS = CLASS_TYPES + [OWL + "ObjectProperty", OWL + "DatatypeProperty", "http://www.w3.org/1999/02/22-rdf-syntax-ns#Property"]
_PROPERTY_KEEP = [LABEL, TYPE, RDFS + "domain", RDFS + "range", OWL + "equivalentProperty", OWL + "propertyDisjointWith"]
LOCAL_KEEP = {
    OWL + "Class": [LABEL, TYPE, SUBCLASS, OWL + "equivalentClass", OWL + "disjointWith"],
    OWL + "ObjectProperty": [*_PROPERTY_KEEP, OWL + "inverseOf"],
    OWL + "DatatypeProperty": _PROPERTY_KEEP,
}


def view_schema(quads: DataFrame, mode: str = "all") -> DataFrame:
    """Triples of schema subjects: all of them, or (``local``) a list of predicates per kind."""
    t = quads.select(TRIPLE_COLS).distinct()
    if mode == "all":
        return semi(t, t.where((F.col("p") == TYPE) & F.col("o").isin(SCHEMA_KINDS)), "s")
    out = None
    for kind, keep in LOCAL_KEEP.items():
        subj = t.where((F.col("p") == TYPE) & (F.col("o") == kind))
        v = semi(t.where(F.col("p").isin(keep)), subj, "s")
        out = v if out is None else out.unionByName(v)
    return out.distinct()


def recombine(quads: DataFrame, inferences: DataFrame, status: DataFrame, metadata: DataFrame) -> DataFrame:
    """G, G/inferences (consistent graphs only), G/metadata with a link to the inferences, and
    INCONSISTENT notes in the default graph. Asserted data is always kept."""
    ok = status.where("consistent").select("graph")
    inf = inferences.join(ok, "graph", "left_semi").withColumn("graph", F.concat("graph", F.lit("/inferences")))
    meta = metadata.withColumn("graph", F.concat("graph", F.lit("/metadata")))
    have = inferences.select("graph").distinct().join(ok, "graph", "left_semi")
    see = explode_triples(have, F.concat("graph", F.lit("/metadata")), iri(F.col("graph"), SEE_ALSO, F.concat("graph", F.lit("/inferences"))))
    bad = explode_triples(status.where("not consistent"), DEFAULT_GRAPH, lit(F.col("graph"), COMMENT, "INCONSISTENT"))
    out = quads.select(QUAD_COLS)
    for d in (inf, meta, see, bad):
        out = out.unionByName(d.select(QUAD_COLS))
    return out.distinct()


def recombined_sizes(sizes: DataFrame, inferred: DataFrame, status: DataFrame, metadata: DataFrame) -> DataFrame:
    """(graph, n) of what ``recombine`` puts together, from the sizes (graph, n) of the asserted graphs, of which every row counts, and
    of their inferences (graph, inferred): no quad is built or shuffled to be counted."""
    ok = inferred.join(status.where("consistent").select("graph"), "graph", "left_semi").where("inferred > 0")
    one = F.lit(1).cast("bigint").alias("n")
    parts = [sizes.select("graph", "n"), ok.select(F.concat("graph", F.lit("/inferences")).alias("graph"), F.col("inferred").alias("n")),
             metadata.select(QUAD_COLS).distinct().select(F.concat("graph", F.lit("/metadata")).alias("graph"), one),
             ok.select(F.concat("graph", F.lit("/metadata")).alias("graph"), one),
             status.where("not consistent").select(F.lit(DEFAULT_GRAPH).alias("graph"), one)]
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d)
    return out.groupBy("graph").agg(F.sum("n").alias("n"))


def registry_union(quads: DataFrame, meta_graph: str) -> DataFrame:
    """The metadata graph copied into the default graph."""
    copy = quads.where(F.col("graph") == meta_graph).withColumn("graph", F.lit(DEFAULT_GRAPH))
    return quads.unionByName(copy).distinct()


def record_union(quads: DataFrame, files: DataFrame) -> DataFrame:
    """(record, triple): all file graphs of a record as one set. ``files``: graph, record."""
    return quads.join(files.select("graph", "record").distinct(), "graph").select("record", *TRIPLE_COLS).distinct()
