"""The questions asked of the graph, as pattern compositions over quads.

Classes and predicates come in as ``Terms`` or arguments, so the same plan serves any
vocabulary. Results are distinct; capped ones are cut in a total order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kgspark.functions.scalars import literal_datatype, literal_int
from kgspark.model import LABEL, OWL, SEE_ALSO, TERMS, TYPE, VOID, Terms
from kgspark.operators import metrics
from kgspark.operators.closure import is_node
from kgspark.operators.pattern import (
    english_labels, first_combinations, labels, link, not_exists, optional, optional_bound, order_limit, path_chain, semi, typed, union_graph, value, via_node)
from kgspark.session import materialize

CAP = 999


def _done(df: DataFrame, *cols: str, cap: int | None = CAP) -> DataFrame:
    return order_limit(df.select(*cols).distinct(), cap, *cols)


def _nodes(q: DataFrame, t: Terms, a: str, cls: str | None, prop: str, b: str, predicate: str | None = None) -> DataFrame:
    return via_node(q, predicate or t.denoted_by, prop, a, b, cls)


# --- competency questions ---------------------------------------------------------------------

def records(q, cls, part_label=LABEL, link_predicate=SEE_ALSO, t: Terms = TERMS, cap=CAP):
    part = link(q, t.has_part, "record", "part").join(value(q, part_label, "part", "file_label"), "part").join(
        value(q, link_predicate, "part", "doi"), "part")
    out = typed(q, cls, "record").join(labels(q, "record", "record_label"), "record").join(part, "record")
    return _done(out, "record", "record_label", "file_label", "doi", cap=cap)


def digital_objects(q, cls, t: Terms = TERMS, cap=CAP):
    out = typed(q, cls, "object").join(labels(q, "object", "label"), "object").join(
        value(q, t.part_of, "object", "parent"), "object").join(value(q, t.has_url, "object", "url"), "object")
    return _done(out, "object", "label", "parent", "url", cap=cap)


def _nested_label(q, p, a, n, lab):
    return optional(link(q, p, a, n), labels(q, n, lab))


def software(q, cls, publication_cls, repository_cls, t: Terms = TERMS, cap=CAP):
    out = optional(typed(q, cls, "software"), via_node(q, t.denoted_by, LABEL, "software", "label"),
                   _nested_label(q, t.license, "software", "lic", "license"),
                   _nested_label(q, t.language, "software", "lng", "language"),
                   _nodes(q, t, "software", publication_cls, LABEL, "publication"),
                   _nodes(q, t, "software", repository_cls, t.has_url, "repository"))
    return _done(out, "software", "label", "license", "language", "repository", "publication", cap=cap)


def services(q, cls, t: Terms = TERMS, cap=CAP):
    urls = via_node(q, t.subject_of, t.has_url, "service", "service_url").distinct()
    named = _nodes(q, t, "service", t.written_name, LABEL, "label")
    both = [urls.withColumnRenamed("service_url", c) for c in ("doc_url", "code_url")]
    if cap is None:
        return _done(optional(typed(q, cls, "service"), named, urls, *both), "service", "label", "service_url", "doc_url", "code_url", cap=None)
    lists = [(named, "label"), (urls, "service_url"), (both[0], "doc_url"), (both[1], "code_url")]
    return _done(first_combinations(typed(q, cls, "service"), lists, cap), "service", "label", "service_url", "doc_url", "code_url", cap=cap)


def _org_city(q, t):
    return via_node(q, t.located_in, LABEL, "org", "city", t.city)


def organizations(q, t: Terms = TERMS, cap=CAP):
    out = typed(q, t.organization, "org").join(value(q, t.acronym, "org", "acronym"), "org")
    out = optional(out, labels(q, "org", "label"), _org_city(q, t), via_node(q, t.external_id, t.has_url, "org", "registry_id"))
    return _done(out, "org", "label", "acronym", "city", "registry_id", cap=cap)


def people(q, t: Terms = TERMS, cap=CAP):
    out = typed(q, t.person, "person").join(labels(q, "person", "label"), "person")
    out = optional(out, _nodes(q, t, "person", t.email, LABEL, "email"), value(q, t.external_id, "person", "orcid"))
    return _done(out, "person", "label", "email", "orcid", cap=cap)


def events(q, cls, t: Terms = TERMS, cap=CAP):
    """Rows of ``q`` may repeat. All blocks are optional, so every event has a row and the first ``cap`` ones are enough: only nodes
    linked to these, in small stored tables, meet the classes and texts, which are then not shuffled."""
    cols = ["event", "title", "url", "org_label", "consortium_label"]
    if cap is None:
        out = optional(typed(q, cls, "event"), _nodes(q, t, "event", t.title, LABEL, "title"), _nodes(q, t, "event", None, t.has_url, "url"),
                       via_node(q, t.participant, LABEL, "event", "org_label", t.organization),
                       via_node(q, t.participant, LABEL, "event", "consortium_label", t.consortium))
        return _done(out, *cols, cap=None)
    first = materialize(order_limit(typed(q, cls, "event"), cap, "event"), "events")
    linked = q.where(F.col("p").isin(t.denoted_by, t.participant) & is_node()).select(F.col("s").alias("event"), F.col("p").alias("by"), F.col("o").alias("n"))
    linked = materialize(linked.join(first, "event").distinct(), "event_links")
    nodes = linked.select("n").distinct()
    is_type = (F.col("p") == TYPE) & is_node() & F.col("o").isin(t.title, t.organization, t.consortium)
    about = q.where(F.col("p").isin(LABEL, t.has_url) | is_type).select(F.col("s").alias("n"), "p", "o")
    about = materialize(about.join(nodes, "n").distinct(), "event_nodes")

    def block(by: str, prop: str, name: str, node_cls: str | None = None) -> DataFrame:
        out = linked.where(F.col("by") == by).join(about.where(F.col("p") == prop).select("n", F.col("o").alias(name)), "n")
        if node_cls:
            out = semi(out, about.where((F.col("p") == TYPE) & (F.col("o") == node_cls)), "n")
        return out.select("event", name).distinct()

    out = optional(first, block(t.denoted_by, LABEL, "title", t.title), block(t.denoted_by, t.has_url, "url"),
                   block(t.participant, LABEL, "org_label", t.organization), block(t.participant, LABEL, "consortium_label", t.consortium))
    return _done(out, *cols, cap=cap)


def endpoints_about(q, dataset_classes, classes, t: Terms = TERMS):
    part = metrics.declared_partition_counts(q, classes, t)
    urls = via_node(q, t.denoted_by, t.has_url, "dataset", "endpoint").distinct()
    out = typed(q, dataset_classes, "dataset").join(urls, "dataset").join(part, "dataset")
    out = optional(out, labels(q, "dataset", "dataset_name"))
    return _done(out, "dataset", "term_class", "dataset_name", "endpoint", "instances", cap=None)


def datasets(q, t: Terms = TERMS, cap=CAP):
    out = typed(q, t.dataset_classes, "dataset").join(_nodes(q, t, "dataset", t.title, LABEL, "title"), "dataset")
    out = optional(out, via_node(q, t.has_part, LABEL, "dataset", "creator", t.creator_role),
                   via_node(q, t.has_part, LABEL, "dataset", "affiliation", t.institution_list), _nodes(q, t, "dataset", None, t.has_url, "link"))
    return _done(out, "dataset", "title", "creator", "affiliation", "link", cap=cap)


def data_portals(q, cls, t: Terms = TERMS, cap=CAP):
    """The contact block of the question binds nothing that is shown, so it is left out."""
    urls = via_node(q, t.denoted_by, t.has_url, "portal", "link").distinct()
    out = typed(q, cls, "portal").join(_nodes(q, t, "portal", t.title, LABEL, "name"), "portal").join(urls, "portal").join(
        urls.withColumnRenamed("link", "repository"), "portal")
    return _done(out, "portal", "name", "link", "repository", cap=cap)


def instruments(q, cls, t: Terms = TERMS, cap=CAP):
    """Contact block with three inner optionals; the last two share the node of the role."""
    contact = link(q, t.participates_in, "instrument", "cp").join(link(q, t.participant, "cp", "contact"), "cp").join(link(q, t.has_role, "cp", "role"), "cp")
    contact = optional(contact, via_node(q, t.denoted_by, t.has_value, "contact", "contact_name", t.written_name))
    mail = via_node(q, t.denoted_by, t.has_value, "role", "email", t.email, node="node")
    web = via_node(q, t.denoted_by, t.has_url, "role", "website", t.website, node="node")
    contact = optional_bound(optional(contact, mail), web, "role", "node")
    out = optional(typed(q, cls, "instrument"), _nodes(q, t, "instrument", None, LABEL, "name"),
                   contact.select("instrument", "contact_name", "email", "website").distinct())
    return _done(out, "instrument", "name", "contact_name", "email", "website", cap=cap)


def facilities(q, cls, t: Terms = TERMS, cap=CAP):
    org = typed(q, t.organization, "org").join(labels(q, "org", "org_label"), "org")
    role = typed(q, t.provider_role, "role").join(link(q, t.denoted_by, "role", "n"), "role")
    block = link(q, t.output_of, "facility", "proc").join(link(q, t.participant, "proc", "org"), "proc").join(
        link(q, t.has_role, "proc", "role"), "proc").join(org, "org").join(role, "role")
    block = optional(block, typed(q, t.email, "n").join(value(q, t.has_value, "n", "email"), "n"),
                     typed(q, t.website, "n").join(value(q, t.has_url, "n", "website"), "n"))
    out = typed(q, cls, "facility").join(_nodes(q, t, "facility", t.acronym_node, LABEL, "acronym"), "facility")
    out = optional(out, _nodes(q, t, "facility", t.written_name, LABEL, "name"), block.select("facility", "org_label", "email", "website").distinct())
    return _done(out, "facility", "name", "acronym", "org_label", "email", "website", cap=cap)


def named_things(q, cls, out_names: tuple[str, str], name_cls, name_prop=LABEL, url_cls: str | None = None, with_url: bool = False,
                 own_label: bool = False, t: Terms = TERMS, cap=CAP):
    """Shape shared by specifications, ontologies, collaborations, use cases and projects: a
    name behind a typed node, optionally the own label and a URL behind another node."""
    thing, name = out_names
    out, cols = typed(q, cls, thing), [thing]
    if own_label:
        out, cols = optional(out, labels(q, thing, "label")), cols + ["label"]
    out, cols = optional(out, _nodes(q, t, thing, name_cls, name_prop, name)), cols + [name]
    if with_url:
        out, cols = optional(out, _nodes(q, t, thing, url_cls, t.has_url, "repository")), cols + ["repository"]
    return _done(out, *cols, cap=cap)


def publications(q, t: Terms = TERMS, cap=CAP):
    out = optional(typed(q, t.publication_classes, "publication"), labels(q, "publication", "name"),
                   via_node(q, t.external_id, t.has_url, "publication", "doi"), via_node(q, t.has_part, LABEL, "publication", "authors", t.author_list),
                   via_node(q, t.has_part, LABEL, "publication", "affiliations", t.institution_list))
    return _done(out, "publication", "name", "doi", "authors", "affiliations", cap=cap)


def task_areas(q, cls, t: Terms = TERMS, cap=CAP):
    out = typed(q, cls, "area").join(labels(q, "area", "label"), "area").join(_nodes(q, t, "area", t.description, LABEL, "description"), "area")
    return _done(out, "area", "label", "description", cap=cap)


def endpoints(q, cls, dataset_classes, t: Terms = TERMS):
    behind = optional(typed(q, dataset_classes, "dataset").join(link(q, t.denoted_by, "dataset", "endpoint"), "dataset"), labels(q, "dataset", "dataset_label"))
    out = typed(q, cls, "endpoint").join(labels(q, "endpoint", "endpoint_label"), "endpoint").join(value(q, t.has_url, "endpoint", "url"), "endpoint")
    return _done(optional(out, behind), "dataset", "endpoint", "dataset_label", "endpoint_label", "url", cap=None)


# --- questions over two sources -----------------------------------------------------------------

def dataset_links(q, classes, t: Terms = TERMS):
    d = via_node(q, t.denoted_by, t.has_url, "dataset", "link")
    return (d if classes is None else d.join(typed(q, classes, "dataset"), "dataset")).distinct()


def federated_samples(q, other, classes, sample_cls, constants: list[tuple[str, str]], property_path: str, unit: str, doi: str, t: Terms = TERMS):
    """Samples of a second source with fixed constants, joined on equal text of link and DOI."""
    s = typed(other, sample_cls, "sample")
    for p, v in constants:
        s = s.join(other.where((F.col("p") == p) & (F.col("o") == v)).select(F.col("s").alias("sample")).distinct(), "sample")
    s = s.join(value(other, property_path, "sample", "amount"), "sample").join(value(other, unit, "sample", "unit"), "sample").join(
        value(other, doi, "sample", "link"), "sample")
    return _done(dataset_links(q, classes, t).join(s, "link"), "amount", "dataset", "link", "sample", "unit", cap=None)


def federated_creators(q, other, amount, doi, t: Terms = TERMS):
    d = optional(dataset_links(q, None, t), via_node(q, t.has_part, LABEL, "dataset", "creator", t.creator_role),
                 via_node(q, t.has_part, LABEL, "dataset", "affiliation", t.institution_list))
    s = value(other, doi, "sample", "link").join(value(other, amount, "sample", "amount"), "sample").select("link", "amount").distinct()
    return _done(d.join(s, "link"), "dataset", "creator", "affiliation", "amount", cap=None)


def federated_elements(q, other, element, doi, t: Terms = TERMS):
    s = value(other, doi, "sample", "link").join(value(other, element, "sample", "element"), "sample").select("link", "element").distinct()
    return _done(dataset_links(q, None, t).join(s, "link"), "dataset", "element", cap=None)


def federated_orgs(q, other, registry, country, t: Terms = TERMS, cap=100):
    """Organisations matched on the identifier cut out of their registry URL."""
    o = typed(q, t.organization, "org").join(via_node(q, t.external_id, t.has_url, "org", "url"), "org")
    o = optional(o, labels(q, "org", "label"), value(q, t.acronym, "org", "acronym"), _org_city(q, t))
    o = o.withColumn("key", F.regexp_replace("url", "^.*/", ""))
    ext = value(other, registry, "ext", "key")
    en = lambda a, b: value(other, LABEL, a, b, cond=F.col("o_lang") == "en")
    ext = optional(ext, en("ext", "ext_label"), link(other, country, "ext", "c").join(en("c", "country"), "c").drop("c"))
    return _done(o.join(ext, "key"), "org", "label", "acronym", "city", "url", "ext", "ext_label", "country", cap=cap)


def federated_people(q, other, identifier, employer, country, marker, strip, t: Terms = TERMS, cap=100):
    p = typed(q, t.person, "person").join(value(q, t.external_id, "person", "url"), "person")
    p = optional(p.where(F.lower("url").contains(marker)), labels(q, "person", "label"))
    p = p.withColumn("key", F.regexp_replace(F.regexp_replace("url", strip, ""), "/$", ""))
    en = lambda a, b: value(other, LABEL, a, b, cond=F.col("o_lang") == "en")
    ext = value(other, identifier, "ext", "key")
    ext = optional(ext, en("ext", "ext_label"), link(other, employer, "ext", "e").join(en("e", "employer"), "e").drop("e"),
                   link(other, country, "ext", "c").join(en("c", "country"), "c").drop("c"))
    return _done(p.join(ext, "key"), "person", "label", "url", "key", "ext", "ext_label", "employer", "country", cap=cap)


# --- statistics over the union graph --------------------------------------------------------------

def concepts(q, cap=CAP):
    c = q.where((F.col("p") == TYPE)).select(F.col("o").alias("concept")).distinct()
    return _done(optional(c, english_labels(q, "concept", "label", of=metrics.classes_in_use(q, "concept"))), "concept", "label", cap=cap)


def entities_per_concept(q, cap=CAP):
    """Grouped by concept and label: a concept with several labels has a row for each."""
    n = union_graph(q).where(F.col("p") == TYPE).groupBy(F.col("o").alias("concept")).agg(F.count(F.lit(1)).alias("count"))
    return order_limit(optional(n, english_labels(q, "concept", "label", of=metrics.classes_in_use(q, "concept"))).select("concept", "label", "count"), cap, "-count", "concept", "label")


def count_distinct(q, column: str, name: str, cond=None):
    d = q if cond is None else q.where(cond)
    return d.select(column).distinct().agg(F.count(F.lit(1)).alias(name))


def top_properties(q, cap=10):
    n = union_graph(q).groupBy(F.col("p").alias("property")).agg(F.count(F.lit(1)).alias("count"))
    return order_limit(optional(n, english_labels(q, "property", "label", of=q.select(F.col("p").alias("property")))).select("property", "label", "count"), cap, "-count", "property", "label")


def out_degree(q, cap=10):
    n = union_graph(q).groupBy("s").agg(F.count(F.lit(1)).alias("out_degree"))
    return order_limit(n, cap, "-out_degree", "s")


def subjects_without(q, predicate: str, name: str):
    """Subjects reduced to one flag each; no anti join of the graph with itself."""
    has = q.groupBy("s").agg(F.max((F.col("p") == predicate).cast("int")).alias("has"))
    return has.agg(F.count_if(F.col("has") == 0).alias(name))


def triples_where(q, cond, name: str):
    return union_graph(q.where(cond)).agg(F.count(F.lit(1)).alias(name))


def languages(q):
    t = union_graph(q.where((F.col("o_kind") == "literal") & (F.col("o_lang") != "")))
    return t.groupBy(F.col("o_lang").alias("lang")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "lang")


def datatypes(q):
    t = union_graph(q.where(F.col("o_kind") == "literal"))
    return t.groupBy(literal_datatype().alias("datatype")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "datatype")


def unused_classes(q):
    t = q.where(F.col("p") == TYPE)
    c = t.where(F.col("o") == OWL + "Class").select(F.col("s").alias("class")).distinct()
    free = not_exists(c, t.select(F.col("o").alias("class")), on=["class"])
    return optional(free, labels(q, "class", "label")).select("class", "label").distinct()


def external_links(q, own: str):
    return count_distinct(q, "o", "external_links", is_node() & F.col("o").rlike("^https?://") & ~F.col("o").startswith(own))


# --- questions about named graphs ------------------------------------------------------------------

def graph_descriptions(q, graph_cls, description_cls=None, t: Terms = TERMS):
    d = via_node(q, t.denoted_by, t.has_value, "graph", "description", description_cls or t.description)
    return _done(typed(q, graph_cls, "graph").join(d, "graph"), "graph", "description", cap=None)


def graph_times(q, graph_cls, t: Terms = TERMS):
    q = q.drop("graph")
    reg = typed(q, graph_cls, "graph").join(link(q, t.output_of, "graph", "proc"), "graph").join(link(q, t.occupies, "proc", "reg"), "proc")
    begin = path_chain(reg, q, "reg", (t.first_instant, "b"), (t.timestamp, "begin")).select("graph", "reg", "begin")
    end = link(q, t.last_instant, "reg", "e").join(value(q, t.timestamp, "e", "end"), "e").select("reg", "end")
    return _done(begin.join(end, "reg"), "graph", "begin", "end", cap=None).orderBy(F.desc("begin"), "graph", "end")


def file_graphs(q, cap=CAP, t: Terms = TERMS):
    q = q.drop("graph")
    out = typed(q, t.file, "file_graph").join(value(q, t.part_of, "file_graph", "record"), "file_graph")
    return order_limit(optional(out, labels(q, "file_graph", "label")).select("file_graph", "label", "record").distinct(), cap, "record", "file_graph")


def file_graph_triples(meta, quads, cap=CAP, t: Terms = TERMS):
    """Graph names found in the registry, then the triples of those graphs. Graphs are counted
    first, so the join meets one row per graph."""
    files = typed(meta, t.file, "file_graph").join(value(meta, t.part_of, "file_graph", "record"), "file_graph").select(F.col("file_graph").alias("graph"))
    n = quads.groupBy("graph").agg(F.count(F.lit(1)).alias("n"))
    # a file listed under several records joins once per record, as the pattern says
    out = files.join(n, "graph").groupBy(F.col("graph").alias("file_graph")).agg(F.sum("n").alias("triples"))
    return order_limit(out, cap, "-triples", "file_graph")


def files_per_record(q, cap=CAP, t: Terms = TERMS):
    q = q.drop("graph")
    p = typed(q, t.file, "f").join(value(q, t.part_of, "f", "record"), "f").select("record", "f").distinct()
    return order_limit(p.groupBy("record").agg(F.count(F.lit(1)).alias("files")), cap, "-files", "record")


def file_downloads(q, cap=CAP, t: Terms = TERMS):
    q = q.drop("graph")
    out = typed(q, t.file, "file_graph").join(value(q, t.part_of, "file_graph", "record"), "file_graph").join(value(q, t.has_url, "file_graph", "url"), "file_graph")
    return order_limit(out.select("record", "file_graph", "url").distinct(), cap, "record", "file_graph")


def file_descriptions(q, label: str = "description", description_cls=None, cap=CAP, t: Terms = TERMS):
    q = q.drop("graph")
    named = q.where((F.col("p") == LABEL) & (F.col("o") == label) & (F.col("o_kind") == "literal") & (F.col("o_lang") == "")).select(F.col("s").alias("d")).distinct()
    desc = typed(q, description_cls or t.description, "d").join(named, "d").join(value(q, t.has_value, "d", "description"), "d")
    out = typed(q, t.file, "file_graph").join(value(q, t.part_of, "file_graph", "record"), "file_graph").join(link(q, t.denoted_by, "file_graph", "d"), "file_graph").join(desc, "d")
    out = optional(out, labels(q, "file_graph", "label"))
    return order_limit(out.select("record", "file_graph", "label", "description").distinct(), cap, "record", "file_graph")


def harvest_times(q, cap=CAP, t: Terms = TERMS):
    q = q.drop("graph")
    out = path_chain(typed(q, t.file, "file_graph"), q, "file_graph", (t.output_of, "p"), (t.occupies, "r"), (t.first_instant, "i"), (t.timestamp, "harvested_at"))
    return order_limit(out.select("file_graph", "harvested_at").distinct(), cap, "-harvested_at", "file_graph")


def class_partitions(q, t: Terms = TERMS):
    """Partitions a graph states about itself."""
    q = q.drop("graph")
    out = link(q, VOID + "classPartition", "dataset", "cp").join(value(q, VOID + "class", "cp", "class"), "cp").join(value(q, VOID + "entities", "cp", "n"), "cp")
    return out.select("dataset", "class", literal_int("n", None).alias("entities")).distinct()


def registered_from(q, url_predicate: str, version_predicate: str, url: str | None = None):
    g = q.drop("graph")
    out = value(g, url_predicate, "file_graph", "url")
    if url:
        out = out.where(F.col("url") == url)
    return optional(out, value(g, version_predicate, "file_graph", "version")).select("file_graph", "url", "version").distinct()


def producers(q, produces: str, t: Terms = TERMS):
    """(artefact, step, label): the step an artefact comes from."""
    return link(q, produces, "artefact", "step").join(labels(q, "step", "label"), "step").select("artefact", "step", "label").distinct()
