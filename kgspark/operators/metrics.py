"""Metric tables, graph statistics, construct counts, VoID figures.

Every figure is computed for all graphs in one job with ``graph`` as a key. Counts of
distinct values shuffle on (graph, value), never on the graph alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kgspark.functions.scalars import english, label_fallback, literal_int, namespace
from kgspark.model import OWL, RDF, RDFS, TERMS, TYPE, Terms
from kgspark.operators.pattern import (
    english_labels, first_combinations, link, not_exists, optional, order_limit, sample_labels, semi, top_n, typed, value)
from kgspark.session import materialize

CLASS_TYPES = [OWL + "Class", RDFS + "Class"]
PROPERTY_TYPES = [RDF + "Property", OWL + "ObjectProperty", OWL + "DatatypeProperty", OWL + "AnnotationProperty"]


def n_rows() -> Column:
    return F.count(F.lit(1))


def if_set(cond: Column, val) -> Column:
    return F.when(cond, F.col(val) if isinstance(val, str) else val)


def list_graphs(quads: DataFrame, prefix: str, limit: int = 2000) -> DataFrame:
    """Named graphs of a prefix in order; none at all is an error, because every metric would be empty."""
    found = quads.where(F.col("graph").startswith(prefix)).select("graph")
    if found.isEmpty():
        raise ValueError(f"no named graph begins with {prefix}")
    return order_limit(found.distinct(), limit, "graph")


def graph_sizes(quads: DataFrame) -> DataFrame:
    per_subject = quads.groupBy("graph", "s").agg(n_rows().alias("n"))
    return per_subject.groupBy("graph").agg(F.sum("n").alias("triples"), n_rows().alias("subjects"))


def instance_counts(quads: DataFrame) -> DataFrame:
    """(graph, class, n): the base shared by the class, entity and top-concept metrics."""
    return quads.where(F.col("p") == TYPE).groupBy("graph", F.col("o").alias("class_iri")).agg(n_rows().alias("n"))


def classes_in_use(quads: DataFrame, name: str) -> DataFrame:
    return quads.where(F.col("p") == TYPE).select(F.col("o").alias(name)).distinct()


def class_counts(quads: DataFrame, all_quads: DataFrame, limit: int | None = 200) -> DataFrame:
    """Instances per class with one English label. Counted before labels are joined, so a
    class with several labels is not counted several times."""
    base = instance_counts(quads)
    if limit:
        base = top_n(base, limit, ["graph"], ["-n", "class_iri"])
    return optional(base, sample_labels(all_quads, "class_iri", "class_label", of=classes_in_use(quads, "class_iri"))).select(
        "graph", "class_iri", "class_label", F.col("n").alias("instances"))


def property_counts(quads: DataFrame, limit: int = 100) -> DataFrame:
    base = quads.groupBy("graph", F.col("p").alias("property_iri")).agg(n_rows().alias("usage_count"))
    return top_n(base, limit, ["graph"], ["-usage_count", "property_iri"])


def class_property_flow(quads: DataFrame, all_quads: DataFrame, limit: int = 300) -> DataFrame:
    """Property usage of the members of each class, by label. A subject's triples are first
    counted per predicate, so a subject with very many triples joins as a few rows."""
    types = quads.where(F.col("p") == TYPE).select("graph", "s", F.col("o").alias("source_iri"))
    used = quads.where(F.col("p") != TYPE).groupBy("graph", "s", F.col("p").alias("target_iri")).agg(
        n_rows().alias("n"))
    flow = types.join(used, ["graph", "s"]).groupBy("graph", "source_iri", "target_iri").agg(
        F.sum("n").alias("value"))
    flow = optional(flow, english_labels(all_quads, "source_iri", "sl", of=classes_in_use(quads, "source_iri")),
                    english_labels(all_quads, "target_iri", "tl", of=quads.select(F.col("p").alias("target_iri"))))
    flow = flow.select("graph", "source_iri", F.coalesce("sl", "source_iri").alias("source_label"), "target_iri",
                       F.coalesce("tl", "target_iri").alias("target_label"), "value")
    return top_n(flow, limit, ["graph"], ["-value", "source_iri", "target_iri", "source_label", "target_label"])


def entity_type_counts(quads: DataFrame, all_quads: DataFrame, limit: int = 500) -> DataFrame:
    return class_counts(quads, all_quads, limit).toDF("graph", "concept_iri", "concept_label", "count")


def dataset_type_counts(quads: DataFrame, all_quads: DataFrame, terms: Terms = TERMS) -> DataFrame:
    hit = quads.where((F.col("p") != TYPE) | F.col("o").isin(list(terms.dataset_classes)))
    return class_counts(hit, all_quads, None).toDF("graph", "dataset_type_iri", "dataset_type_label", "count")


def top_concepts(quads: DataFrame, all_quads: DataFrame, n: int = 10) -> DataFrame:
    ranked = top_n(instance_counts(quads), n, ["graph"], ["-n", "class_iri"], rank="rank")
    return optional(ranked, sample_labels(all_quads, "class_iri", "label", of=classes_in_use(quads, "class_iri"))).select(
        "graph", F.col("class_iri").alias("concept_iri"), F.coalesce("label", "class_iri").alias("concept_label"),
        F.col("n").alias("count"), F.col("rank").cast("bigint").alias("rank"))


def content_counts(quads: DataFrame, terms: Terms = TERMS) -> DataFrame:
    """Distinct datasets, publications and events of every graph, in one pass: each subject
    is reduced to three flags first."""
    is_type = F.col("p") == TYPE
    flag = lambda classes: F.max(F.when(is_type & F.col("o").isin(list(classes)), 1).otherwise(0))
    per_s = quads.groupBy("graph", "s").agg(
        flag(terms.dataset_classes).alias("d"), flag(terms.publication_classes).alias("u"),
        flag([terms.event]).alias("e"))
    return per_s.groupBy("graph").agg(F.sum("d").alias("datasets"), F.sum("u").alias("publications"),
                                      F.sum("e").alias("events"))


def dataset_titles(quads: DataFrame, terms: Terms = TERMS, of: DataFrame | None = None) -> DataFrame:
    """(graph, dataset, title): title node, else literal title, else label; on request only ``of`` some (graph, dataset)."""
    ds = typed(quads, terms.dataset_classes, "dataset", "graph") if of is None else of
    title_node = link(quads, terms.denoted_by, "dataset", "n", "graph").join(
        typed(quads, terms.title, "n", "graph"), ["graph", "n"]).join(
        value(quads, RDFS + "label", "n", "node_title", "graph"), ["graph", "n"]).drop("n")
    out = optional(ds, title_node, value(quads, terms.literal_title, "dataset", "lit_title", "graph"),
                   value(quads, RDFS + "label", "dataset", "label_title", "graph"))
    return out.select("graph", "dataset", F.coalesce("node_title", "lit_title", "label_title").alias("title"))


def dataset_list(quads: DataFrame, limit: int = 500, terms: Terms = TERMS) -> DataFrame:
    """All optional combinations per dataset; creator and affiliation read the same predicate."""
    first = top_n(typed(quads, terms.dataset_classes, "dataset", "graph").distinct(), limit, ["graph"], ["dataset"])
    base = dataset_titles(quads, terms, of=first)
    part = link(quads, terms.has_part, "dataset", "n", "graph").join(
        value(quads, RDFS + "label", "n", "creator", "graph"), ["graph", "n"]).drop("n")
    links = link(quads, terms.denoted_by, "dataset", "n", "graph").join(
        value(quads, terms.has_url, "n", "link", "graph"), ["graph", "n"]).drop("n")
    lists = [(part, "creator"), (part.withColumnRenamed("creator", "creator_affiliation"), "creator_affiliation"), (links, "link")]
    return first_combinations(base, lists, limit, ["graph"]).withColumnRenamed("dataset", "dataset_iri")


def _members_per_target(quads, all_quads, member_cls, p, target_cls, names, limit) -> DataFrame:
    key, lab, cnt = names
    pairs = link(quads, p, "m", key, "graph").distinct()
    pairs = semi(pairs, typed(quads, member_cls, "m", "graph"), ["graph", "m"])
    # pairs are distinct, so a plain (partially aggregated) count is the distinct count
    counts = pairs.groupBy("graph", key).agg(n_rows().alias(cnt))
    counts = semi(counts, typed(quads, target_cls, key, "graph"), ["graph", key])
    out = top_n(counts, limit, ["graph"], ["-" + cnt, key])
    inside = quads.where((F.col("p") == RDFS + "label") & english("o_lang")).groupBy(
        "graph", F.col("s").alias(key)).agg(F.min("o").alias(lab))
    return out.join(inside, ["graph", key], "left").select("graph", key, lab, cnt)


def orgs_by_city(quads: DataFrame, limit: int = 200, terms: Terms = TERMS) -> DataFrame:
    return _members_per_target(quads, quads, terms.organization, terms.located_in, terms.city,
                               ("city_iri", "city_label", "org_count"), limit)


def orgs_by_people(quads: DataFrame, limit: int = 50, terms: Terms = TERMS, predicate: str | None = None) -> DataFrame:
    return _members_per_target(quads, quads, terms.person, predicate or terms.participates_in, terms.organization,
                               ("org_iri", "org_label", "people_count"), limit)


# --- statistics --------------------------------------------------------------------------

def _hashed(v: Column) -> Column:
    return F.when(v.isNotNull(), F.struct(F.xxhash64(v).alias("x"), F.xxhash64(F.lit("2nd"), v).alias("y")))


def _per_subject(quads: DataFrame, **flags: Column) -> DataFrame:
    """(graph, triples, subjects, flags..) from one row per subject: no shuffle where quads lie bucketed by subject.
    A flag is added up over the triples."""
    one = quads.groupBy("graph", "s").agg(n_rows().alias("n"), *[F.count_if(c).alias(k) for k, c in flags.items()])
    return one.groupBy("graph").agg(F.sum("n").alias("triples"), n_rows().alias("subjects"), *[F.sum(k).alias(k) for k in flags])


def _distinct_terms(quads: DataFrame, value: Column, **flags: Column) -> DataFrame:
    """(graph, terms, flags..): distinct values per graph, and how many of them have a flag on any row. A value is shuffled
    once, as its 128-bit hash."""
    one = quads.select("graph", _hashed(value).alias("v"), *[c.alias(k) for k, c in flags.items()]).where("v is not null")
    one = one.groupBy("graph", "v").agg(*[F.max(k).alias(k) for k in flags]) if flags else one.distinct()
    return one.groupBy("graph").agg(n_rows().alias("terms"), *[F.count_if(k).alias(k) for k in flags])


def term_key() -> Column:
    """Identity of an object term: text, kind, datatype and tag."""
    return F.concat_ws("\u0001", "o_kind", F.coalesce("o_datatype", F.lit("")), "o_lang", "o")


def rdf_stats(quads: DataFrame) -> DataFrame:
    is_type = F.col("p") == TYPE
    preds = quads.select("graph", "p").distinct().groupBy("graph").agg(n_rows().alias("predicates"))
    objects = _distinct_terms(quads, term_key(), distinct_type_objects=is_type).withColumnRenamed("terms", "objects")
    return _per_subject(quads, type_assertions=is_type).join(preds, "graph").join(objects, "graph").select(
        "graph", "triples", "subjects", "predicates", "objects", "type_assertions", "distinct_type_objects")


def void_stats(quads: DataFrame) -> DataFrame:
    preds = quads.select("graph", "p").distinct().groupBy("graph").agg(n_rows().alias("predicates"))
    classes = quads.where((F.col("p") == TYPE) & (F.col("o_kind") == "iri")).select("graph", "o").distinct().groupBy("graph").agg(n_rows().alias("classes"))
    return _per_subject(quads).join(preds, "graph").join(classes, "graph", "left").select(
        "graph", "triples", "subjects", "predicates", F.coalesce("classes", F.lit(0)).alias("classes"))


def void_partitions(quads: DataFrame, top: int = 20) -> DataFrame:
    """Top classes and predicates per graph: (graph, kind, iri, count, rank)."""
    cls = quads.where((F.col("p") == TYPE) & (F.col("o_kind") == "iri")).groupBy(
        "graph", F.lit("class").alias("kind"), F.col("o").alias("iri")).agg(n_rows().alias("count"))
    prp = quads.groupBy("graph", F.lit("property").alias("kind"), F.col("p").alias("iri")).agg(n_rows().alias("count"))
    out = top_n(cls.unionByName(prp), top, ["graph", "kind"], ["-count", "iri"], rank="rank")
    return out.withColumn("rank", F.col("rank").cast("bigint"))


def schema_nodes(triples: DataFrame) -> DataFrame:
    return triples.where((F.col("p") == TYPE) & F.col("o").isin(CLASS_TYPES + PROPERTY_TYPES)).select("s").distinct()


def individuals(triples: DataFrame) -> DataFrame:
    return not_exists(triples.where(F.col("p") == TYPE).select("s").distinct(), schema_nodes(triples), on=["s"])


def kg_stats(triples: DataFrame) -> DataFrame:
    """The nine whole-graph figures as (metric, value), one row each.

    Figures of subjects come from one row per subject. Objects that are nodes meet subjects and predicates by the
    hash of their text, literals are counted by theirs: one shuffled row per triple, and one per subject.
    """
    is_type, literal = F.col("p") == TYPE, F.col("o_kind") == "literal"
    a_class, a_property = is_type & F.col("o").isin(CLASS_TYPES), is_type & F.col("o").isin(PROPERTY_TYPES)
    per_s = triples.groupBy("s").agg(n_rows().alias("n"), F.count_if(literal).alias("literals"), F.max(is_type).alias("typed"),
                                     F.max(a_class).alias("cls"), F.max(a_property).alias("prop"))
    subjects = per_s.agg(F.sum("n"), n_rows(), F.sum("literals"), F.count_if("cls"), F.count_if("prop"), F.count_if(F.col("typed") & ~F.col("cls") & ~F.col("prop")))
    subjects = subjects.toDF("triples", "num_subjects", "num_literals", "num_classes", "num_properties", "num_individuals")
    side = lambda v, node: F.struct(_hashed(v).alias("v"), F.lit(node).alias("node"))
    # nodes apart from literals: the same text may be both (an IRI and a blank node never share theirs)
    terms = triples.select(F.when(literal, side(term_key(), False)).otherwise(side(F.col("o"), True)).alias("x"), F.lit(True).alias("object"))
    names = per_s.select(side(F.col("s"), True).alias("x"), F.lit(False).alias("object")).unionByName(
        triples.select("p").distinct().select(side(F.col("p"), True).alias("x"), F.lit(False).alias("object")))
    met = terms.unionByName(names).groupBy("x").agg(F.max("object").alias("object"))
    met = met.agg(F.count_if("object").alias("num_objects"), F.count_if(F.col("x.node")).alias("num_resources"))
    preds = triples.select("p").distinct().agg(n_rows().alias("num_predicates"))
    rows = [d.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("value")) for c in d.columns]))) for d in (subjects, met, preds)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


METRIC_ORDER = ["triples", "num_subjects", "num_predicates", "num_objects", "num_literals", "num_resources",
                "num_classes", "num_properties", "num_individuals"]


def compare(left: DataFrame, right: DataFrame, order: list[str] = METRIC_ORDER, key: str = "metric") -> DataFrame:
    """Two (metric, value) tables side by side in a fixed order."""
    a = left.select(key, F.col("value").alias("left_value"))
    b = right.select(key, F.col("value").alias("right_value"))
    pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col(key)).cast("bigint")
    out = a.join(b, key, "full_outer").select(
        pos.alias("position"), key, F.coalesce("left_value", F.lit(0)).alias("left_value"),
        F.coalesce("right_value", F.lit(0)).alias("right_value"))
    return out.orderBy("position", key)


def type_counter(triples: DataFrame, n: int | None = 25) -> DataFrame:
    """Types of individuals, most common first."""
    t = semi(triples.where(F.col("p") == TYPE).select("s", F.col("o").alias("term")), individuals(triples), "s")
    return order_limit(t.groupBy("term").agg(n_rows().alias("count")), n, "-count", "term")


def predicate_counter(triples: DataFrame, n: int | None = 25) -> DataFrame:
    return order_limit(triples.groupBy(F.col("p").alias("term")).agg(n_rows().alias("count")), n, "-count", "term")


# --- construct counts ----------------------------------------------------------------------
# A measure is a set of single-triple patterns (predicate, or type object) plus named
# counts that need a second triple. A registry of measures: name -> what is added up.

_NODE, _LITERAL = "node", "literal"
CONSTRUCTS: dict[str, dict] = {
    "ROLE_INVERSE": {"p": ["inverseOf"], "t": ["SymmetricProperty", "InverseFunctionalProperty"]},
    "D": {"p": ["datatypeComplementOf", "onDatatype"], "t": ["DatatypeProperty"], "value": _LITERAL, "one_of": _LITERAL},
    "CONCEPT_INTERSECTION": {"p": ["intersectionOf"]},
    "CONCEPT_UNION": {"p": ["unionOf", "differentFrom", "disjointUnionOf"], "t": ["AllDifferent"], "one_of": _NODE},
    "CONCEPT_COMPLEX_NEGATION": {"p": ["complementOf", "disjointWith", "differentFrom", "disjointUnionOf"],
                                 "t": ["AllDisjointClasses", "AllDifferent"]},
    "FULL_EXISTENTIAL": {"some": "not_thing", "value": _NODE},
    "LIMITED_EXISTENTIAL": {"some": "thing"},
    "UNIVERSAL_RESTRICTION": {"p": ["allValuesFrom"]},
    "NOMINALS": {"p": ["differentFrom", "sameAs"], "t": ["AllDifferent"], "value": _NODE, "one_of": _NODE},
    "Q": {"card": "qualified"},
    "N": {"p": ["minCardinality", "cardinality", "maxCardinality"], "card": "top"},
    "ROLE_COMPLEX": {"p": ["hasSelf", "propertyDisjointWith"],
                     "t": ["AsymmetricProperty", "AllDisjointProperties", "IrreflexiveProperty"]},
    "ROLE_REFLEXIVITY_CHAINS": {"p": ["propertyChainAxiom"], "t": ["ReflexiveProperty"]},
    "ROLE_DOMAIN_RANGE": {"rdfs": ["domain", "range"]},
    "ROLE_HIERARCHY": {"p": ["equivalentProperty"], "rdfs": ["subPropertyOf"]},
    "F": {"t": ["FunctionalProperty", "InverseFunctionalProperty"]},
    "ROLE_TRANSITIVE": {"t": ["TransitiveProperty"]},
}
QUALIFIED = ["minQualifiedCardinality", "qualifiedCardinality", "maxQualifiedCardinality"]


def dl_constructs(triples: DataFrame, measures: dict[str, dict] = CONSTRUCTS) -> DataFrame:
    """(construct, count). All single-triple patterns are summed in one pass."""
    p, o, is_lit = F.col("p"), F.col("o"), F.col("o_kind") == "literal"
    # literal heads and node heads of enumerated lists, one per (owner, list) pair
    lists = triples.where(p == OWL + "oneOf").select(F.col("o").alias("l"))
    heads = triples.where(p == RDF + "first").select(F.col("s").alias("l"), is_lit.alias("lit"))
    one_of = lists.join(heads, "l").agg(F.count_if("lit").alias(_LITERAL), F.count_if(~F.col("lit")).alias(_NODE))
    # qualified cardinalities: by what the restriction is qualified with
    per_r = triples.where(p.isin([OWL + "onClass", OWL + "onDataRange"])).groupBy("s").agg(
        F.max(F.when((p == OWL + "onClass") & (o == OWL + "Thing"), 1).otherwise(0)).alias("top_c"),
        F.max(F.when((p == OWL + "onDataRange") & (o == RDFS + "Literal"), 1).otherwise(0)).alias("top_d"),
        F.max(F.when(p == OWL + "onClass", 1).otherwise(0)).alias("any_c"),
        F.max(F.when(p == OWL + "onDataRange", 1).otherwise(0)).alias("any_d"))
    card = triples.where(p.isin([OWL + q for q in QUALIFIED])).select("s").join(per_r, "s").agg(
        F.count_if(F.expr("(any_c = 1 and top_c = 0) or (any_d = 1 and top_d = 0)")).alias("qualified"),
        F.count_if(F.expr("top_c = 1 or top_d = 1")).alias("top"))

    def single(m: dict) -> Column:
        hit = F.lit(False)
        if m.get("p") or m.get("rdfs"):
            hit = hit | p.isin([OWL + x for x in m.get("p", [])] + [RDFS + x for x in m.get("rdfs", [])])
        if m.get("t"):
            hit = hit | ((p == TYPE) & o.isin([OWL + x for x in m["t"]]))
        if m.get("value"):
            hit = hit | ((p == OWL + "hasValue") & (is_lit if m["value"] == _LITERAL else ~is_lit))
        if m.get("some"):
            thing = o == OWL + "Thing"
            hit = hit | ((p == OWL + "someValuesFrom") & (thing if m["some"] == "thing" else ~thing))
        return F.count_if(hit)

    def rows(df: DataFrame, picks: list[tuple[str, str]]) -> DataFrame:
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(k).alias("construct"), F.col(c).alias("n")) for k, c in picks])))

    sums = triples.agg(*[single(m).alias(k) for k, m in measures.items()])
    parts = rows(sums, [(k, k) for k in measures])
    parts = parts.unionByName(rows(one_of, [(k, m["one_of"]) for k, m in measures.items() if "one_of" in m]))
    parts = parts.unionByName(rows(card, [(k, m["card"]) for k, m in measures.items() if "card" in m]))
    return parts.groupBy("construct").agg(F.sum("n").alias("count"))


# --- endpoint and record views of a source -------------------------------------------------

def local_counts(quads: DataFrame) -> DataFrame:
    """Per graph: IRI classes, object and data properties, distinct typed IRI subjects. From one row per subject."""
    typed_iris = quads.where((F.col("p") == TYPE) & (F.col("s_kind") == "iri"))
    kinds = {"classes": "Class", "object_properties": "ObjectProperty", "data_properties": "DatatypeProperty"}
    one = typed_iris.groupBy("graph", "s").agg(*[F.max(F.col("o") == OWL + k).alias(name) for name, k in kinds.items()])
    return one.groupBy("graph").agg(*[F.count_if(name).alias(name) for name in kinds], n_rows().alias("instances"))


def endpoint_counts(quads: DataFrame) -> DataFrame:
    """Declared counts per source graph; a zero count is replaced by one read from usage. Repeated quads count once.

    Predicates in use and declared classes are read once and stored; types meet declarations only in graphs that declare
    a class, and what is counted is shuffled as hashes.
    """
    is_type = F.col("p") == TYPE
    s_iri, o_iri = F.col("s_kind") == "iri", F.col("o_kind") == "iri"
    declared = materialize(quads.where(is_type & F.col("o").isin(CLASS_TYPES)).select("graph", F.col("s").alias("o")).distinct(), "declared")
    declaring = materialize(declared.select("graph").distinct(), "declaring")
    uses = materialize(quads.groupBy("graph", F.col("p").alias("s")).agg(
        F.max(o_iri.cast("int")).alias("obj"), F.max((F.col("o_kind") == "literal").cast("int")).alias("dat")), "uses")
    generic = quads.where(is_type & (F.col("o") == RDF + "Property")).select("graph", "s").distinct().join(
        uses, ["graph", "s"])
    own = quads.where(is_type)
    rows = [
        ("classes", own.where(F.col("o").isin(CLASS_TYPES) & s_iri).select("graph", "s")),
        ("object_properties", own.where(F.col("o") == OWL + "ObjectProperty").select("graph", "s").unionByName(
            generic.where("obj = 1").select("graph", "s"))),
        ("data_properties", own.where(F.col("o") == OWL + "DatatypeProperty").select("graph", "s").unionByName(
            generic.where("dat = 1").select("graph", "s"))),
        ("instances", own.where(s_iri).select("graph", "s", "o").join(declaring, "graph", "left_semi").join(
            declared, ["graph", "o"], "left_semi").select("graph", "s")),
        ("f_classes", own.where(o_iri).select("graph", F.col("o").alias("s"))),
        ("f_object_properties", uses.where((F.col("obj") == 1) & (F.col("s") != TYPE)).select("graph", "s")),
        ("f_data_properties", uses.where("dat = 1").select("graph", "s")),
        ("f_instances", own.where(s_iri & o_iri).select("graph", "s")),
    ]
    tagged = [d.select("graph", F.lit(k).alias("which"), _hashed(F.col("s")).alias("s")) for k, d in rows]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    n = out.distinct().groupBy("graph").agg(*[F.count_if(F.col("which") == k).alias(k) for k, _ in rows])
    graphs = uses.select("graph").distinct()
    n = graphs.join(n, "graph", "left")
    names = ["classes", "object_properties", "data_properties", "instances"]
    return n.select("graph", *[F.coalesce(F.nullif(F.col(c), F.lit(0)), F.col("f_" + c), F.lit(0)).alias(c) for c in names])


def instances_per_class(quads: DataFrame) -> DataFrame:
    """Distinct IRI instances per class and source; sources that declare no class use the
    classes found in use. Label by the fallback rule, smallest wins."""
    types = quads.where(F.col("p") == TYPE)
    one = types.where(F.col("s_kind") == "iri").groupBy("graph", F.col("o").alias("class_iri"), _hashed(F.col("s")).alias("s")).agg(
        F.max(F.col("o_kind") == "iri").alias("iri"))
    per = materialize(one.groupBy("graph", "class_iri").agg(n_rows().alias("n"), F.count_if("iri").alias("used")), "per_class")
    declared = materialize(types.where(F.col("o").isin(CLASS_TYPES)).select("graph", F.col("s").alias("class_iri")).distinct(), "declared")
    main = per.join(declared, ["graph", "class_iri"], "left_semi").select("graph", "class_iri", "n")
    used = per.where("used > 0").join(main.select("graph").distinct(), "graph", "left_anti").select("graph", "class_iri", F.col("used").alias("n"))
    counts = materialize(main.unionByName(used), "per_class")
    # an inner join with different keys: only labels of these classes are shuffled, and the rules are read once
    lab = quads.where((F.col("p") == RDFS + "label") & english("o_lang")).select("graph", F.col("s").alias("class_iri"), "o").join(
        counts.select("graph", "class_iri"), ["graph", "class_iri"]).groupBy("graph", "class_iri").agg(F.min("o").alias("l"))
    return counts.join(lab, ["graph", "class_iri"], "left").select(
        "graph", "class_iri", label_fallback("l", "class_iri").alias("label"), "n")


def vocabularies(quads: DataFrame) -> DataFrame:
    """Namespaces of the classes and predicates each graph uses."""
    is_type = (F.col("p") == TYPE) & (F.col("s_kind") == "iri") & (F.col("o_kind") == "iri")
    terms = quads.where(is_type).select("graph", F.col("o").alias("term")).unionByName(quads.select("graph", F.col("p").alias("term")))
    return terms.where(F.col("term").rlike("^https?://")).select("graph", namespace("term").alias("vocabulary")).distinct()


def vocabulary_reuse(quads: DataFrame, terms: DataFrame) -> DataFrame:
    """Ontology terms (iri, kind) that a graph declares or uses, per kind."""
    is_type = F.col("p") == TYPE
    known = materialize(terms.select("iri", "kind").distinct(), "terms")
    # what a graph uses is its classes and predicates, a few of each; what it declares are subjects
    tag = lambda kind, term, cond: F.when(cond, F.struct(term.alias("iri"), F.lit(kind).alias("kind")))
    uses = quads.select("graph", F.inline(F.array_compact(F.array(
        tag("class", F.col("o"), is_type & (F.col("o_kind") == "iri")), tag("class", F.col("s"), is_type & F.col("o").isin(CLASS_TYPES)),
        tag("object", F.col("s"), is_type & (F.col("o") == OWL + "ObjectProperty")), tag("data", F.col("s"), is_type & (F.col("o") == OWL + "DatatypeProperty")),
        tag("object", F.col("p"), F.col("o_kind") != "literal"), tag("data", F.col("p"), F.col("o_kind") == "literal")))))
    return uses.distinct().join(known, ["iri", "kind"]).select("graph", "kind", "iri")


def bounded_list(df: DataFrame, by: str, item: str, limit: int = 50) -> DataFrame:
    """Sorted first items joined by ', ' with '... (+N more)'. Only the first items of a
    group are ever collected; the rest is a count."""
    d = df.select(by, item).distinct()
    sizes = d.groupBy(by).agg(n_rows().alias("total"))
    head = top_n(d, limit, [by], [item]).groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(item)), ", ").alias("head"))
    more = F.when(F.col("total") > limit, F.concat(F.lit(" ... (+"), (F.col("total") - limit).cast("string"), F.lit(" more)"))).otherwise("")
    return head.join(sizes, by).select(by, F.concat("head", more).alias("items"), "total")


def status_rollup(df: DataFrame, key: str, status: str, amount: str) -> DataFrame:
    """Per status and per key totals with a grand total, amounts added up."""
    return df.rollup(key, status).agg(n_rows().alias("graphs"), F.sum(amount).alias("total"))


def average_triples(triples: DataFrame) -> DataFrame:
    """Average number of different triples of a subject. ``triples`` may repeat: each is shuffled once, as two hashes of 64 bits, the first one
    of its subject and both of the triple."""
    keys = triples.select(F.xxhash64("s").alias("x"), F.xxhash64(
        F.lit("2nd"), "s", "s_kind", "p", "o_kind", "o_lang", "o", F.coalesce("o_datatype", F.lit("")), F.col("o_datatype").isNull()).alias("z"))
    per_s = keys.repartition("x").distinct().groupBy("x").agg(n_rows().alias("n"))
    return per_s.agg(F.round(F.avg("n"), 6).alias("avg_triples"))


def ego_stats(ego: DataFrame, center: str) -> DataFrame:
    """Figures of an ego subgraph: triples, neighbours, literals and predicate counts."""
    nodes = ego.select(F.inline(F.array(F.struct(F.col("s").alias("v")), F.struct(
        F.when(F.col("o_kind") != "literal", F.col("o")).alias("v"))))).where(
        F.col("v").isNotNull() & (F.col("v") != center)).distinct()
    plain = ego.agg(n_rows().alias("triples"), F.count_if(F.col("o_kind") == "literal").alias("literals"))
    plain = plain.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
                                           for c in ("triples", "literals")])))
    near = nodes.agg(n_rows().alias("value")).select(F.lit("neighbours").alias("metric"), "value")
    preds = ego.groupBy("p").agg(n_rows().alias("value")).select(F.concat(F.lit("predicate "), "p").alias("metric"), "value")
    return plain.unionByName(near).unionByName(preds)


def declared_partition_counts(quads: DataFrame, classes: list[str], terms: Terms = TERMS) -> DataFrame:
    """Class partitions stated in service descriptions, restricted to the given classes."""
    part = link(quads, "http://rdfs.org/ns/void#classPartition", "dataset", "cp")
    cls = link(quads, "http://rdfs.org/ns/void#class", "cp", "term_class").where(F.col("term_class").isin(classes))
    n = value(quads, "http://rdfs.org/ns/void#entities", "cp", "n")
    return part.join(cls, "cp").join(n, "cp").select("dataset", "term_class", literal_int("n", None).alias("instances"))
