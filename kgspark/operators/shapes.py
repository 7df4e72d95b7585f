"""Constraint checks. A check returns violations: (shape, focus, path, value, message).

Triples may repeat: every check makes its own rows distinct. Nodes in focus and their values are stored once, so that only what concerns
them is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from kgspark.model import ONT, OWL, SUBCLASS, TERMS, TYPE, Terms
from kgspark.operators.closure import among, descendants, is_node
from kgspark.operators.metrics import term_key
from kgspark.operators.pattern import link
from kgspark.session import materialize

VIOLATION = "shape string, focus string, path string, value string, message string"


def _violations(df: DataFrame, shape: str, path: str, message: str, val=None) -> DataFrame:
    return df.select(F.lit(shape).alias("shape"), "focus", F.lit(path).alias("path"),
                     (F.lit(None) if val is None else F.col(val)).cast("string").alias("value"),
                     F.lit(message).alias("message"))


def targets(triples: DataFrame, cls: str | list[str], schema: DataFrame | None = None) -> DataFrame:
    """Members of a class or of anything below it: (focus)."""
    classes = [cls] if isinstance(cls, str) else cls
    t = triples.where((F.col("p") == TYPE) & is_node())
    if schema is None:
        hit = t.where(F.col("o").isin(classes))
    else:
        hit = among(t, "o", descendants(schema, classes))
    return hit.select(F.col("s").alias("focus")).distinct()


def targets_of_object(triples: DataFrame, predicate: str) -> DataFrame:
    return triples.where((F.col("p") == predicate) & is_node()).select(F.col("o").alias("focus")).distinct()


def value_counts(triples: DataFrame, path: str, cond=None, of: DataFrame | None = None) -> DataFrame:
    """(focus, n): distinct values per subject, on request only of the nodes in ``of``; values are de-duplicated before counting."""
    v = triples.where(F.col("p") == path)
    if cond is not None:
        v = v.where(cond)
    v = v.withColumn("focus", F.col("s"))
    if of is not None:
        v = v.join(of, "focus", "left_semi")
    return v.select("focus", term_key().alias("v")).distinct().groupBy("focus").agg(F.count(F.lit(1)).alias("n"))


def cardinality(triples: DataFrame, focus: DataFrame, path: str, shape: str, message: str,
                min_count: int = 0, max_count: int | None = None, cond=None) -> DataFrame:
    n = focus.join(value_counts(triples, path, cond, focus), "focus", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    bad = F.col("n") < min_count
    if max_count is not None:
        bad = bad | (F.col("n") > max_count)
    return _violations(n.where(bad), shape, path, message, "n")


def typed_nodes(triples: DataFrame, classes: list[str], schema: DataFrame | None = None, var: str = "v") -> DataFrame:
    return targets(triples, classes, schema).select(F.col("focus").alias(var))


def _about(triples: DataFrame, nodes: DataFrame) -> DataFrame:
    """The triples whose subject is one of the nodes (column v)."""
    return triples.join(nodes.select(F.col("v").alias("s")), "s", "left_semi")


def value_class(triples: DataFrame, focus: DataFrame, path: str, cls: list[str], shape: str, message: str,
                schema: DataFrame | None = None) -> DataFrame:
    """Every value must be a member of the class."""
    vals = triples.where(F.col("p") == path).select(F.col("s").alias("focus"), F.col("o").alias("v"), is_node().alias("node"))
    vals = materialize(vals.join(focus, "focus", "left_semi").distinct(), "values")
    ok = typed_nodes(_about(triples, vals), cls, schema).withColumn("__ok", F.lit(True))
    bad = vals.join(ok, "v", "left").where(F.col("__ok").isNull() | ~F.col("node"))
    return _violations(bad.distinct(), shape, path, message, "v")


def node_kind_iri(triples: DataFrame, focus: DataFrame, path: str, shape: str, message: str) -> DataFrame:
    bad = triples.where((F.col("p") == path) & (F.col("o_kind") != "iri")).select(F.col("s").alias("focus"), F.col("o").alias("v"))
    return _violations(bad.join(focus, "focus", "left_semi"), shape, path, message, "v")


def qualified_counts(triples: DataFrame, path: str, classes: list[str], schema: DataFrame | None = None,
                     also: DataFrame | None = None, of: DataFrame | None = None) -> DataFrame:
    """(focus, q): distinct values that belong to the classes and to ``also`` (column v), on request only of the nodes in ``of``."""
    pairs = link(triples, path, "focus", "v")
    if of is not None:
        pairs = pairs.join(of, "focus", "left_semi")
    pairs = materialize(pairs.distinct(), "values")
    ok = typed_nodes(_about(triples, pairs), classes, schema)
    if also is not None:
        ok = ok.join(also.join(pairs, "v", "left_semi").select("v").distinct(), "v", "left_semi")
    return pairs.join(ok, "v", "left_semi").groupBy("focus").agg(F.count(F.lit(1)).alias("q"))


def qualified_min(triples, focus, path, classes, shape, message, schema=None, also=None, minimum: int = 1) -> DataFrame:
    q = focus.join(qualified_counts(triples, path, classes, schema, also, focus), "focus", "left").withColumn("q", F.coalesce("q", F.lit(0)))
    return _violations(q.where(F.col("q") < minimum), shape, path, message, "q")


def distinct_union(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


# --- the shapes --------------------------------------------------------------------------------

def _focus(t, cls, schema=None) -> DataFrame:
    return materialize(targets(t, cls, schema), "focus")


def textual_entity(t, schema=None, terms: Terms = TERMS, cls: str | None = None) -> DataFrame:
    return cardinality(t, _focus(t, cls or _ont("TextualEntity"), schema), terms.about, "textual_entity",
                       "a textual entity must be about something", 1)


def no_punning(t, schema=None, terms: Terms = TERMS) -> DataFrame:
    return cardinality(t, _focus(t, OWL + "NamedIndividual"), SUBCLASS, "no_punning",
                       "a named individual cannot be a subclass of something", 0, 0)


def role_bearer(t, schema=None, terms: Terms = TERMS) -> DataFrame:
    focus = _focus(t, _ont("Role"), schema)
    return distinct_union(
        cardinality(t, focus, terms.role_of, "role_bearer", "a role must be the role of something", 1),
        cardinality(t, focus, terms.realized_in, "role_bearer", "a role must be realized in some process", 1))


def role_realized(t, schema=None, terms: Terms = TERMS) -> DataFrame:
    return cardinality(t, _focus(t, _ont("Role"), schema), terms.realized_in, "role_realized",
                       "a role must be realized in something", 1)


def ontology_variant(t, schema=None, terms: Terms = TERMS) -> DataFrame:
    focus, msg = _focus(t, _ont("OntologyVariant"), schema), "an ontology variant must be part of an ontology"
    return distinct_union(cardinality(t, focus, terms.part_of, "ontology_variant", msg, 1),
                          value_class(t, focus, terms.part_of, [_ont("Ontology")], "ontology_variant", msg, schema))


def ontology_version(t, schema=None, terms: Terms = TERMS, number_classes: list[str] | None = None,
                     file_classes: list[str] | None = None) -> DataFrame:
    """A version is subject of a version number or IRI; with two or more values a file counts too."""
    num = number_classes or [_ont("VersionNumber"), _ont("VersionIri"), terms.website]
    files = file_classes or [terms.file, terms.repository]
    focus = _focus(t, _ont("OntologyVersion"), schema)
    n = value_counts(t, terms.subject_of, of=focus)
    q1 = qualified_counts(t, terms.subject_of, num, of=focus).withColumnRenamed("q", "q1")
    q2 = qualified_counts(t, terms.subject_of, num + files, of=focus).withColumnRenamed("q", "q2")
    all_n = focus.join(n, "focus", "left").join(q1, "focus", "left").join(q2, "focus", "left").fillna(0, ["n", "q1", "q2"])
    good = ((F.col("n") <= 1) & (F.col("q1") >= 1)) | ((F.col("n") >= 2) & (F.col("q2") >= 1))
    return _violations(all_n.where(~good), "ontology_version", terms.subject_of,
                       "an ontology version must be subject of a version number or IRI", "n")


def has_value(t, schema=None, terms: Terms = TERMS) -> DataFrame:
    return cardinality(t, _focus(t, _ont("TextualEntity"), schema), terms.has_value, "has_value",
                       "an e-mail address or textual entity must have a value", 1)


def has_url(t, schema=None, terms: Terms = TERMS) -> DataFrame:
    return cardinality(t, _focus(t, terms.website, schema), terms.has_url, "has_url", "a URL instance must have a url", 1)


def _ont(name: str) -> str:
    return ONT + name


VOID_DATASET = "http://rdfs.org/ns/void#Dataset"


def graph_metadata(t, schema=None, terms: Terms = TERMS) -> DataFrame:
    focus, sh = _focus(t, VOID_DATASET), "graph_metadata"
    label = "http://www.w3.org/2000/01/rdf-schema#label"
    empty = t.where((F.col("p") == label) & (F.length("o") < 1)).select(F.col("s").alias("focus"), F.col("o").alias("v"))
    filled = t.where((F.col("p") == terms.has_value) & (F.length("o") >= 1)).select(F.col("s").alias("v"))
    m1, m2, m3 = ("a published graph must carry a label", "a published graph must be denoted by a textual description with a value",
                  "a published graph must be the output of exactly one load process")
    return distinct_union(
        cardinality(t, focus, label, sh, m1, 1), _violations(empty.join(focus, "focus", "left_semi"), sh, label, m1, "v"),
        cardinality(t, focus, terms.denoted_by, sh, m2, 1), node_kind_iri(t, focus, terms.denoted_by, sh, m2),
        qualified_min(t, focus, terms.denoted_by, [terms.description], sh, m2, schema, filled),
        cardinality(t, focus, terms.output_of, sh, m3, 1, 1), node_kind_iri(t, focus, terms.output_of, sh, m3),
        value_class(t, focus, terms.output_of, [terms.process], sh, m3, schema))


def load_process(t, schema=None, terms: Terms = TERMS) -> DataFrame:
    focus, sh = materialize(targets_of_object(t, terms.output_of), "focus"), "load_process"
    m1, m2 = "a load process must record a participant", "a load process must occupy exactly one region with first and last instant"
    ends = None
    for p in (terms.first_instant, terms.last_instant):
        v = t.where((F.col("p") == p) & (F.col("o_kind") == "iri")).select(F.col("s").alias("v")).distinct()
        ends = v if ends is None else ends.join(v, "v")
    return distinct_union(
        cardinality(t, focus, terms.participant, sh, m1, 1), node_kind_iri(t, focus, terms.participant, sh, m1),
        cardinality(t, focus, terms.occupies, sh, m2, 1, 1), node_kind_iri(t, focus, terms.occupies, sh, m2),
        qualified_min(t, focus, terms.occupies, [terms.region], sh, m2, schema, ends))


STAMP = r"^-?\d{4,}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def instant(t, schema=None, terms: Terms = TERMS, weaker_class: str | None = None) -> DataFrame:
    """Exactly one timestamp of the right datatype and form. ``weaker_class`` also reports
    nodes that carry a timestamp but only the parent type."""
    focus, sh, msg = _focus(t, terms.instant, schema), "instant", "an instant must record its time as one dateTimeStamp"
    v = t.where(F.col("p") == terms.timestamp)
    xsd = "http://www.w3.org/2001/XMLSchema#dateTimeStamp"
    ok = (F.coalesce("o_datatype", F.lit("")) == xsd) & F.col("o").rlike(STAMP)
    wrong = v.where(~ok).select(F.col("s").alias("focus"), F.col("o").alias("v")).join(focus, "focus", "left_semi")
    parts = [cardinality(t, focus, terms.timestamp, sh, msg, 1, 1), _violations(wrong, sh, terms.timestamp, msg, "v")]
    if weaker_class:
        weak = targets(t, weaker_class).join(focus, "focus", "left_anti").join(v.select(F.col("s").alias("focus")), "focus", "left_semi")
        parts.append(_violations(weak, sh, TYPE, "the weaker type is used for an instant"))
    return distinct_union(*parts)


def no_deprecated(t, schema=None, terms: Terms = TERMS, deprecated: list[str] | None = None) -> DataFrame:
    focus = _focus(t, VOID_DATASET)
    bad = t.where((F.col("p") == TYPE) & F.col("o").isin(deprecated or [_ont("Dataset")])).select(F.col("s").alias("focus"), F.col("o").alias("v"))
    return _violations(bad.join(focus, "focus", "left_semi").distinct(), "no_deprecated", TYPE, "deprecated class on a published graph", "v")


EXECUTED: dict[str, Callable] = {
    "textual_entity": textual_entity, "no_punning": no_punning, "role_bearer": role_bearer,
    "role_realized": role_realized, "ontology_variant": ontology_variant, "ontology_version": ontology_version,
    "has_value": has_value, "has_url": has_url,
}
DOCUMENTED: dict[str, Callable] = {
    "graph_metadata": graph_metadata, "load_process": load_process, "instant": instant, "no_deprecated": no_deprecated,
}


def run_shapes(triples: DataFrame, shapes: dict[str, Callable] = EXECUTED, schema: DataFrame | None = None,
               terms: Terms = TERMS) -> DataFrame:
    out = None
    for fn in shapes.values():
        v = fn(triples, schema, terms)
        out = v if out is None else out.unionByName(v)
    return out


def shape_report(violations: DataFrame, shapes: dict[str, Callable] = EXECUTED) -> DataFrame:
    """(shape, violations, conforms) with a row for every shape that ran."""
    spark = violations.sparkSession
    names = spark.createDataFrame([(n,) for n in shapes], "shape string")
    n = violations.groupBy("shape").agg(F.count(F.lit(1)).alias("violations"))
    return names.join(n, "shape", "left").select("shape", F.coalesce("violations", F.lit(0)).alias("violations"),
                                                 F.col("violations").isNull().alias("conforms"))
