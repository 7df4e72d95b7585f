"""Zero-row verification queries and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kgspark.model import OWL, RDFS, TYPE
from kgspark.operators.closure import is_node
from kgspark.operators.pattern import not_exists
from kgspark.session import materialize

COMMON = 1000


def orcid_literals(quads: DataFrame, own_prefix: str, orcid_regex: str) -> DataFrame:
    """Own resources whose ORCID is a literal instead of an IRI."""
    return quads.where(F.col("s").startswith(own_prefix) & (F.col("o_kind") == "literal")
                       & F.col("o").rlike(orcid_regex)).select("s", "p", "o")


def undeclared_predicates(quads: DataFrame, prefix: str, exempt: list[str], declared: DataFrame) -> DataFrame:
    """Predicates of a namespace that the approved graph does not declare as object property."""
    used = quads.where(F.col("p").startswith(prefix) & ~F.col("p").isin(exempt)).select("p").distinct()
    ok = declared.where((F.col("p") == TYPE) & (F.col("o") == OWL + "ObjectProperty")).select(F.col("s").alias("p"))
    return not_exists(used, ok, on=["p"])


def unapproved_classes(quads: DataFrame, approved: DataFrame) -> DataFrame:
    """Instances of classes declared here but declared, deprecated or listed in no approved graph. ``quads`` may repeat.

    Most instances belong to a few classes. The ``COMMON`` most frequent ones are compared by a small table, so that only
    instances of the other classes are shuffled.
    """
    ctypes = [OWL + "Class", RDFS + "Class"]
    local = quads.where((F.col("p") == TYPE) & F.col("o").isin(ctypes)).select(F.col("s").alias("c"), F.col("o").alias("ctype")).distinct()
    a = approved.where(F.col("p") == TYPE)
    local = not_exists(local, a.where(F.col("o").isin(ctypes)).select(F.col("s").alias("c"), F.col("o").alias("ctype")), on=["c", "ctype"])
    local = not_exists(local, a.where(F.col("o") == OWL + "DeprecatedClass").select(F.col("s").alias("c")),
                       approved.where((F.col("p") == OWL + "deprecated") & (F.col("o") == "true")).select(F.col("s").alias("c")), on=["c"])
    used = quads.where((F.col("p") == TYPE) & (F.col("o_kind") == "iri") & ~F.col("o").startswith(OWL)).select("s", F.col("o").alias("c"))
    in_use = materialize(used.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "classes_in_use")
    bad = materialize(local.select("c").distinct().join(in_use, "c", "left_semi"), "unapproved")
    common = materialize(in_use.orderBy(F.desc("n"), "c").limit(COMMON).select("c"), "common")
    often = used.join(bad.join(common, "c", "left_semi"), "c", "left_semi")
    rare = used.join(common, "c", "left_anti").join(bad, "c", "left_semi")
    return often.unionByName(rare).select("s", "c").distinct()


def unapproved_properties(quads: DataFrame, *approved: DataFrame) -> DataFrame:
    """Properties in use that are declared here, but with that kind in no approved graph."""
    kinds = [OWL + "DatatypeProperty", OWL + "ObjectProperty"]
    decl = lambda q: q.where((F.col("p") == TYPE) & F.col("o").isin(kinds)).select(F.col("s").alias("p"), F.col("o").alias("ptype"))
    local = decl(quads).distinct().join(quads.select("p").distinct(), "p", "left_semi")
    return not_exists(local, *[decl(a) for a in approved], on=["p", "ptype"])


def disjoint_members(quads: DataFrame) -> DataFrame:
    """(x, c, d) as asserted: direction and subclasses are not followed."""
    dis = quads.where((F.col("p") == OWL + "disjointWith") & is_node()).select(F.col("s").alias("c"), F.col("o").alias("d")).distinct()
    t = quads.where((F.col("p") == TYPE) & is_node()).select("s", "o").distinct()
    left = t.select(F.col("s").alias("x"), F.col("o").alias("c")).join(dis, "c")
    return left.join(t.select(F.col("s").alias("x"), F.col("o").alias("d")), ["x", "d"]).select("x", "c", "d")


def gate_report(checks: dict[str, DataFrame]) -> DataFrame:
    """(name, rows, status): PASS when a check has no rows."""
    out = None
    for name, df in checks.items():
        n = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = n if out is None else out.unionByName(n)
    return out.withColumn("status", F.when(F.col("rows") == 0, "PASS").otherwise("FAIL"))


def non_empty_report(questions: dict[str, DataFrame]) -> DataFrame:
    """(question, non_empty): every question must return a row; one row decides."""
    out = None
    for name, df in questions.items():
        n = df.select(F.lit(1).alias("x")).limit(1).agg((F.count("x") > 0).alias("non_empty")).select(F.lit(name).alias("question"), "non_empty")
        out = n if out is None else out.unionByName(n)
    return out


HTML = r"(?is)^\s*(<!doctype html|<html)"
SERIALISATIONS = {
    "trig": r"(?m)^\s*(GRAPH\s+)?<[^>]+>\s*\{",
    "jsonld": r"(?s)^\s*[\[{].*\"@(context|id|graph|type)\"",
    "turtle": r"(?m)^\s*(@prefix|@base|prefix |base )",
    "nquads": r"(?m)^\s*(<[^>]*>|_:\S+)\s+<[^>]*>\s+.+\.\s*$",
    "xml": r"(?s)^\s*<\?xml|<rdf:RDF",
}


def output_gates(files: DataFrame, path: str = "path", text: str = "text", head: int | None = None) -> DataFrame:
    """Per output file: non-empty, not an HTML page, which serialisation it looks like: the first of ``SERIALISATIONS``
    whose pattern is found in the text, or in its first ``head`` characters where a caller wants a cheaper sniff.
    """
    t = F.col(text) if head is None else F.substring(F.col(text), 1, head)
    kind = F.lit("unknown")
    for name, pattern in reversed(list(SERIALISATIONS.items())):
        kind = F.when(t.rlike(pattern), name).otherwise(kind)
    return files.select(F.col(path).alias("path"), (F.length(F.trim(text)) > 0).alias("non_empty"),
                        t.rlike(HTML).alias("is_html"), kind.alias("serialisation")).withColumn(
        "ok", F.col("non_empty") & ~F.col("is_html"))
