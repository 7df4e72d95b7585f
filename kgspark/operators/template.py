"""Template tabs: directives, reference resolution, unpivoting into triples, promotion.

A tab is a DataFrame (tab, tab_order, row, cells array<string>) and its directives a
DataFrame (tab, col, header, directive). Cells become rows once, and everything else is a
join on (tab, col).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kgspark.functions.scalars import parse_directive
from kgspark.model import LABEL, QUAD_COLS, TYPE, XSD
from kgspark.operators.axioms import ATTACH, axiom_triples
from kgspark.operators.pattern import top_n


def cells(tabs: DataFrame, directives: DataFrame) -> DataFrame:
    """Non-blank cells of rows with an id: (tab, tab_order, row, id, col, kind, property, datatype, split, value)."""
    rows = tabs.where(F.trim(F.coalesce(F.col("cells")[0], F.lit(""))) != "")
    long = rows.select("tab", "tab_order", "row", F.trim(F.col("cells")[0]).alias("id"), F.posexplode("cells").alias("col", "value"))
    long = long.where(F.trim(F.coalesce("value", F.lit(""))) != "")
    d = directives.select("tab", "col", "header", F.trim("directive").alias("directive"), F.inline(F.array(parse_directive("directive"))))
    return long.join(d, ["tab", "col"])


def split_cells(c: DataFrame, default_split: str | None = None) -> DataFrame:
    """One row per value: cells with a SPLIT token (or references, on the default one) are split."""
    token = F.coalesce("split", F.lit(default_split) if default_split else F.lit(None).cast("string"))
    quoted = F.concat(F.lit("\\Q"), token, F.lit("\\E"))
    parts = F.when(token.isNull(), F.array(F.col("value"))).otherwise(F.split(F.col("value"), quoted))
    out = c.withColumn("value", F.explode(F.transform(parts, lambda x: F.trim(x))))
    return out.where(F.col("value") != "")


def label_index(c: DataFrame) -> DataFrame:
    """(key, iri): labels of all tabs, letter case ignored; first tab, then first row wins."""
    lab = c.where((F.col("kind") == "A") & F.col("property").isin([LABEL, "rdfs:label"]))
    return lab.groupBy(F.lower(F.trim("value")).alias("key")).agg(
        F.min_by("id", F.struct("tab_order", "row", "id")).alias("iri"))


def resolve(refs: DataFrame, index: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``iri`` (null when unresolved). A value that is an IRI already stays as it is."""
    r = refs.withColumn("key", F.lower(F.trim(value)))
    out = r.join(index, "key", "left")
    return out.withColumn("iri", F.coalesce(F.when(F.col(value).rlike("^https?://"), F.col(value)), "iri")).drop("key")


def template_to_triples(tabs: DataFrame, directives: DataFrame, graph: str) -> tuple[DataFrame, DataFrame]:
    """(quads, unresolved references)."""
    c = cells(tabs, directives)
    index = label_index(c)
    null = F.lit(None).cast("string")
    ids = c.where("kind = 'TYPE'")
    types = ids.where(F.col("value").rlike("^https?://")).select("id", F.lit(TYPE).alias("p"), F.trim("value").alias("o"), F.lit("iri").alias("o_kind"), null.alias("o_datatype"), F.lit("").alias("o_lang"))
    v = split_cells(c.where("kind in ('A', 'AT', 'AI')"))
    dt = F.when(F.col("kind") == "AT", F.regexp_replace(F.coalesce("datatype", F.lit(XSD + "string")), "^xsd:", XSD))
    lit = v.select("id", F.regexp_replace("property", "^rdfs:label$", LABEL).alias("p"), F.col("value").alias("o"),
                   F.when(F.col("kind") == "AI", "iri").otherwise("literal").alias("o_kind"), dt.alias("o_datatype"), F.when(F.col("kind") == "A", F.coalesce("lang", F.lit(""))).otherwise("").alias("o_lang"))
    refs = resolve(split_cells(c.where("kind = 'I'"), "|"), index)
    nodes = refs.where("iri is not null").select("id", F.col("property").alias("p"), F.col("iri").alias("o"), F.lit("iri").alias("o_kind"), null.alias("o_datatype"), F.lit("").alias("o_lang"))
    plain = types.unionByName(lit).unionByName(nodes).select(F.col("id").alias("s"), F.lit("iri").alias("s_kind"), "p", "o", "o_kind", "o_datatype", "o_lang")
    axioms, lost = axiom_triples(split_cells(c.where(F.col("kind").isin(list(ATTACH))), "|"), directives, index, resolve)
    quads = plain.unionByName(axioms).withColumn("graph", F.lit(graph))
    return quads.select(QUAD_COLS).distinct(), refs.where("iri is null").select("tab", "row", "id", "header", "value").unionByName(lost)


def template_columns(directives: DataFrame, labels: DataFrame) -> DataFrame:
    """Column table of each tab: kind, property, meaning, and whether the meaning is missing."""
    d = directives.select("tab", "col", "header", F.inline(F.array(parse_directive("directive"))))
    return d.join(labels.select(F.col("iri").alias("property"), "meaning"), "property", "left").select(
        "tab", "col", "header", "kind", "property", "meaning",
        (F.col("property").isNotNull() & F.col("meaning").isNull()).alias("unlabeled"))


def example_rows(tabs: DataFrame) -> DataFrame:
    """Fullest row of each tab with an IRI id; the first on ties."""
    score = F.size(F.filter("cells", lambda x: F.trim(F.coalesce(x, F.lit(""))) != ""))
    cand = tabs.where(F.col("cells")[0].rlike("^https?://")).select("tab", "row", F.col("cells")[0].alias("id"), score.alias("filled"))
    return top_n(cand, 1, ["tab"], ["-filled", "row"])


def value_type_owners(c: DataFrame, refs: DataFrame) -> DataFrame:
    """(value_type, tab, refs): the tab that points most often at nodes of a type; first tab on ties."""
    types = c.where("kind = 'TYPE'").select(F.col("id").alias("iri"), F.trim("value").alias("value_type"))
    n = refs.where("iri is not null").join(types, "iri").groupBy("value_type", "tab", "tab_order").agg(F.count(F.lit(1)).alias("refs"))
    return top_n(n, 1, ["value_type"], ["-refs", "tab_order"]).select("value_type", "tab", "refs")


def related_tabs(c: DataFrame, refs: DataFrame) -> DataFrame:
    """(tab, related): other tabs whose entities a tab points at."""
    home = c.select(F.col("id").alias("iri"), F.col("tab").alias("related")).distinct()
    return refs.where("iri is not null").select("tab", "iri").distinct().join(home, "iri").where("tab <> related").select("tab", "related").distinct()


def pattern_unit_test(c: DataFrame, quads: DataFrame, denoted_by: str) -> DataFrame:
    """(tab, form, matches): tabs with a label column must find an entity by label, others
    through the label of a value node."""
    has_label = c.groupBy("tab").agg(F.max(((F.col("kind") == "A") & F.col("property").isin([LABEL, "rdfs:label"])).cast("int")).alias("l"))
    labelled = quads.where(F.col("p") == LABEL).select("s").distinct()
    via = quads.where(F.col("p") == denoted_by).select("s", F.col("o").alias("n")).join(labelled.withColumnRenamed("s", "n"), "n").select("s").distinct()
    ids = c.where("kind = 'TYPE'").select("tab", F.col("id").alias("s")).distinct()
    direct_n = ids.join(labelled, "s", "left_semi").groupBy("tab").agg(F.count(F.lit(1)).alias("direct"))
    via_n = ids.join(via, "s", "left_semi").groupBy("tab").agg(F.count(F.lit(1)).alias("via"))
    out = has_label.join(direct_n, "tab", "left").join(via_n, "tab", "left")
    return out.select("tab", F.when(F.col("l") == 1, "entity_label").otherwise("value_node_label").alias("form"),
                      F.coalesce(F.when(F.col("l") == 1, F.col("direct")).otherwise(F.col("via")), F.lit(0)).alias("matches")
                      ).withColumn("ok", F.col("matches") > 0)


# --- intake ------------------------------------------------------------------------------------

def intake_guards(intake: DataFrame, known_ids: DataFrame | None = None) -> DataFrame:
    """Drop rows without a label, comment rows and rows promoted before."""
    out = intake.where((F.trim(F.coalesce("label", F.lit(""))) != "") & ~F.trim(F.coalesce("label", F.lit(""))).startswith("#"))
    return out if known_ids is None else out.join(known_ids.select("row_id").distinct(), "row_id", "left_anti")


def must_resolve(intake: DataFrame, columns: list[str], index: DataFrame, sep: str = r"\|") -> DataFrame:
    """(row_id, promoted, missing): promoted only when every reference resolves; missing names
    joined in order. Rows are reduced by row id, so a popular name is never gathered."""
    refs = None
    for c in columns:
        r = intake.select("row_id", F.explode(F.split(F.coalesce(F.col(c), F.lit("")), sep)).alias("value"))
        refs = r if refs is None else refs.unionByName(r)
    refs = refs.withColumn("value", F.trim("value")).where("value <> ''")
    hit = resolve(refs, index)
    agg = hit.groupBy("row_id").agg(F.bool_and(F.col("iri").isNotNull()).alias("all_found"),
                                    F.array_sort(F.collect_set(F.when(F.col("iri").isNull(), F.col("value")))).alias("m"))
    return intake.select("row_id").distinct().join(agg, "row_id", "left").select(
        "row_id", F.coalesce("all_found", F.lit(True)).alias("promoted"), F.coalesce(F.array_join("m", ", "), F.lit("")).alias("missing"))


def promote_rows(intake: DataFrame, value_classes: dict[str, tuple[str, str]], base: str, epoch_ms: int,
                 number) -> DataFrame:
    """Entity rows plus one value-node row per filled column.

    ``value_classes``: column -> (class, label pattern with one %s). ``number`` is a column
    numbering the intake rows; ids are epoch + number * slots + slot, so reruns agree.
    """
    slots = len(value_classes) + 1
    base_no = F.lit(epoch_ms).cast("bigint") + number * slots
    rows = [F.struct(F.lit("entity").alias("part"), F.concat(F.lit(base), base_no.cast("string")).alias("id"),
                     F.lit(None).cast("string").alias("cls"), F.col("label").alias("label"), F.col("label").alias("value"))]
    for i, (c, (cls, pattern)) in enumerate(value_classes.items(), 1):
        rows.append(F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", F.struct(
            F.lit(c).alias("part"), F.concat(F.lit(base), (base_no + i).cast("string")).alias("id"), F.lit(cls).alias("cls"),
            F.format_string(pattern, "label").alias("label"), F.trim(F.col(c)).alias("value"))))
    return intake.select("row_id", F.inline(F.array_compact(F.array(*rows))))
