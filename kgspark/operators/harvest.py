"""Choosing artifacts, attaching known entities, detecting changes, matching names."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame, functions as F

from kgspark.functions.scalars import (
    FORMATS, RDF_EXTENSIONS, VARIANTS, basename, dirname, extension, owner_repo, rank_of, record_id, variant_parts)
from kgspark.operators.ordinal import with_ordinal
from kgspark.operators.pattern import first_wins, link, top_n, typed, value

# Directories that are build inputs, never released data.
BUILD_INPUTS = ["imports", "components", "utils", "scripts", "test", "tests", "examples", "node_modules", r"\.github"]


def is_rdf_path(path="path") -> Column:
    return extension(path).isin(RDF_EXTENSIONS)


def artifact_pool(candidates: DataFrame) -> DataFrame:
    """Candidates a source offers: its release assets; without any, tree files outside build
    inputs (all of them if nothing else is left), and of those only top-level files if any.

    Three flags per source, combined before the shuffle, decide; the rows themselves are
    only joined with them, so a source with very many files is not gathered in one task.
    """
    c = candidates.withColumn("asset", F.col("source") == "asset").withColumn(
        "build", F.col("path").rlike(r"(?i)(^|/)(" + "|".join(BUILD_INPUTS) + r")(/|$)")).withColumn(
        "root", dirname("path") == "")
    flags = c.groupBy("source_key").agg(
        F.bool_or("asset").alias("any_asset"), F.bool_or(~F.col("build")).alias("any_clean"),
        F.bool_or(F.col("root") & ~F.col("build")).alias("clean_root"), F.bool_or("root").alias("any_root"))
    j = c.join(flags, "source_key")
    has_root = F.when(F.col("any_clean"), F.col("clean_root")).otherwise(F.col("any_root"))
    keep = F.when(F.col("any_asset"), F.col("asset")).otherwise(
        (~F.col("any_clean") | ~F.col("build")) & (~has_root | F.col("root")))
    return j.where(keep).select(candidates.columns)


def select_artifacts(candidates: DataFrame) -> DataFrame:
    """Best variant and format per (source, directory, stem) of the pool."""
    stem, variant, ext = variant_parts("path")
    r = artifact_pool(candidates).withColumn("dir", dirname("path")).withColumn("stem", F.lower(stem)).withColumn(
        "v", rank_of(variant, VARIANTS)).withColumn("f", rank_of(ext, FORMATS)).withColumn("len", F.length("path"))
    best = top_n(r, 1, ["source_key", "dir", "stem"], ["v", "f", "len", "path", *[c for c in candidates.columns if c not in ("source_key", "path")]])
    return best.select(candidates.columns)


def glob_regex(pattern: str) -> str:
    return fnmatch.translate(pattern)


def include_globs(candidates: DataFrame, globs: DataFrame) -> DataFrame:
    """Files a curator named, by full path or base name; sources where none matches fall back
    to the automatic choice. ``globs``: (source_key, regex)."""
    g = globs.groupBy("source_key").agg(F.collect_set("regex").alias("globs"))  # one registration's short list
    c = candidates.join(g, "source_key", "left")
    base = basename("path")
    hit = F.exists("globs", lambda p: F.regexp_like("path", p) | F.regexp_like(base, p))
    named = c.where(F.coalesce(hit, F.lit(False))).select(candidates.columns)
    rest = candidates.join(named.select("source_key").distinct(), "source_key", "left_anti")
    return named.unionByName(select_artifacts(rest))


def merge_candidates(tree: DataFrame, assets: DataFrame) -> DataFrame:
    """Tree entries and release assets; for the same path the asset wins."""
    both = tree.unionByName(assets)
    rest = [c for c in both.columns if c not in ("source_key", "path")]
    best = both.groupBy("source_key", "path").agg(F.max_by(F.struct(*rest), F.struct((F.col("source") == "asset").cast("int"), *[F.col(c).cast("string") for c in rest])).alias("r"))
    return best.select("source_key", "path", "r.*").select(both.columns)


def latest_release(releases: DataFrame) -> DataFrame:
    """Per repository: the release flagged latest, else the newest; drafts are skipped."""
    ok = releases.where(~F.col("draft"))
    return top_n(ok, 1, ["repo"], ["-is_latest", "-published_at", "tag"])


def attach_entity(sources: DataFrame, known: DataFrame, minted: Column, type_iri: Column) -> DataFrame:
    """Known subject of a source, else a minted one; only minted subjects get a type."""
    j = sources.join(known.select("key", "kg_iri"), "key", "left")
    return j.select(*sources.columns, F.coalesce("kg_iri", minted).alias("subject"),
                    F.when(F.col("kg_iri").isNull(), type_iri).alias("type"))


def change_detect(current: DataFrame, prior: DataFrame) -> DataFrame:
    """(graph_iri, change): new, changed, unchanged or orphaned by content hash."""
    c = current.select("graph_iri", F.col("sha256").alias("now"))
    p = prior.select("graph_iri", F.col("sha256").alias("was"))
    change = (F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "orphaned")
              .when(F.col("now") == F.col("was"), "unchanged").otherwise("changed"))
    return c.join(p, "graph_iri", "full_outer").select("graph_iri", change.alias("change"))


def orphaned(current: DataFrame, prior: DataFrame) -> DataFrame:
    return prior.select("graph_iri").join(current.select("graph_iri"), "graph_iri", "left_anti").distinct()


def migrate_terms(df: DataFrame, column: str, replacements: DataFrame) -> DataFrame:
    """Deprecated IRIs to their replacement (old, new); unknown ones pass through."""
    r = replacements.select(F.col("old").alias(column), F.col("new").alias("__new"))
    return df.join(r, column, "left").withColumn(column, F.coalesce("__new", column)).drop("__new").select(df.columns)


def record_lookup(graphs: DataFrame, part_of: DataFrame) -> DataFrame:
    """(graph, record): from part-of edges of the registry, else the IRI before '/graph/'."""
    r = part_of.groupBy("graph").agg(F.max("record").alias("r"))
    return graphs.join(r, "graph", "left").select("graph", F.coalesce("r", F.substring_index("graph", "/graph/", 1)).alias("record"))


def discover_endpoints(quads: DataFrame, endpoint_cls: str, has_url: str, denoted_by: str) -> DataFrame:
    """(endpoint, url, dataset): http URLs of endpoint individuals with the datasets behind them, one row
    each; the dataset is null where there is none."""
    urls = typed(quads, endpoint_cls, "endpoint").join(value(quads, has_url, "endpoint", "url"), "endpoint")
    urls = urls.where(F.col("url").rlike("^https?://")).distinct()
    ds = link(quads, denoted_by, "dataset", "endpoint").distinct()
    return urls.join(ds, "endpoint", "left").select("endpoint", "url", "dataset")


def match_organizations(wanted: DataFrame, registry: DataFrame) -> DataFrame:
    """(row_id, registry_id, matched_by): exact name, alias or acronym in the same country first,
    else the first candidate sharing the name's first word."""
    names = registry.select("registry_id", "position", "country", F.explode(
        F.filter(F.concat(F.array("name"), "aliases", "acronyms"), lambda x: x.isNotNull())).alias("n"))
    names = names.select("registry_id", "position", "country", F.lower(F.trim("n")).alias("key")).distinct()
    w = wanted.select("row_id", "country", F.lower(F.trim("name")).alias("key"))
    exact = w.join(names, ["key", "country"]).select("row_id", "registry_id", "position", F.lit(1).alias("exact"))
    # candidates: one per (first word, country), the first in registry order, chosen before the join
    word = lambda c: F.substring_index(c, " ", 1)
    lead = names.groupBy(word("key").alias("word"), "country").agg(F.min(F.struct("position", "registry_id")).alias("c"))
    loose = w.withColumn("word", word("key")).join(lead, ["word", "country"]).select("row_id", F.col("c.registry_id"), F.col("c.position"), F.lit(0).alias("exact"))
    best = exact.unionByName(loose).groupBy("row_id").agg(F.min_by(F.struct("registry_id", "exact"), F.struct(-F.col("exact"), F.col("position"), F.col("registry_id"))).alias("b"))
    return best.select("row_id", "b.registry_id", F.when(F.col("b.exact") == 1, "exact").otherwise("candidate").alias("matched_by"))


def known_repos(quads: DataFrame, denoted_by: str, has_url: str) -> DataFrame:
    """(repo, kg_iri): repositories the graph already knows; the smallest subject wins."""
    urls = value(quads, has_url, "n", "url").where(F.lower("url").contains("github.com"))
    subj = quads.where((F.col("p") == denoted_by) & (F.col("s_kind") == "iri")).select("s", F.col("o").alias("n"))
    hit = subj.join(urls, "n").select("s", owner_repo("url").alias("repo")).where("repo is not null")
    return first_wins(hit, "repo", "s", "s").withColumnRenamed("s", "kg_iri")


def archive_records(quads: DataFrame, classes: list[str], denoted_by: str, has_url: str) -> DataFrame:
    """(record, dataset): archive records that datasets of the classes point at, each once."""
    ds = typed(quads, classes, "dataset").join(link(quads, denoted_by, "dataset", "n"), "dataset")
    urls = value(quads, has_url, "n", "url").where(F.lower("url").contains("zenodo"))
    hit = ds.join(urls, "n").select("dataset", record_id("url").alias("record")).where("record is not null")
    return hit.groupBy("record").agg(F.min("dataset").alias("dataset"))


# Snapshot functions in the order they claim a number; all others follow by name.
FUNCTION_ORDER = ["classes", "hierarchy", "tbox"]


def repair_ids(state: DataFrame) -> DataFrame:
    """Graph numbers of one record made unique: the first function (in ``FUNCTION_ORDER``) keeps its number,
    later duplicates move past the greatest one. (record, function, ts) -> adds ``fixed``."""
    turn = F.struct(rank_of(F.col("function"), FUNCTION_ORDER, len(FUNCTION_ORDER)), "function")
    first = state.groupBy("record", "ts").agg(F.min_by("function", turn).alias("function"))
    top = state.groupBy("record").agg(F.max("ts").alias("top"))
    dup = state.join(first, ["record", "ts", "function"], "left_anti")
    n = with_ordinal(dup.withColumn("h", F.sha1("function")), ["h", "ts"], "k", by=["record"]).join(top, "record")
    moved = n.select("record", "function", "ts", (F.col("top") + F.col("k")).alias("fixed"))
    kept = state.join(first, ["record", "ts", "function"], "left_semi").select("record", "function", "ts", F.col("ts").alias("fixed"))
    return kept.unionByName(moved)
