"""Fixpoints over quads: transitive closure, ego subgraphs, rule closure, contradictions.

Loops are semi-naive: each round joins only the rows found in the round before, the new rows
are written to the shared folder, and a round without new rows ends the loop. There is no round
limit unless a caller asks for one, which then raises an error; closures double path lengths from round
to round, and path searches contract chains, so a chain of n nodes takes about log2(n) rounds.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from kgspark.functions.scalars import normalized_label
from kgspark.model import (
    DOMAIN, LABEL, OWL, QUAD_COLS, RANGE, RDF, SAME_AS, SUBCLASS, SUBPROP, TRIPLE_COLS, TYPE)
from kgspark.operators.pattern import order_limit, semi
from kgspark.session import materialize

#: Steps of a path search before it contracts chains.
SINGLE_STEPS = 8
#: Stored rounds that a plan reads before they are put together.
MANY = 16
#: Terms of a schema side that become constants of a filter; where there are more, a join alone selects.
FEW_TERMS = 1000


def _rounds(limit: int | None, what: str) -> Iterator[int]:
    """0, 1, 2, ... without end, or up to a limit the caller asked for."""
    for i in itertools.count():
        if limit is not None and i >= limit:
            raise RuntimeError(f"{what} did not finish within {limit} rounds")
        yield i


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def is_node() -> Column:
    return F.col("o_kind") != "literal"


def among(rows: DataFrame, column: str, terms: DataFrame) -> DataFrame:
    """Rows whose ``column`` holds one of the terms. A few terms, as a vocabulary has, become a constant filter, with which a scan or a
    view leaves out what cannot match; more of them are met by a semi join."""
    t = terms.select(F.col(terms.columns[0]).alias(column)).distinct()
    few = [r[0] for r in t.limit(FEW_TERMS + 1).collect()]
    return rows.where(F.col(column).isin(few)) if len(few) <= FEW_TERMS else rows.join(t, column, "left_semi")


def node_triples(s, p, o, *keep) -> list[Column]:
    """Columns of an inferred triple between nodes."""
    kind = lambda c: F.when(F.startswith(c, F.lit("_:")), "bnode").otherwise("iri")
    return [*[F.col(k) for k in keep], s.alias("s"), kind(s).alias("s_kind"), p.alias("p"), o.alias("o"),
            kind(o).alias("o_kind"), F.lit(None).cast("string").alias("o_datatype"), F.lit("").alias("o_lang")]


def hierarchy(quads: DataFrame, predicate: str) -> DataFrame:
    """(a, b) pairs of a hierarchy predicate, without self pairs."""
    return quads.where((F.col("p") == predicate) & is_node() & (F.col("s") != F.col("o"))).select(
        F.col("s").alias("a"), F.col("o").alias("b")).distinct()


def transitive_closure(pairs: DataFrame, keys: tuple = (), max_rounds: int | None = None) -> DataFrame:
    """All (a, b) reachable in one or more steps; ``keys`` keep separate graphs apart. A node
    on a cycle reaches itself.

    A round joins the pairs found last with all pairs known: a pair at distance d has a node
    in between at the longest distance known so far, so distances double.
    """
    cols = [*keys, "a", "b"]
    delta = materialize(pairs.where(F.col("a") != F.col("b")).select(cols).distinct(), "edges")
    known = [delta]
    for _ in _rounds(max_rounds, "closure"):
        every = _union(known)
        step = every.select(*keys, F.col("a").alias("b"), F.col("b").alias("c"))
        found = delta.join(step, [*keys, "b"]).select(*keys, "a", F.col("c").alias("b")).distinct()
        delta = materialize(found.join(every, cols, "left_anti"), "closure")
        if delta.isEmpty():
            return every
        known.append(delta)


def contract_chains(edges: DataFrame, keep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chains of edges as single edges: (a, b, chain), and (node, chain) of the nodes inside them.

    A node with one edge in and one out lies inside a chain, unless it is in ``keep`` (node). Every such node
    points to the next one of its chain and then, by pointer jumping, twice as far each round, until
    all point to the last one, whose name is the chain's. Edges of whole cycles, which nothing enters, go.
    """
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    degree = ends.groupBy("node").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    inner = materialize(degree.where("out = 1 AND into = 1").select("node").join(keep, "node", "left_anti").join(loops, "node", "left_anti"), "inner")
    step = edges.join(inner.withColumnRenamed("node", "a"), "a", "left_semi")
    to = inner.select(F.col("node").alias("b"), F.lit(True).alias("inside"))
    # the last node of a chain points to itself
    jump = materialize(step.join(to, "b", "left").select(F.col("a").alias("node"), F.when(F.col("inside"), F.col("b")).otherwise(F.col("a")).alias("to")), "jump")
    moving = None
    while True:
        far = jump.select(F.col("node").alias("to"), F.col("to").alias("far"))
        now = materialize(jump.join(far, "to").select("node", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")), "jump")
        n = now.where("moved").count()
        jump = now.select("node", "to")
        # pointers that still move though no further one came to rest go round on a cycle
        if n == 0 or n == moving:
            break
        moving = n
    last = jump.where("node = to").select(F.col("node").alias("chain"))
    inside = materialize(jump.withColumnRenamed("to", "chain").join(last, "chain", "left_semi").select("node", "chain"), "inside")
    leave = edges.join(last.withColumnRenamed("chain", "a"), "a").select(F.col("a").alias("chain"), F.col("b").alias("end"))
    outer = edges.join(inner.withColumnRenamed("node", "a"), "a", "left_anti").join(inside.withColumnRenamed("node", "b"), "b", "left")
    outer = outer.join(leave, "chain", "left").select("a", F.coalesce("end", "b").alias("b"), "chain")
    return materialize(outer.distinct(), "contracted"), inside


def reach(edges: DataFrame, starts: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Nodes reachable from the start nodes over (a, b) edges in one or more steps.

    Every round takes one step from the nodes found last. A search that is not over after ``SINGLE_STEPS``
    steps first contracts the chains among the edges that lead to unseen nodes, so that a chain is one
    step, whatever its length. No table of a round has more rows than there are edges.
    """
    edges = materialize(edges.select("a", "b").distinct(), "steps")
    frontier = starts.select(F.col(starts.columns[0]).alias("node")).distinct()
    seen: list[DataFrame] = []
    visited, inside = [], None
    for i in _rounds(max_rounds, "path search"):
        if i == SINGLE_STEPS:
            fresh = edges.join(_union(seen).withColumnRenamed("node", "b"), "b", "left_anti").select("a", "b")
            edges, inside = contract_chains(materialize(fresh, "steps"), frontier)
        if inside is not None:
            visited.append(frontier)
        nxt = edges.join(frontier, edges["a"] == frontier["node"]).select(F.col("b").alias("node")).distinct()
        if seen:
            nxt = nxt.join(_union(seen), "node", "left_anti")
        nxt = materialize(nxt, "reach")
        if nxt.isEmpty():
            break
        seen.append(nxt)
        frontier = nxt
        if len(seen) > MANY:  # plans stay small however many rounds there are
            seen = [materialize(_union(seen), "reach")]
        if len(visited) > MANY:
            visited = [materialize(_union(visited), "reach")]
    found = _union(seen) if seen else nxt
    if inside is None:
        return found
    entered = edges.join(_union(visited).withColumnRenamed("node", "a"), "a", "left_semi").where("chain IS NOT NULL").select("chain").distinct()
    return found.unionByName(inside.join(entered, "chain", "left_semi").select("node"))


def path_plus(quads: DataFrame, predicate: str, start: str) -> DataFrame:
    """``<start> predicate+ ?node``."""
    edges = quads.where((F.col("p") == predicate) & is_node()).select(F.col("s").alias("a"), F.col("o").alias("b"))
    return reach(edges, quads.sparkSession.createDataFrame([(start,)], "node string"))


def descendants(schema: DataFrame, classes: list[str]) -> DataFrame:
    """The classes and everything below them: (cls)."""
    up = hierarchy(schema, SUBCLASS)
    tops = schema.sparkSession.createDataFrame([(c,) for c in classes], "cls string")
    below = reach(up.select(F.col("b").alias("a"), F.col("a").alias("b")), tops)
    return tops.unionByName(below.select(F.col("node").alias("cls"))).distinct()


# --- subgraphs -----------------------------------------------------------------------------

def ego_subgraph(triples: DataFrame, centers: list[str], hops: int = 2, limit: int | None = 5000,
                 direction: str = "both", exclude: DataFrame | None = None,
                 max_rounds: int | None = None) -> DataFrame:
    """Triples around the centres; ``hops=h`` runs h+1 rounds, -1 runs until nothing is new. ``triples`` may repeat:
    those that a round finds are made distinct, not all there are.

    ``exclude`` holds schema nodes (column s): triples touching one are left out. The cap
    keeps the nearest triples first, then in term order.
    """
    spark = triples.sparkSession
    t = triples.select(TRIPLE_COLS)
    if exclude is not None:
        x = exclude.select(F.col("s").alias("__x")).distinct()
        t = t.join(x, F.col("s") == F.col("__x"), "left_anti").join(
            x, (F.col("o") == F.col("__x")) & is_node(), "left_anti")
    # both ends of a triple in one pass: where it is met, and what it leads to
    out, back = F.struct(F.col("s").alias("node"), F.when(is_node(), F.col("o")).alias("next")), F.struct(F.col("o").alias("node"), F.col("s").alias("next"))
    sides = {"out": F.array(out), "in": F.when(is_node(), F.array(back)), "both": F.when(is_node(), F.array(out, back)).otherwise(F.array(out))}
    ends = t.select(*TRIPLE_COLS, F.inline(sides[direction]))
    frontier = spark.createDataFrame([(c,) for c in centers], "node string")
    seen, found, depth = [frontier], [], 0
    while hops < 0 or depth <= hops:
        if max_rounds is not None and depth >= max_rounds:
            raise RuntimeError(f"subgraph did not finish within {max_rounds} rounds")
        hit = materialize(ends.join(frontier, "node").select(*TRIPLE_COLS, "next").distinct().withColumn("depth", F.lit(depth)), "ego")
        found.append(hit)
        frontier = materialize(hit.where("next is not null").select(F.col("next").alias("node")).distinct().join(
            _union(seen), "node", "left_anti"), "frontier")
        depth += 1
        if frontier.isEmpty():
            break
        if limit and _union(found).select(TRIPLE_COLS).distinct().limit(limit).count() >= limit:
            break
        seen.append(frontier)
    out = _union(found).groupBy(TRIPLE_COLS).agg(F.min("depth").alias("depth"))
    return order_limit(out, limit, "depth", "s", "p", "o")


def term_signature(triples: DataFrame, skip: list[str]) -> DataFrame:
    """Every IRI of a graph outside the skipped namespaces."""
    terms = F.array(F.when(F.col("s_kind") == "iri", F.col("s")), F.col("p"),
                    F.when(F.col("o_kind") == "iri", F.col("o")))
    out = triples.select(F.explode(terms).alias("term")).where("term is not null").distinct()
    for ns in skip:
        out = out.where(~F.col("term").startswith(ns))
    return out


def schema_module(schema: DataFrame, signature: DataFrame) -> DataFrame:
    """Schema triples reachable upward from the terms in use."""
    s = schema.where(F.col("s_kind") != "literal").select(TRIPLE_COLS)
    edges = s.where(is_node() & (F.col("p") != TYPE)).select(F.col("s").alias("a"), F.col("o").alias("b"))
    start = signature.select(F.col("term").alias("node"))
    nodes = start.unionByName(reach(edges, start)).distinct()
    return s.join(nodes, F.col("s") == F.col("node"), "left_semi").distinct()


def find_by_label(triples: DataFrame, label: str, classes: list[str] | None = None, lang: str | None = None) -> DataFrame:
    hit = triples.where((F.col("p") == LABEL) & (normalized_label("o") == " ".join(label.split()).lower()))
    if lang is not None:
        hit = hit.where(F.col("o_lang") == lang)
    out = hit.select("s").distinct()
    if classes:
        out = semi(out, triples.where((F.col("p") == TYPE) & F.col("o").isin(classes)), "s")
    return out


# --- rule closure ----------------------------------------------------------------------------

class Schema:
    """Schema triples closed once, ready to be joined with instance triples."""

    def __init__(self, schema: DataFrame):
        edges = schema.where(F.col("p").isin([SUBCLASS, SUBPROP, OWL + "equivalentClass", OWL + "equivalentProperty"]) & is_node())

        def closed(sub: str, eq: str) -> DataFrame:
            fwd = edges.where(F.col("p").isin([sub, OWL + eq])).select(F.col("s").alias("a"), F.col("o").alias("b"))
            back = edges.where(F.col("p") == OWL + eq).select(F.col("o").alias("a"), F.col("s").alias("b"))
            return transitive_closure(fwd.unionByName(back))

        self.classes = closed(SUBCLASS, "equivalentClass")
        self.properties = closed(SUBPROP, "equivalentProperty")

        def reaching(p: str) -> DataFrame:
            """(p, c): properties whose subjects or objects get class c, through super-properties
            and super-classes."""
            own = schema.where((F.col("p") == p) & is_node()).select(F.col("s").alias("b"), F.col("o").alias("c"))
            all_p = own.select(F.col("b").alias("p"), "c").unionByName(
                self.properties.join(own, "b").select(F.col("a").alias("p"), "c"))
            up = all_p.join(self.classes.select(F.col("a").alias("c"), F.col("b").alias("d")), "c").select("p", F.col("d").alias("c"))
            return materialize(all_p.unionByName(up).distinct(), "schema")

        self.domains, self.ranges = reaching(DOMAIN), reaching(RANGE)

    def towards(self, classes: DataFrame) -> Schema:
        """The part that leads to the given classes (c)."""
        out = object.__new__(Schema)
        out.properties = self.properties
        out.classes = materialize(among(self.classes, "b", classes), "schema")
        out.domains, out.ranges = (materialize(among(d, "c", classes), "schema") for d in (self.domains, self.ranges))
        return out


def _sub_rows(schema: Schema) -> DataFrame:
    return _union([d.select(*node_triples(F.col("a"), F.lit(p), F.col("b")))
                   for d, p in ((schema.classes, SUBCLASS), (schema.properties, SUBPROP))])


def inferred_types(quads: DataFrame, schema: Schema, keys: tuple = (), distinct: bool = True) -> DataFrame:
    """(keys.., s, c): types that follow from asserted types, domains and ranges.

    Only uses of predicates that have a domain or range are read, and reduced to distinct (node, predicate) before they meet it.
    """
    k = list(keys)
    t = quads.where((F.col("p") == TYPE) & is_node()).select(*k, "s", F.col("o").alias("a")).join(
        schema.classes, "a").select(*k, "s", F.col("b").alias("c"))
    dom = among(quads, "p", schema.domains).select(*k, "s", "p").distinct().join(schema.domains, "p").select(*k, "s", "c")
    rng = among(quads, "p", schema.ranges).where(is_node()).select(*k, F.col("o").alias("s"), "p").distinct().join(schema.ranges, "p").select(*k, "s", "c")
    out = _union([t, dom, rng])
    return out.distinct() if distinct else out


def inferred_links(quads: DataFrame, schema: Schema, keys: tuple = ()) -> DataFrame:
    """Triples under every super-property."""
    rest = [c for c in TRIPLE_COLS if c != "p"]
    return among(quads, "p", schema.properties).join(schema.properties, F.col("p") == F.col("a")).select(
        *keys, *rest, F.col("b").alias("p")).select(*keys, *TRIPLE_COLS)


def rdfs_inferred(quads: DataFrame, schema: Schema, keys: tuple = (), distinct: bool = True) -> DataFrame:
    types = inferred_types(quads, schema, keys, distinct=False).select(*node_triples(F.col("s"), F.lit(TYPE), F.col("c"), *keys))
    out = types.unionByName(inferred_links(quads, schema, keys))
    return out.distinct() if distinct else out


def rdfs_closure(triples: DataFrame, schema_triples: DataFrame | None = None, distinct: bool = True) -> DataFrame:
    """Asserted and inferred triples. With the schema closed first, one pass over the instance
    triples reaches the fixpoint. Without ``distinct`` a triple stands once for every way it comes about."""
    schema = Schema(schema_triples if schema_triples is not None else triples)
    out = _union([triples.select(TRIPLE_COLS), rdfs_inferred(triples, schema, distinct=False), _sub_rows(schema)])
    return out.distinct() if distinct else out


def counts_per_predicate(triples: DataFrame) -> DataFrame:
    """(p, n, subjects): different triples and their subjects. A triple is shuffled once, as hashes: 128 bits of its subject, 64 of
    its object, which only has to differ from the others of its subject and predicate."""
    keys = triples.select("p", F.xxhash64("s").alias("x"), F.xxhash64(F.lit("2nd"), "s").alias("y"),
                          F.xxhash64("s_kind", "o_kind", "o_lang", "o", F.coalesce("o_datatype", F.lit("")), F.col("o_datatype").isNull()).alias("z"))
    each = keys.repartition("x").distinct()
    per = each.groupBy("p", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("p").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("subjects"))


AXIOM_KINDS = {TYPE: "class_assertion", SUBCLASS: "subclass", SUBPROP: "subproperty"}


def inferred_only(triples: DataFrame, schema_triples: DataFrame | None = None) -> DataFrame:
    """Inferred triples that were not asserted, tagged with the kind of axiom."""
    schema = Schema(schema_triples if schema_triples is not None else triples)
    new = rdfs_inferred(triples, schema, distinct=False).unionByName(_sub_rows(schema)).distinct()
    return subtract(new, triples).withColumn("axiom_kind", axiom_kind())


def axiom_kind() -> Column:
    kind = F.lit("property_assertion")
    for p, name in AXIOM_KINDS.items():
        kind = F.when(F.col("p") == p, name).otherwise(kind)
    return kind


def inferred_only_counts(triples: DataFrame, schema_triples: DataFrame | None = None) -> DataFrame:
    """(axiom_kind, p, o, n): how many triples ``inferred_only`` gives per predicate and object. ``triples`` may repeat; no triple is stored,
    and of the asserted ones only those under a predicate that something may be inferred for are shuffled, as hashes."""
    schema = Schema(schema_triples if schema_triples is not None else triples)
    new = rdfs_inferred(triples, schema, distinct=False).unionByName(_sub_rows(schema))
    fixed = triples.sparkSession.createDataFrame([(p,) for p in AXIOM_KINDS], "p string")
    old = among(triples, "p", schema.properties.select(F.col("b").alias("p")).unionByName(fixed))
    return count_fresh(new, old, ("p", "o")).withColumn("axiom_kind", axiom_kind()).select("axiom_kind", "p", "o", "n")


def fresh(new: DataFrame, old: DataFrame, cols: list[str] = TRIPLE_COLS) -> DataFrame:
    """Rows of ``new`` that ``old`` does not hold, each once: one shuffle of both sides, by subject."""
    both = new.select(*cols, F.lit(1).alias("__new")).unionByName(old.select(*cols, F.lit(0).alias("__new")))
    return both.repartition("s").groupBy(*cols).agg(F.min("__new").alias("__new")).where("__new = 1").select(*cols)


def count_fresh(new: DataFrame, old: DataFrame, by: str | tuple[str, ...], cols: list[str] = TRIPLE_COLS) -> DataFrame:
    """(``by``, n): how many rows ``fresh`` gives; instead of the other texts 128-bit hashes are shuffled."""
    by = (by,) if isinstance(by, str) else by
    text = [F.coalesce("o_datatype", F.lit("")), F.col("o_datatype").isNull(), *[c for c in cols if c not in (*by, "o_datatype")]]
    key = [*by, F.xxhash64(*text).alias("x"), F.xxhash64(F.lit("2nd"), *text).alias("y")]
    both = new.select(*key, F.lit(1).alias("__new")).unionByName(old.select(*key, F.lit(0).alias("__new")))
    each = both.repartition("x").groupBy(*by, "x", "y").agg(F.min("__new").alias("__new")).where("__new = 1")
    return each.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def subtract(new: DataFrame, old: DataFrame, cols: list[str] = TRIPLE_COLS) -> DataFrame:
    """Rows of ``new`` that ``old`` does not hold (null-safe on the datatype)."""
    key = [c for c in cols if c != "o_datatype"]
    o = old.select(*key, F.coalesce("o_datatype", F.lit("")).alias("__dt")).distinct()
    return new.withColumn("__dt", F.coalesce("o_datatype", F.lit(""))).join(o, [*key, "__dt"], "left_anti").select(new.columns)


def inverse_materialise(quads: DataFrame, schema_triples: DataFrame, keys: tuple = ()) -> DataFrame:
    """Swapped triples of every property with a declared inverse, in both directions."""
    inv = schema_triples.where((F.col("p") == OWL + "inverseOf") & is_node()).select(F.col("s").alias("pa"), F.col("o").alias("pb"))
    inv = inv.unionByName(inv.select(F.col("pb").alias("pa"), F.col("pa").alias("pb"))).distinct()
    return quads.where(is_node()).join(inv, F.col("p") == F.col("pa")).select(
        *node_triples(F.col("o"), F.col("pb"), F.col("s"), *keys)).distinct()


def components(pairs: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(node, rep): smallest node of each connected component. Labels spread by minimum, which
    combines before the shuffle, and jump along the label found so far."""
    edges = pairs.where(F.col("a") != F.col("b"))
    edges = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "same")
    lab = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("rep")), "rep")
    for _ in _rounds(max_rounds, "components"):
        near = edges.join(lab, edges["b"] == lab["node"]).groupBy(F.col("a").alias("node")).agg(F.min("rep").alias("near"))
        step = lab.join(near, "node").select("node", "rep", F.least("rep", "near").alias("cand"))
        hop = lab.select(F.col("node").alias("cand"), F.col("rep").alias("hop"))
        new = materialize(step.join(hop, "cand", "left").select(
            "node", F.least("cand", F.coalesce("hop", "cand")).alias("rep"), F.col("rep").alias("old")), "rep")
        lab = new.select("node", "rep")
        if new.where("rep <> old").isEmpty():
            return lab


def touching(triples: DataFrame, reps: DataFrame) -> DataFrame:
    """The rows in which a node that has another representative stands, with the representatives as ``__s``, ``__p``, ``__o``."""
    out = triples
    for c in ("s", "p", "o"):
        r = reps.select(F.col("node").alias(f"__n{c}"), F.col("rep").alias(f"__{c}"))
        out = out.join(r, (F.col(c) == F.col(f"__n{c}")) & (is_node() if c == "o" else F.lit(True)), "left").drop(f"__n{c}")
    return out.where("coalesce(__s, __p, __o) IS NOT NULL")


def rewrite(touched: DataFrame) -> DataFrame:
    """``touching`` rows with every node replaced by its representative."""
    return touched.select(*[(F.coalesce(f"__{c}", c) if c in ("s", "p", "o") else F.col(c)).alias(c) for c in TRIPLE_COLS]).distinct()


def list_members(triples: DataFrame) -> DataFrame:
    """(l, member) of RDF lists."""
    first = triples.where((F.col("p") == RDF + "first") & is_node()).select(F.col("s").alias("b"), F.col("o").alias("member"))
    rest = transitive_closure(hierarchy(triples, RDF + "rest"))
    return first.select(F.col("b").alias("l"), "member").unionByName(
        rest.join(first, "b").select(F.col("a").alias("l"), "member")).distinct()


SCHEMA_PREDICATES = [SUBCLASS, SUBPROP, DOMAIN, RANGE, RDF + "first", RDF + "rest"] + [OWL + x for x in (
    "equivalentClass", "equivalentProperty", "inverseOf", "onProperty", "hasValue", "someValuesFrom", "unionOf", "intersectionOf")]
SCHEMA_TYPES = [OWL + x for x in ("SymmetricProperty", "TransitiveProperty", "FunctionalProperty", "InverseFunctionalProperty")]


def is_schema() -> Column:
    """Rows that the schema side of the rules is made of."""
    return F.col("p").isin(SCHEMA_PREDICATES) | (F.col("p") == TYPE) & F.col("o").isin(SCHEMA_TYPES)


class Rules:
    """The schema side of the rules, as stored tables; a rule whose schema side holds nothing is left out of every round."""

    def __init__(self, triples: DataFrame):
        base = materialize(triples.where(is_schema()), "axioms")
        self.schema = Schema(base)
        of_type = lambda c: base.where((F.col("p") == TYPE) & (F.col("o") == OWL + c)).select(F.col("s").alias("p")).distinct()
        pairs = lambda p, a, b: base.where((F.col("p") == OWL + p) & is_node()).select(F.col("s").alias(a), F.col("o").alias(b))
        self.inverse = materialize(pairs("inverseOf", "p", "q").unionByName(pairs("inverseOf", "q", "p").select("p", "q")).unionByName(
            of_type("SymmetricProperty").select("p", F.col("p").alias("q"))).distinct(), "inv")
        self.transitive, self.functional, self.inverse_functional = (materialize(of_type(c), "prop") for c in (
            "TransitiveProperty", "FunctionalProperty", "InverseFunctionalProperty"))
        on_prop = pairs("onProperty", "r", "p")
        self.value = materialize(on_prop.join(base.where(F.col("p") == OWL + "hasValue").select(
            F.col("s").alias("r"), F.col("o").alias("v"), F.col("o_kind").alias("vk"), F.col("o_datatype").alias("vd"),
            F.col("o_lang").alias("vl")), "r"), "hasvalue")
        self.some = materialize(on_prop.join(pairs("someValuesFrom", "r", "c"), "r"), "some")
        members = list_members(base)
        self.union_of = materialize(pairs("unionOf", "c", "l").join(members, "l").select("c", "member").distinct(), "union")
        self.inter = materialize(pairs("intersectionOf", "c", "l").join(members, "l").select("c", "member").distinct(), "inter")
        self.has = {k for k in ("inverse", "transitive", "functional", "inverse_functional", "value", "some", "union_of", "inter") if not getattr(self, k).isEmpty()}

    def derived(self, delta: DataFrame, all_rows: DataFrame) -> DataFrame:
        """What follows from one application of every rule to rows of which at least one is in ``delta``."""
        types = lambda d: d.where((F.col("p") == TYPE) & is_node())
        typing = lambda df: df.select(*node_triples(F.col("s"), F.lit(TYPE), F.col("c")))
        nodes, d_types, a_types, value = delta.where(is_node()), types(delta), types(all_rows), self.value
        out = [rdfs_inferred(delta, self.schema, distinct=False)]
        if "inverse" in self.has:
            out.append(nodes.join(self.inverse, "p").select(*node_triples(F.col("o"), F.col("q"), F.col("s"))))
        if "value" in self.has:  # x type R, R hasValue v on p -> x p v, and back
            out.append(d_types.select("s", F.col("o").alias("r")).join(value, "r").select(
                "s", F.when(F.startswith("s", F.lit("_:")), "bnode").otherwise("iri").alias("s_kind"), "p", F.col("v").alias("o"),
                F.col("vk").alias("o_kind"), F.col("vd").alias("o_datatype"), F.col("vl").alias("o_lang")))
            out.append(typing(delta.join(value, (delta["p"] == value["p"]) & (F.col("o") == F.col("v")) & (F.col("o_kind") == F.col("vk"))
                              & F.col("o_datatype").eqNullSafe(F.col("vd")) & (F.col("o_lang") == F.col("vl"))).select("s", F.col("r").alias("c"))))
        if "union_of" in self.has:
            out.append(typing(d_types.join(self.union_of, F.col("o") == F.col("member")).select("s", "c")))
        if "inter" in self.has:  # every member class gives the intersection, the intersection gives each member
            need = self.inter.groupBy("c").agg(F.count(F.lit(1)).alias("need"))
            out.append(typing(semi(a_types, d_types, "s").select("s", F.col("o").alias("member")).join(self.inter, "member").groupBy("s", "c").agg(
                F.count_distinct("member").alias("n")).join(need, "c").where("n = need").select("s", "c")))
            out.append(typing(d_types.join(self.inter, F.col("o") == F.col("c")).select("s", F.col("member").alias("c"))))
        for left, right in ((delta, all_rows), (all_rows, delta)):
            if "transitive" in self.has:
                a = left.where(is_node()).join(self.transitive, "p").select("s", "p", F.col("o").alias("m"))
                b = right.where(is_node()).select(F.col("s").alias("m"), "p", "o")
                out.append(a.join(b, ["p", "m"]).select(*node_triples(F.col("s"), F.col("p"), F.col("o"))))
            if "some" in self.has:
                x = left.where(is_node()).select("s", "p", F.col("o").alias("y")).join(self.some, "p")
                y = types(right).select(F.col("s").alias("y"), F.col("o").alias("c"))
                thing = x.where(F.col("c") == OWL + "Thing").select("s", F.col("r").alias("c"))
                out.append(typing(x.join(y, ["y", "c"]).select("s", F.col("r").alias("c")).unionByName(thing)))
        return _union(out).distinct()

    def equal(self, delta: DataFrame, all_rows: DataFrame) -> DataFrame:
        """(a, b) nodes that are the same: stated in ``delta``, or two values where ``delta`` added one and a property allows one."""
        out = delta.where((F.col("p") == SAME_AS) & is_node()).select(F.col("s").alias("a"), F.col("o").alias("b"))
        for name, key, other in (("functional", "s", "o"), ("inverse_functional", "o", "s")):
            if name in self.has:
                grown = delta.where(is_node()).join(getattr(self, name), "p").select(F.col(key).alias("k"), "p").distinct()
                d = all_rows.where(is_node()).select(F.col(key).alias("k"), "p", F.col(other).alias("a")).join(grown, ["k", "p"], "left_semi")
                low = d.groupBy("k", "p").agg(F.min("a").alias("b"))
                out = out.unionByName(d.join(low, ["k", "p"]).select("a", "b"))
        return out.where("a <> b").distinct()


def owlrl_closure(triples: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """RDFS plus inverse, symmetric, transitive, functional, equivalence, sameAs, hasValue,
    someValuesFrom, intersection and union rules, to the fixpoint.

    Nodes known to be the same are replaced by their smallest member (one row per sameAs pair
    to the representative is kept), because spelling out every alias would multiply all rows. Only new pairs go into the
    components of a round: earlier ones have been replaced already. Only rows that hold a replaced node are written
    anew. Classes, properties, lists and restrictions may be replaced, or found, like any other node; then the
    schema side of the rules is built again and all rows meet it once more.
    """
    base = triples.select(TRIPLE_COLS).distinct()
    rules = Rules(base)
    parts, same = [materialize(base.unionByName(_sub_rows(rules.schema)).distinct(), "owl")], None
    delta = parts[0]
    for _ in _rounds(max_rounds, "rule closure"):
        all_rows = _union(parts)
        new = materialize(subtract(rules.derived(delta, all_rows), all_rows), "owl")
        grown = _union([*parts, new])
        eq = materialize(rules.equal(delta.unionByName(new), grown), "eq")
        if same is not None:  # what has been replaced already says nothing new
            eq = materialize(eq.join(same.select(F.col("node").alias("a"), F.col("rep").alias("b")), ["a", "b"], "left_anti"), "eq")
        changed = new.where(is_schema())
        if eq.isEmpty():
            if new.isEmpty():
                return all_rows
            parts, delta, again = [*parts, new], new, not changed.isEmpty()
        else:
            reps = materialize(components(eq).where("node <> rep"), "reps")
            known = reps if same is None else same.join(reps.toDF("rep", "__r"), "rep", "left").select("node", F.coalesce("__r", "rep").alias("rep")).unionByName(reps)
            same = materialize(known, "same")
            rows = grown.where(F.col("p") != SAME_AS)
            touched = materialize(touching(rows, reps), "touched")
            written = rewrite(touched).unionByName(same.select(*node_triples(F.col("node"), F.lit(SAME_AS), F.col("rep"))))
            rest = subtract(rows, touched.select(TRIPLE_COLS))
            kept = subtract(new.where(F.col("p") != SAME_AS), touched.select(TRIPLE_COLS))
            delta = materialize(subtract(written.distinct(), rest).unionByName(kept).distinct(), "owl")
            parts = [materialize(subtract(rest, delta), "owl"), delta]
            again = not (touched.where(is_schema()).isEmpty() and changed.isEmpty())
        if again:
            rules = Rules(_union(parts))
            closed = subtract(_sub_rows(rules.schema).distinct(), _union(parts))
            parts = [materialize(_union([*parts, closed]), "owl")]
            delta = parts[0]
        elif len(parts) > MANY:
            parts = [materialize(_union(parts), "owl")]


# --- contradictions and isolation -------------------------------------------------------------

VIOLATION = ["graph", "rule", "node", "detail_1", "detail_2"]


def consistency_report(quads: DataFrame, schema_triples: DataFrame, schema: Schema | None = None) -> DataFrame:
    """Contradictions that joins can find, per graph: (graph, rule, node, detail_1, detail_2)."""
    schema = schema or Schema(schema_triples)
    dis = schema_triples.where((F.col("p") == OWL + "disjointWith") & is_node()).select(
        F.least("s", "o").alias("c"), F.greatest("s", "o").alias("d")).distinct()
    # a class takes one side of every axiom that names it; a member of both sides clashes
    nothing = dis.sparkSession.range(1).select(F.lit("nothing_member").alias("rule"), F.lit(OWL + "Nothing").alias("c"), F.lit("").alias("d"))
    axioms = dis.select(F.lit("disjoint_classes").alias("rule"), "c", "d").unionByName(nothing)
    sides = materialize(axioms.select("rule", "c", "d", F.col("c").alias("cls"), F.lit(1).alias("left"), (F.col("d") == "").cast("int").alias("right")).unionByName(
        dis.select(F.lit("disjoint_classes").alias("rule"), "c", "d", F.col("d").alias("cls"), F.lit(0).alias("left"), F.lit(1).alias("right"))), "sides")
    # only memberships in classes that some axiom mentions are looked for
    mentioned = sides.select(F.col("cls").alias("c")).distinct()
    own = among(quads.where((F.col("p") == TYPE) & is_node()), "o", mentioned).select("graph", "s", F.col("o").alias("cls"))
    full = own.unionByName(inferred_types(quads, schema.towards(mentioned), ("graph",), distinct=False).withColumnRenamed("c", "cls"))
    clash = full.join(sides, "cls").groupBy("graph", "rule", "s", "c", "d").agg(F.max("left").alias("left"), F.max("right").alias("right")).where(
        "left = 1 AND right = 1").select("graph", "rule", F.col("s").alias("node"), F.col("c").alias("detail_1"), F.col("d").alias("detail_2"))
    fun = schema_triples.where((F.col("p") == TYPE) & (F.col("o") == OWL + "FunctionalProperty")).select(F.col("s").alias("p")).distinct()
    # one row for every value that clashes with the smallest one
    single = among(quads.where(~is_node()), "p", fun).select("graph", "s", "p", "o").distinct()
    least = single.groupBy("graph", "s", "p").agg(F.min("o").alias("lo"))
    two = single.join(least, ["graph", "s", "p"]).where("lo <> o").select("graph", F.lit("functional_clash").alias("rule"), F.col("s").alias("node"), F.col("lo").alias("detail_1"), F.col("o").alias("detail_2"))
    both = quads.where(F.col("p").isin([SAME_AS, OWL + "differentFrom"]) & is_node()).groupBy(
        "graph", F.least("s", "o").alias("a"), F.greatest("s", "o").alias("b")).agg(
        F.min("p").alias("lo"), F.max("p").alias("hi")).where("lo <> hi")
    both = both.select("graph", F.lit("same_and_different").alias("rule"), F.col("a").alias("node"), F.col("b").alias("detail_1"), F.lit("").alias("detail_2"))
    return _union([clash, two, both]).distinct()


def per_graph_reason(quads: DataFrame, schema_triples: DataFrame) -> dict[str, DataFrame]:
    """Every named graph reasoned on its own, all in one job.

    Returns ``violations``, ``sizes`` (graph, n: asserted quads), ``status`` (graph, consistent, violations), ``inferences``
    (only of consistent graphs; an inconsistent graph keeps its asserted data) and their ``counts`` (graph, inferred), for which
    no inferred text is shuffled. Violations and sizes are stored; the rest is computed where it is used.
    """
    schema = Schema(schema_triples)
    bad = materialize(consistency_report(quads, schema_triples, schema), "violations")
    counts = bad.groupBy("graph").agg(F.count(F.lit(1)).alias("violations"))
    sizes = materialize(quads.groupBy("graph").agg(F.count(F.lit(1)).alias("n")), "sizes")
    status = sizes.select("graph").join(counts, "graph", "left").select(
        "graph", F.col("violations").isNull().alias("consistent"), F.coalesce("violations", F.lit(0)).alias("violations"))
    good = quads.join(counts.select("graph"), "graph", "left_anti")
    new = rdfs_inferred(good, schema, ("graph",), distinct=False)
    # asserted rows can only equal an inferred one where they are types or uses of a super-property
    heads = schema.properties.select(F.col("b").alias("p")).unionByName(quads.sparkSession.range(1).select(F.lit(TYPE).alias("p")))
    old = among(good, "p", heads)
    counts_new = count_fresh(new, old, "graph", QUAD_COLS).withColumnRenamed("n", "inferred")
    return {"violations": bad, "sizes": sizes, "status": status, "inferences": fresh(new, old, QUAD_COLS), "counts": counts_new}


def flatten_inferences(inferences: DataFrame, status: DataFrame) -> DataFrame:
    ok = status.where("consistent").select("graph")
    return inferences.join(ok, "graph", "left_semi").select(TRIPLE_COLS).distinct()
