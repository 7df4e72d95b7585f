"""Graph patterns over quads: triples, joins, optional blocks, unions, top-N, snapshots.

Joins carry no broadcast hint: label and schema sides grow with the data, so the choice is
left to the adaptive planner, which broadcasts a side only below its size threshold and
splits skewed partitions of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kgspark.functions.scalars import english
from kgspark.model import LABEL, TRIPLE_COLS, TYPE
from kgspark.session import materialize


# --- triple patterns -------------------------------------------------------------------

def match(quads: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None,
          graph: str | None = None, cond: Column | None = None) -> DataFrame:
    """Quads fitting the given terms and an optional column condition."""
    for name, v in (("graph", graph), ("s", s), ("p", p), ("o", o)):
        if v is not None:
            quads = quads.where(F.col(name) == v)
    return quads if cond is None else quads.where(cond)


def exists(quads: DataFrame, **kw) -> bool:
    return not match(quads, **kw).limit(1).isEmpty()


def in_graphs(quads: DataFrame, graphs: list[str]) -> DataFrame:
    return quads.where(F.col("graph").isin(graphs))


def typed(quads: DataFrame, cls, var: str = "s", *keep: str) -> DataFrame:
    """Subjects of one class or a list of classes."""
    classes = [cls] if isinstance(cls, str) else list(cls)
    hit = quads.where((F.col("p") == TYPE) & (F.col("o_kind") != "literal") & F.col("o").isin(classes))
    return hit.select(*keep, F.col("s").alias(var)).distinct()


def link(quads: DataFrame, p: str, a: str, b: str, *keep: str) -> DataFrame:
    """``?a p ?b`` where ?b is a node and may be joined to subjects."""
    return quads.where((F.col("p") == p) & (F.col("o_kind") != "literal")).select(
        *keep, F.col("s").alias(a), F.col("o").alias(b))


def value(quads: DataFrame, p: str, a: str, b: str, *keep: str, cond: Column | None = None) -> DataFrame:
    """``?a p ?b`` where ?b is only shown (any kind of term)."""
    hit = quads.where(F.col("p") == p)
    if cond is not None:
        hit = hit.where(cond)
    return hit.select(*keep, F.col("s").alias(a), F.col("o").alias(b))


def labels(quads: DataFrame, a: str, b: str) -> DataFrame:
    return value(quads, LABEL, a, b)


def _english(quads: DataFrame, a: str, b: str, of: DataFrame | None) -> DataFrame:
    lab = value(quads, LABEL, a, b, cond=english("o_lang"))
    return lab if of is None else lab.join(of.select(a).distinct(), a, "left_semi")


def english_labels(quads: DataFrame, a: str, b: str, of: DataFrame | None = None) -> DataFrame:
    """Labels of the union of all graphs, English or untagged, each once.

    ``of`` names the nodes in question (column ``a``): labels of other nodes are dropped by a
    semi join before they are shuffled, which matters where only classes are labelled.
    """
    return _english(quads, a, b, of).distinct()


def sample_labels(quads: DataFrame, a: str, b: str, of: DataFrame | None = None) -> DataFrame:
    """One English label per node: the smallest, so that reruns agree."""
    return _english(quads, a, b, of).groupBy(a).agg(F.min(b).alias(b))


def via_node(quads: DataFrame, p: str, prop: str, a: str, b: str, cls: str | None = None,
             node: str | None = None) -> DataFrame:
    """Block ``?a p ?n . [?n a cls .] ?n prop ?b``, joined inside before any outer join."""
    n = node or f"__{b}_node"
    out = link(quads, p, a, n)
    if cls:
        out = out.join(typed(quads, cls, n), n)
    out = out.join(value(quads, prop, n, b), n)
    return out if node else out.drop(n)


# --- joins -----------------------------------------------------------------------------

def bgp(*patterns: DataFrame) -> DataFrame:
    """Inner join of patterns, left to right, on the variables they share."""
    out = patterns[0]
    for nxt in patterns[1:]:
        shared = [c for c in out.columns if c in nxt.columns]
        if not shared:
            raise ValueError("patterns share no variable; a cross product is refused")
        out = out.join(nxt, shared)
    return out


def optional(df: DataFrame, *blocks: DataFrame) -> DataFrame:
    """Left join of each finished block on the variables it shares with the left side."""
    for b in blocks:
        shared = [c for c in df.columns if c in b.columns]
        if not shared:
            raise ValueError("the optional block shares no variable; a cross product is refused")
        df = df.join(b, shared, "left")
    return df


def optional_bound(df: DataFrame, block: DataFrame, key: str, var: str) -> DataFrame:
    """OPTIONAL that shares ``var`` with an earlier block: a bound ``var`` must agree, an
    unbound one is bound by this block."""
    extra = [c for c in block.columns if c not in (key, var)]
    b = block.select(F.col(key), F.col(var).alias("__v"), *extra)
    out = df.join(b, (df[key] == b[key]) & (df[var].isNull() | (df[var] == b["__v"])), "left").drop(b[key])
    return out.withColumn(var, F.coalesce(var, "__v")).drop("__v")


def values_join(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(values))


def not_exists(df: DataFrame, *alternatives: DataFrame, on: list[str]) -> DataFrame:
    """Rows with no partner in any alternative."""
    right = alternatives[0].select(on)
    for a in alternatives[1:]:
        right = right.unionByName(a.select(on))
    return df.join(right.distinct(), on, "left_anti")


def semi(df: DataFrame, right: DataFrame, on) -> DataFrame:
    on = [on] if isinstance(on, str) else on
    return df.join(right.select(on).distinct(), on, "left_semi")


def path_chain(df: DataFrame, quads: DataFrame, start: str, *steps: tuple[str, str]) -> DataFrame:
    """Fixed-length property path: one equi-join per (predicate, variable)."""
    here = start
    for i, (p, var) in enumerate(steps):
        get = value if i == len(steps) - 1 else link
        df = df.join(get(quads, p, here, var), here)
        here = var
    return df


# --- sets ------------------------------------------------------------------------------

def union_graph(quads: DataFrame) -> DataFrame:
    """The triples of all graphs as one set."""
    return quads.select(TRIPLE_COLS).distinct()


def merge(*quads: DataFrame, graph: str) -> DataFrame:
    out = quads[0]
    for q in quads[1:]:
        out = out.unionByName(q)
    return union_graph(out).select(F.lit(graph).alias("graph"), *TRIPLE_COLS)


def pattern_union(*parts: DataFrame, distinct: bool = False) -> DataFrame:
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out.distinct() if distinct else out


def insert_absent(target: DataFrame, new: DataFrame) -> DataFrame:
    """The target plus those new rows it does not hold yet."""
    keys = target.columns
    same = None
    t = target.select(*[F.col(c).alias("__" + c) for c in keys])
    for c in keys:
        eq = F.col(c).eqNullSafe(F.col("__" + c))
        same = eq if same is None else same & eq
    return target.unionByName(new.distinct().join(t, same, "left_anti"))


def delete_where(quads: DataFrame, s: str, p: str, o: str) -> DataFrame:
    return quads.where(~((F.col("s") == s) & (F.col("p") == p) & (F.col("o") == o)))


def strip_bnodes(quads: DataFrame) -> DataFrame:
    return quads.where((F.col("s_kind") != "bnode") & (F.col("o_kind") != "bnode"))


def drop_terms(quads: DataFrame, terms: DataFrame, chain_property: str | None = None,
               chain_predicate: str | None = None) -> DataFrame:
    """Remove every triple mentioning a listed term in any position; for one property only
    its chain axioms."""
    out = quads
    if chain_property:
        out = out.where(~((F.col("s") == chain_property) & (F.col("p") == chain_predicate)))
    t = terms.select(F.col(terms.columns[0]).alias("__t")).distinct()
    for pos in ("s", "p"):
        out = out.join(t, F.col(pos) == F.col("__t"), "left_anti")
    return out.join(t, (F.col("o") == F.col("__t")) & (F.col("o_kind") == "iri"), "left_anti")


def drop_individuals(quads: DataFrame, named_individual: str, class_types: list[str]) -> DataFrame:
    """Keep the schema: drop triples of named individuals and of members of declared classes."""
    types = quads.where((F.col("p") == TYPE) & (F.col("o_kind") == "iri"))
    declared = materialize(types.where(F.col("o").isin(class_types)).select(F.col("s").alias("o")).distinct(), "declared")
    members = types.select("s", "o").join(declared, "o").select("s")
    named = types.where(F.col("o") == named_individual).select("s")
    return without(quads, materialize(members.unionByName(named).distinct(), "individuals"), "s")


def without(df: DataFrame, stored: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is not in a stored set of keys. An outer join, because Spark would push an anti join into every rule of a
    view and plan the keys as many times."""
    keys = stored.select(F.col(stored.columns[0]).alias("__key"))
    return df.join(keys, F.col(column) == F.col("__key"), "left").where("__key IS NULL").drop("__key")


# --- windows, sorts, limits --------------------------------------------------------------

def _order(cols, df: DataFrame) -> list[Column]:
    out = []
    for c in cols:
        if isinstance(c, str):
            name, desc = (c[1:], True) if c.startswith("-") else (c, False)
            out.append(F.desc_nulls_last(name) if desc else F.asc_nulls_last(name))
        else:
            out.append(c)
    return out


def order_limit(df: DataFrame, n: int | None, *cols: str) -> DataFrame:
    """ORDER BY with every remaining column as tie-break, then LIMIT; ``-c`` is descending."""
    named = {c.lstrip("-") for c in cols}
    full = list(cols) + [c for c in df.columns if c not in named]
    out = df.orderBy(*_order(full, df))
    return out if n is None else out.limit(n)


def page(df: DataFrame, offset: int, n: int, *cols: str) -> DataFrame:
    named = {c.lstrip("-") for c in cols}
    full = list(cols) + [c for c in df.columns if c not in named]
    return df.orderBy(*_order(full, df)).offset(offset).limit(n)


def top_n(df: DataFrame, n: int, by: list[str], order: list[str], rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each group. The rank filter is pushed below the shuffle (partial
    group limit), so a hot group sends at most ``n`` rows per task."""
    name = rank or "__rn"
    w = Window.partitionBy(*by).orderBy(*_order(order, df))
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def first_combinations(entities: DataFrame, lists: list[tuple[DataFrame, str]], n: int, by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows (of each group ``by``) of the entities joined left with every list, in the order of the columns.

    ``lists`` are (rows, column) pairs that share columns with the entities; a row is one choice out of each list. The product is
    never built: every entity has at least one combination, so the first n entities are enough, and of each list its first n values.
    How many combinations an entity has is known from the lengths, entities are cut by their running sum, and the combinations
    that are left, at most n, are enumerated by number.
    """
    by = by or []
    cols = [c for c in entities.columns if c not in by]
    entities = entities.distinct()
    out = top_n(entities, n, by, cols) if by else order_limit(entities, n, *cols)
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*_order(cols, out)).rowsBetween(Window.unboundedPreceding, -1)
    for i, (rows, name) in enumerate(lists):
        shared = [c for c in rows.columns if c in out.columns and c != name]
        mine = semi(rows.select(*shared, name).distinct(), out, shared)
        first = top_n(mine, n, shared, [name]).groupBy(*shared).agg(F.sort_array(F.collect_list(name)).alias(f"__l{i}"))
        out = out.join(first, shared, "left").withColumn(f"__l{i}", F.coalesce(f"__l{i}", F.array(F.lit(None))))
    sizes = [F.size(f"__l{i}").cast("bigint") for i in range(len(lists))]
    product = F.lit(1).cast("bigint")
    for size in sizes:
        product = F.least(product * size, F.lit(n).cast("bigint"))
    out = out.withColumn("__some", product).withColumn("__before", F.coalesce(F.sum("__some").over(order), F.lit(0)))
    out = out.where(F.col("__before") < n).withColumn("__k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.least("__some", n - F.col("__before")) - 1)))
    rest, chosen = F.col("__k"), {}
    for i in range(len(lists) - 1, -1, -1):
        chosen[i] = F.element_at(f"__l{i}", (rest % sizes[i]).cast("int") + 1).alias(lists[i][1])
        rest = F.floor(rest / sizes[i]).cast("bigint")
    return out.select(*entities.columns, *[chosen[i] for i in range(len(lists))])


def latest(df: DataFrame, key: list[str] | None, ts: str = "ts_utc") -> DataFrame:
    """Newest row per key; ties broken by all remaining columns. No key: unchanged."""
    if not key:
        return df
    rest = [c for c in df.columns if c not in key and c != ts]
    return top_n(df, 1, key, ["-" + ts] + rest)


def first_wins(df: DataFrame, key: str, val: str, order: str, last: bool = False) -> DataFrame:
    pick = F.max_by if last else F.min_by
    return df.groupBy(key).agg(pick(val, order).alias(val))
