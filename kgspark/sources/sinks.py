"""Writers: metric tables, quad files, published graphs, manifests."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kgspark.functions.scalars import graph_stem, nt_line
from kgspark.model import METRIC_TABLES, QUAD_COLS
from kgspark.operators.ordinal import chunk_lines
from kgspark.operators.pattern import latest, strip_bnodes
from kgspark.session import materialize, path_exists, remove_path


# --- metric tables -----------------------------------------------------------------------------

def stamp(df: DataFrame, table: str, now: dt.datetime) -> DataFrame:
    """Rows of a metric table with the one timestamp of the run, in the table's column order."""
    schema = METRIC_TABLES[table][0]
    return df.withColumn("ts_utc", F.lit(now)).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def create_tables(spark: SparkSession, database: str = "default") -> None:
    for name, (schema, _) in METRIC_TABLES.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet")


def append_metric(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("ts_utc").parquet(path)


def replace_metric(df: DataFrame, path: str) -> None:
    """Overwrite a table that the rows themselves may have been read from: they are written
    to the shared folder first."""
    materialize(df, "replace").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def latest_views(tables: dict[str, DataFrame], prefix: str = "") -> dict[str, DataFrame]:
    """One view per metric table, limited to graphs with the prefix."""
    out = {}
    for name, df in tables.items():
        key = METRIC_TABLES[name][1]
        out[name] = latest(df.where(F.col("graph").startswith(prefix)), key)
    return out


# --- quads ----------------------------------------------------------------------------------------

#: Files per graph of a line writer.
FILES = 16
#: Bytes of text that published graphs are packed to.
PACK_BYTES = 256 << 20


def nquads_lines(quads: DataFrame) -> DataFrame:
    """(graph, line) without blank-node triples."""
    return strip_bnodes(quads).select("graph", nt_line().alias("line"))


def write_nquads(quads: DataFrame, path: str, with_graph: bool = True) -> None:
    """Line files per graph in a folder named by the graph's hashed stem, at most ``FILES`` of them: rows are
    dealt by graph and a hash of the line, so neither many graphs nor a huge one makes too many or too large tasks.
    Files are compressed: IRIs repeat."""
    q = strip_bnodes(quads).select(graph_stem("graph").alias("graph_stem"), nt_line(with_graph).alias("value"))
    q.repartition("graph_stem", F.pmod(F.xxhash64("value"), F.lit(FILES))).write.mode("overwrite").option(
        "compression", "gzip").partitionBy("graph_stem").text(path)


def publishable(quads: DataFrame, default_iri: str | None = None, default: str = "urn:default") -> DataFrame:
    """The default graph redirected to a metadata graph; empty graphs have no rows to publish."""
    if default_iri is None:
        return quads.select(QUAD_COLS)
    return quads.withColumn("graph", F.when(F.col("graph") == default, default_iri).otherwise(F.col("graph"))).select(QUAD_COLS)


MAP = "graph STRING, part STRING, bytes BIGINT, files INT, run STRING, slot INT"


def partition_map(spark: SparkSession, path: str) -> DataFrame:
    """Where each published graph lies: (graph, part, bytes, files, run, slot)."""
    where = f"{path.rstrip('/')}-map"
    return spark.read.schema(MAP).parquet(where) if path_exists(spark, where) else spark.createDataFrame([], MAP)


def _placed(sizes: DataFrame, old: DataFrame, run: str, pack_bytes: int) -> DataFrame:
    """The map rows of ``sizes`` (graph, bytes): graphs above the bound get a part of their own, small ones stay in their
    pack up to twice the bound, and the other small ones are put together up to the bound."""
    own = F.concat(F.lit("own-"), F.substring(F.sha2("graph", 256), 1, 32))
    big = F.col("bytes") > pack_bytes
    here = old.where(F.col("part").startswith("pack-")).join(sizes.select("graph", F.col("bytes").alias("new")), "graph", "left")
    load = here.groupBy("part").agg(F.sum(F.coalesce("new", "bytes")).alias("load"))
    room = here.where("new IS NOT NULL").join(load, "part").where(F.col("load") <= 2 * pack_bytes).select("graph", F.col("part").alias("old"))
    known = sizes.join(room, "graph", "left").withColumn("part", F.when(big, own).otherwise(F.col("old")))
    put = known.where("part IS NOT NULL").select("graph", "part", "bytes")
    loose = known.where("part IS NULL")
    # packs are filled within salts of some 64 packs, so no task numbers all graphs
    total = loose.agg(F.sum("bytes")).first()[0] or 0
    salts = max(1, total // (64 * pack_bytes))
    salt = F.pmod(F.xxhash64("graph"), F.lit(salts))
    upto = F.sum("bytes").over(Window.partitionBy("salt").orderBy("graph").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    packed = loose.withColumn("salt", salt).withColumn("k", F.floor((upto - F.lit(1)) / pack_bytes))
    packed = packed.select("graph", F.concat_ws("-", F.lit("pack"), F.lit(run), F.col("salt").cast("string"), F.col("k").cast("string")).alias("part"), "bytes")
    return put.unionByName(packed).select("graph", "part", "bytes", F.greatest(F.lit(1), F.ceil(F.col("bytes") / pack_bytes)).cast("int").alias("files"),
                                          F.lit(run).alias("run"), F.pmod(F.xxhash64("graph"), F.lit(64)).cast("int").alias("slot"))


def publish_graphs(quads: DataFrame, path: str, delete_first: bool = True, pack_bytes: int = PACK_BYTES, run: str | None = None) -> None:
    """Drop-and-replace per graph; without ``delete_first`` the rows are added to their graphs.

    A table beside the published one maps graphs to parts by size: a graph of more than ``pack_bytes`` bytes of text is
    a part of its own, spread over files by a hash of the triple; smaller ones are packed up to that bound, which one graph may pass. Publishing
    a graph rewrites its part, that is, at most itself or one pack, by dynamic partition overwrite. A graph leaves a pack
    that would grow beyond twice the bound.

    Graphs that ``run`` has already published are added to, not replaced, so a run may publish a graph in several steps.
    The rows are written before the map: a publication that failed is simply repeated.
    """
    spark = quads.sparkSession
    run = run or uuid.uuid4().hex[:12]
    where = f"{path.rstrip('/')}-map"
    new = materialize(quads.select(QUAD_COLS), "publish")
    named = new.select("graph").distinct()
    old = partition_map(spark, path)
    here = old.join(named, "graph", "left_semi")
    keep = here if not delete_first else here.where(F.col("run") == run)
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in QUAD_COLS[1:]), F.octet_length("graph"))
    if not keep.isEmpty():
        held = stored_graphs(spark, path, keep)
        new = materialize(new.unionByName(held).distinct() if delete_first else new.unionByName(held), "publish")
    sizes = new.groupBy("graph").agg(F.sum(text.cast("bigint")).alias("bytes"))
    near = old.join(here.select("part").distinct(), "part", "left_semi").select(old.columns)
    placed = materialize(_placed(sizes, near, run, pack_bytes), "map")
    touched = here.select("part").union(placed.select("part")).distinct()
    rest = old.join(touched, "part", "left_semi").join(named, "graph", "left_anti")  # graphs that share a part with those
    rows = new.join(placed.select("graph", "part", "files"), "graph")
    if not rest.isEmpty():
        carried = stored_graphs(spark, path, rest).join(rest.select("graph", "part", "files"), "graph")
        rows = materialize(rows.unionByName(carried), "publish")
    empty = [r["part"] for r in here.select("part").distinct().join(placed.union(rest.select(placed.columns)).select("part"), "part", "left_anti").collect()]
    rows.repartition("part", F.pmod(F.xxhash64("s", "p", "o"), F.col("files"))).drop("files").sortWithinPartitions("part", "graph", "p", "s").write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    slots = placed.select("slot").distinct()
    merged = placed.unionByName(old.join(slots, "slot", "left_semi").join(named, "graph", "left_anti").select(placed.columns))
    materialize(merged, "map").repartition("slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(where)
    for part in empty:  # packs whose graphs have all moved out
        remove_path(spark, f"{path.rstrip('/')}/part={part}")


def stored_graphs(spark: SparkSession, path: str, located: DataFrame) -> DataFrame:
    """Rows of the published graphs ``located`` (graph, part); only their parts are read."""
    return spark.read.parquet(path).join(located.select("graph", "part"), ["graph", "part"], "left_semi").select(QUAD_COLS)


def read_graphs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(QUAD_COLS)


def write_chunks(quads: DataFrame, path: str, target_bytes: int = 5 * 1024 * 1024) -> None:
    """Statement-bounded chunks of each graph, one folder and one file per chunk."""
    c = chunk_lines(nquads_lines(quads), target_bytes)
    c.select(graph_stem("graph").alias("graph_stem"), "chunk", F.col("line").alias("value")).repartition("graph_stem", "chunk").write.mode("overwrite").partitionBy(
        "graph_stem", "chunk").text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(graph_stem, chunk, line) of written chunks; a chunk can be read without the others."""
    return spark.read.schema("line STRING, graph_stem STRING, chunk BIGINT").text(path).select("graph_stem", "chunk", "line")


# --- delimited and JSON ---------------------------------------------------------------------------

def with_directive_row(df: DataFrame, directives: list[str]) -> DataFrame:
    """The table as text with its directive row in front (``__pos`` 0)."""
    body = df.select(F.lit(1).alias("__pos"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    head = df.sparkSession.createDataFrame([(0, *directives)], body.schema)
    return head.unionByName(body)


def write_tsv(df: DataFrame, path: str, directives: list[str] | None = None) -> None:
    out = with_directive_row(df, directives).orderBy("__pos", *df.columns[:1]).drop("__pos") if directives else df
    out.write.mode("overwrite").options(sep="\t", header=True, emptyValue="").csv(path)


def write_metric_csv(df: DataFrame, path: str, *order: str) -> None:
    """Sorted delimited output of a bounded metric or counter table."""
    df.orderBy(*[F.asc_nulls_last(c) for c in (order or df.columns)]).write.mode("overwrite").option("header", True).csv(path)


def manifest_rows(per_graph: DataFrame, status: str = "status") -> DataFrame:
    """JSON lines of a run: one per graph and one with the rolled-up counts. Graphs are never
    gathered into one document, so a run over very many graphs stays spread."""
    graphs = per_graph.select(F.lit("graph").alias("part"), F.to_json(F.struct(*per_graph.columns)).alias("json"))
    total = per_graph.groupBy(status).agg(F.count(F.lit(1)).alias("n")).groupBy().agg(
        F.sum("n").alias("graphs"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(status, "n")))).alias("by_status"))
    return graphs.unionByName(total.select(F.lit("summary").alias("part"), F.to_json(F.struct("graphs", "by_status")).alias("json")))


def release_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """Releases newest first with the latest one flagged. (version, publish_date, stage, triples)"""
    rows = new.unionByName(old).distinct()
    top = rows.agg(F.max_by("version", F.struct("publish_date", "version")).alias("latest"))
    out = rows.join(top.withColumn("__l", F.col("latest")), rows["version"] == F.col("latest"), "left")
    return out.select(*rows.columns, F.col("__l").isNotNull().alias("is_latest")).orderBy(F.desc("publish_date"), F.desc("version"), "stage")


def dump_graphs(quads: DataFrame, stages: dict[str, str], version: str) -> DataFrame:
    """Quads of each stage's graph under ``<stage>_v<version>``; missing graphs are skipped,
    and a release without any graph is an error."""
    m = F.create_map(*[F.lit(x) for g, s in stages.items() for x in (g, f"{s}_v{version}")])
    out = quads.where(F.col("graph").isin(list(stages))).withColumn("dump", m[F.col("graph")])
    if out.limit(1).isEmpty():
        raise ValueError("no graph to dump")
    return out


def write_dumps(quads: DataFrame, stages: dict[str, str], version: str, path: str) -> None:
    """Versioned dump: compressed N-Quads files of each stage's graph in a folder named ``<stage>_v<version>``. A version is written once; a
    second attempt replaces its own folders only. There are few stages, so every task writes what it reads, one file a stage, and nothing is shuffled."""
    out = dump_graphs(quads, stages, version).select("dump", nt_line().alias("value"))
    out.write.option("compression", "gzip").mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dump").text(path)


def read_dumps(spark: SparkSession, path: str) -> DataFrame:
    """(dump, line) of all versions under ``path``."""
    return spark.read.schema("line STRING, dump STRING").text(path).select("dump", "line")
