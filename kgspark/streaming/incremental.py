"""Incremental jobs on Structured Streaming: change detection, re-sync, snapshots, upserts.

The remembered state of harvested graphs is keyed state of a streaming query (``transformWithState`` in
RocksDB with changelog checkpoints), so a batch writes what it changes and no more. Its folder
is the query's checkpoint and belongs to one state.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from kgspark.session import path_exists, remove_path
from kgspark.sources.sinks import publish_graphs, read_graphs  # noqa: F401

STATE = "graph_iri STRING, sha256 STRING, version STRING, harvested_at STRING, registered_from STRING"
REMEMBERED = "sha256 STRING, version STRING, harvested_at STRING, registered_from STRING, epoch INT"
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


@contextlib.contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The session's state store is RocksDB with changelogs while a query is started and run."""
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _detector() -> StatefulProcessor:
    """Made inside a function, so that it travels with the job."""

    class Detect(StatefulProcessor):
        """The newest record of a graph in the batch against the remembered one; older epochs are forgotten."""

        def init(self, handle) -> None:
            self.known = handle.getValueState("known", REMEMBERED)

        def handleInputRows(self, key, rows, timerValues):
            new = max(rows, key=lambda r: (r.harvested_at or "", r.sha256 or ""))
            held = self.known.get()
            was = held if held is not None and held[4] == new.epoch else None
            change = "new" if was is None else "unchanged" if was[0] == new.sha256 else "changed"
            self.known.update((new.sha256, new.version, new.harvested_at, new.registered_from, new.epoch))
            yield Row(graph_iri=key[0], change=change)

        def close(self) -> None:
            pass

    return Detect()


def _epoch(spark: SparkSession, root: str, resync: bool) -> int:
    """The number of re-syncs begun so far. One that has not ended goes on under its number, before anything else."""
    begun = sorted(json.loads(r[0])["epoch"] for r in spark.read.text(f"{root}/epochs/begun").collect()) if path_exists(spark, f"{root}/epochs/begun") else []
    ended = begun and path_exists(spark, f"{root}/epochs/ended-{begun[-1]}/_SUCCESS")
    if begun and not ended:
        if not resync:
            raise RuntimeError("a re-sync has not ended: run it again first")
        return begun[-1]
    if resync:
        spark.createDataFrame([(json.dumps({"epoch": len(begun) + 1}),)], "value string").coalesce(1).write.mode("append").text(f"{root}/epochs/begun")
        return len(begun) + 1
    return len(begun)


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """What is remembered now: the rows of ``STATE``, read from the state store."""
    if not path_exists(spark, f"{root}/query/commits"):
        return spark.createDataFrame([], STATE)
    epoch = len(spark.read.text(f"{root}/epochs/begun").collect()) if path_exists(spark, f"{root}/epochs/begun") else 0
    with state_store(spark):
        rows = spark.read.format("statestore").option("stateVarName", "known").load(f"{root}/query")
        return rows.where(F.col("value.epoch") == epoch).select(F.col("key.graph_iri").alias("graph_iri"), *[F.col(f"value.{c}").alias(c) for c in ("sha256", "version", "harvested_at", "registered_from")])


def run_change_detection(spark: SparkSession, landing: str, state_root: str, report: str, resync: bool = False, max_files: int | None = None) -> None:
    """Take in landed harvest files and classify every graph against the remembered state.

    Each run reads the files of ``landing`` that no run has read; graphs that a batch does not mention keep their state. A full
    re-sync ignores what was remembered before it began (not its own earlier batches); later runs go on from its state.
    The report has one folder per batch, which a repeated batch writes again.
    """
    root = state_root.rstrip("/")
    epoch = _epoch(spark, root, resync)
    reader = spark.readStream.schema(STATE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # a pattern, because the source of a checkpoint may only change its path if that is no single folder
    seen = reader.json(f"{landing.rstrip('/')}/*").where("graph_iri IS NOT NULL").withColumn("epoch", F.lit(epoch))
    changes = seen.groupBy("graph_iri").transformWithState(_detector(), "graph_iri STRING, change STRING", "Update", "None")

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{report}/batch={batch_id}")

    with state_store(spark):
        q = changes.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", f"{root}/query").trigger(availableNow=True).start()
        q.awaitTermination()
    if resync:
        spark.createDataFrame([("ended",)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/epochs/ended-{epoch}")


def orphaned_after_full_run(current: DataFrame, spark: SparkSession, state_root: str) -> DataFrame:
    """After a full run: remembered graphs that the run did not see."""
    return read_state(spark, state_root).join(current.select("graph_iri"), "graph_iri", "left_anti").select("graph_iri")


PAGE_START = r"start[=-]0*([0-9]+)"


def run_paged_harvest(spark: SparkSession, landing: str, schema: str, out: str, checkpoint: str, max_files: int | None = None, page: str = PAGE_START) -> None:
    """Take in landed pages of a paged harvest: JSON lines, a page's first record number in its path (group 1 of ``page``; files without one are left out).

    The stream remembers which pages it has read, so an interrupted harvest goes on where it stopped; a batch that runs
    again writes its own folder again. Rows keep (start, place), their place in the order of the pages.
    """
    reader = spark.readStream.schema(schema).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    start = F.regexp_extract(F.col("_metadata.file_path"), page, 1).try_cast("bigint")
    rows = reader.json(landing).select("*", start.alias("start"), F.col("_metadata.file_name").alias("__file"), F.col("_metadata.file_block_start").alias("__block")).where("start IS NOT NULL")

    def step(batch: DataFrame, batch_id: int) -> None:
        place = F.struct(F.col("__file").alias("file"), F.col("__block").alias("block"), F.monotonically_increasing_id().alias("row"))
        batch.withColumn("place", place).drop("__file", "__block").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def harvested(spark: SparkSession, out: str, page_size: int, max_records: int | None = None) -> DataFrame:
    """The records of a harvest in page order, each once: pages up to the first gap or short page, which ends a harvest, and
    of them the first ``max_records`` records. A page that landed twice counts once, as it landed last."""
    rows = spark.read.parquet(out)
    newest = rows.groupBy("start").agg(F.max("batch").alias("batch"))
    rows = rows.join(newest, ["start", "batch"])
    sizes = rows.groupBy("start").agg(F.count(F.lit(1)).alias("rows"))
    # page k starts at k * page_size: the first one that is short, or missing, is found without an order over all pages
    full = sizes.where((F.col("start") % page_size == 0) & (F.col("rows") >= page_size)).select((F.col("start") + page_size).alias("start"))
    firsts = full.unionByName(spark.range(1).select(F.lit(0).cast("bigint").alias("start"))).distinct()
    stop = firsts.join(sizes.where(F.col("rows") >= page_size).select("start"), "start", "left_anti").agg(F.min("start")).first()[0]
    kept = rows.where((F.col("start") <= stop) & (F.col("start") % page_size == 0))
    if max_records is not None:
        kept = kept.orderBy("start", "place").limit(max_records)
    return kept.drop("batch")


def daily_counts(events: DataFrame, ts: str = "ts", key: str = "event_type") -> DataFrame:
    """Events per day and key; works on a batch table and, with its watermark, on a stream."""
    if events.isStreaming:
        events = events.withWatermark(ts, "1 day")
    day = F.window(ts, "1 day")
    return events.groupBy(day, key).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("window.start").alias("ts_utc"), key, "n")


def run_daily_snapshots(spark: SparkSession, landing: str, schema: str, out: str, checkpoint: str) -> None:
    s = spark.readStream.schema(schema).parquet(landing)
    s = s.withColumn("ts", F.col("ts").cast("timestamp"))
    q = (daily_counts(s).writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_upsert(spark: SparkSession, landing: str, schema: str, table: str, checkpoint: str, max_files: int | None = None) -> None:
    """Graphs in a run replace their stored content; repeating a batch or a run changes nothing.

    A graph whose rows come in several batches of a run is replaced by the first and added to by the
    others: the table's map remembers the run that wrote each graph.
    """
    opened = f"{checkpoint.rstrip('/')}/open-run"  # there while a run is under way: one that failed goes on under its id
    if not path_exists(spark, f"{opened}/_SUCCESS"):
        spark.createDataFrame([(uuid.uuid4().hex[:12],)], "value string").coalesce(1).write.mode("overwrite").text(opened)
    run = spark.read.text(opened).first()["value"]
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def step(batch: DataFrame, batch_id: int) -> None:
        publish_graphs(batch.distinct(), table, run=run)

    q = (reader.parquet(landing).writeStream.foreachBatch(step)
         .option("checkpointLocation", f"{checkpoint.rstrip('/')}/query").trigger(availableNow=True).start())
    q.awaitTermination()
    remove_path(spark, opened)
