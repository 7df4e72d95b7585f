"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "kgspark", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where a local session names none (tests) a temporary one is set; on a cluster that is an error,
    because executors do not see the driver's folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        d = spark.sparkContext.getCheckpointDir()
    return d


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes, file counts and times of what lies in a folder, to notice changed inputs."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for st in fs.listStatus(path):
        total = fs.getContentSummary(st.getPath())
        out.append((st.getPath().getName(), total.getLength(), total.getFileCount(), st.getModificationTime()))
    return tuple(sorted(out))


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str = "step", partition_by: list[str] | None = None, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used between the rounds of iterative operators: it cuts the lineage, survives the
    loss of executors, and gives the next join real file sizes to plan with.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/kgspark/{name}-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists").options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
