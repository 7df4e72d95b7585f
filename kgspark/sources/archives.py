"""Members of zip archives as bounded pieces of text.

The driver handles paths only. Tasks read the central directory at the end of each archive, which lists its members without
reading them; the members, not the archives, are then dealt out to as many tasks as their bytes ask for. A
member is unpacked as a stream, so neither a huge archive nor a huge member is ever held in memory: its text comes as
pieces that end at line ends.

Archives are opened through ``pyarrow.fs`` (local and mounted paths, s3, gs, hdfs). A store that only Spark can read is
served by ``scan.expand_zip`` on file contents.
"""

from __future__ import annotations

import itertools
import sys
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from kgspark.functions.scalars import RDF_EXTENSIONS
from kgspark.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Unpacked bytes that a task reads, and bytes of text in one piece.
TASK_BYTES, PIECE_BYTES = 64 << 20, 1 << 20
MEMBERS = "file string, place int, inner string, size bigint, status string"


class _Seekable:
    """A stream that refuses a seek before its start with ``OSError``, which zipfile expects where an archive is
    shorter than the record it looks for; Arrow raises ``ValueError``."""

    def __init__(self, stream):
        self._stream = stream

    def __getattr__(self, name):
        return getattr(self._stream, name)

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self._stream.close()

    def seek(self, *args):
        try:
            return self._stream.seek(*args)
        except ValueError as e:
            raise OSError(str(e)) from e


def _opened(path: str, write: bool = False):
    """The file as a seekable stream."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return system.open_output_stream(inner, compression=None) if write else _Seekable(system.open_input_file(inner))


def _status(m: zipfile.ZipInfo, cap: int | None, exts: tuple[str, ...]) -> str:
    name = m.filename
    if name.startswith("/") or ".." in name.replace("\\", "/").split("/"):
        return "outside"
    if not name.lower().endswith(exts):
        return "other format"
    return "too large" if cap is not None and m.file_size > cap else "ok"


def list_members(files: DataFrame, max_bytes: int | None = None, exts: list[str] = RDF_EXTENSIONS) -> DataFrame:
    """(file, place, inner, size, status) of every member of the archives ``files`` (path): ``ok``, ``too large``, ``outside`` (its
    path leaves the archive), ``other format``, or one row ``no archive`` for a file that is none. ``place`` is its number in the
    central directory, since an archive may hold two members of one name."""
    allowed = tuple(exts)

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                try:
                    with _opened(path) as f, zipfile.ZipFile(f) as z:
                        found = [(path, k, m.filename, m.file_size, _status(m, max_bytes, allowed)) for k, m in enumerate(z.infolist()) if not m.is_dir()]
                except (zipfile.BadZipFile, OSError, ValueError) as e:
                    if isinstance(e, OSError) and not isinstance(e, ValueError):
                        raise  # the store failed, not the archive
                    found = [(path, None, None, None, "no archive")]
                for k in range(0, len(found), 10_000):
                    yield pd.DataFrame(found[k:k + 10_000], columns=["file", "place", "inner", "size", "status"]).astype({"place": "Int32", "size": "Int64"})

    return files.select("path").mapInPandas(members, MEMBERS)


def pieces(stream, size: int) -> Iterator[bytes]:
    """What a stream holds, in pieces of about ``size`` bytes that end at a line end, or between characters where a line is longer."""
    rest = b""
    while block := stream.read(size):
        rest += block
        cut = rest.rfind(b"\n") + 1
        if not cut:
            cut = len(rest)
            while cut and cut > len(rest) - 4 and rest[cut - 1] & 0xC0 == 0x80:
                cut -= 1
            cut -= 1 if cut and rest[cut - 1] >= 0xC0 else 0
        if cut:
            yield rest[:cut]
            rest = rest[cut:]
    if rest:
        yield rest


def read_members(members: DataFrame, piece_bytes: int = PIECE_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(file, place, inner, label, piece, text) of the members ``members`` (file, place, inner, size); pieces count from 0, and a member
    without contents is one empty piece."""
    spark = members.sparkSession
    stored = materialize(members.select("file", "place", "inner", "size"), "members")
    total = stored.agg(F.sum("size")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // task_bytes)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, f, members = None, None, []
        for pdf in batches:
            for path, place, inner in zip(pdf["file"], pdf["place"], pdf["inner"]):
                if path != name:
                    if f is not None:
                        f.close()
                    name, f = path, _opened(path)
                    z = zipfile.ZipFile(f)
                    members = z.infolist()
                with z.open(members[place]) as stream:
                    for k, data in enumerate(itertools.chain(pieces(stream, piece_bytes), [b""])):
                        if data or k == 0:
                            yield pd.DataFrame({"file": [path], "place": [place], "inner": [inner], "label": [f"{path}!{inner}"], "piece": [k], "text": [data.decode("utf-8", "replace")]})
        if f is not None:
            f.close()

    dealt = stored.repartition(tasks, "file", "place").sortWithinPartitions("file", "place")
    return dealt.select("file", "place", "inner").mapInPandas(read, "file string, place int, inner string, label string, piece int, text string")


def scan_archives(spark: SparkSession, path: str, max_bytes: int | None = None, exts: list[str] = RDF_EXTENSIONS, piece_bytes: int = PIECE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(pieces of the accepted members, report of the others with their status). Only names and sizes of the archives are read by Spark."""
    files = spark.read.format("binaryFile").load(path).where(F.lower("path").endswith(".zip")).select("path")
    listed = materialize(list_members(files, max_bytes, exts), "members")
    return read_members(listed.where("status = 'ok'"), piece_bytes), listed.where("status <> 'ok'")


def write_archives(rows: DataFrame, path: str) -> int:
    """Write (inner, text) rows as zip archives, one per task; a task that runs again writes the same file. Returns the number of members."""
    base = path.rstrip("/")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        with _opened(f"{base}/part-{TaskContext.get().partitionId():05d}.zip", write=True) as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
            for pdf in batches:
                for inner, text in zip(pdf["inner"], pdf["text"]):
                    z.writestr(inner, text or "")
                    n += 1
        yield pd.DataFrame({"n": [n]})

    spark = rows.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return rows.select("inner", "text").mapInPandas(pack, "n bigint").agg(F.sum("n")).first()[0] or 0
