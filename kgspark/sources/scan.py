"""Readers. All take paths on the shared file system and explicit schemas."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kgspark.functions.scalars import RDF_EXTENSIONS, infer_source, literal_int
from kgspark.functions.text import fix_mojibake
from kgspark.model import LABEL, OWL, QUAD_COLS, TYPE
from kgspark.operators.ordinal import with_ordinal

# task functions travel with the job; executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_FILE_BYTES = 100 * 1024 * 1024
TSV = {"sep": "\t", "header": False, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


# --- templates and tabs --------------------------------------------------------------------

def _wide(n: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(n)])


def scan_tabs(spark: SparkSession, path: str, columns: int, repair: bool = False, scope: str = "cell",
              tab_regex: str = r"([^/]*?)(\.[^./]*)?$", multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Tabs (tab, tab_order, row, cells) and directives (tab, col, header, directive).

    Row 1 of a tab is the header, row 2 the directives, data follows; data rows need a first
    cell, and a tab of fewer than 3 rows is empty. The tab name is group 1 of ``tab_regex`` on
    the file path; a tab may consist of several files, in file-name order. Rows are numbered
    by (file, block, position), so large tabs are read in splits when ``multi_line`` is off.
    ``scope='file'`` repairs a tab only when no character of it lies above U+00FF.
    """
    raw = spark.read.options(**{**TSV, "multiLine": multi_line}).schema(_wide(columns)).csv(path)
    raw = raw.select(F.regexp_extract(F.col("_metadata.file_path"), tab_regex, 1).alias("tab"),
                     F.concat(F.col("_metadata.file_name"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0")).alias("__at"),
                     F.monotonically_increasing_id().alias("__id"), F.array(*[f"c{i}" for i in range(columns)]).alias("cells"))
    sizes = raw.groupBy("tab").agg(F.count(F.lit(1)).alias("__rows"))
    rows = with_ordinal(raw, ["__at", "__id"], "row", by=["tab"]).join(sizes, "tab").drop("__at", "__id")
    if repair:
        if scope == "file":
            wide = F.exists("cells", lambda c: F.coalesce(c, F.lit("")).rlike("[^\u0000-ÿ]"))
            ok = rows.groupBy("tab").agg((~F.bool_or(wide)).alias("__fix"))
            rows = rows.join(ok, "tab")
        else:
            rows = rows.withColumn("__fix", F.lit(True))
        long = rows.select("tab", "row", "__rows", "__fix", F.posexplode("cells").alias("i", "v"))
        long = long.withColumn("v", F.when(F.col("__fix"), fix_mojibake("v")).otherwise(F.col("v")))
        rows = long.groupBy("tab", "row", "__rows").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("x")).withColumn(
            "cells", F.transform("x", lambda x: x["v"]))
    head = rows.where("row <= 2").select("tab", F.posexplode("cells").alias("col", "text"), "row")
    directives = head.groupBy("tab", "col").agg(F.max(F.when(F.col("row") == 1, F.col("text"))).alias("header"),
                                                F.max(F.when(F.col("row") == 2, F.col("text"))).alias("directive"))
    data = rows.where((F.col("row") >= 3) & (F.col("__rows") >= 3) & (F.trim(F.coalesce(F.col("cells")[0], F.lit(""))) != ""))
    return data.select("tab", F.col("tab").alias("tab_order"), "row", "cells"), directives


def tabs_from_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same split for tab lines already in a table: (tab, tab_order, line_no, cells)."""
    n = lines.groupBy("tab").agg(F.count(F.lit(1)).alias("__rows"))
    head = lines.where("line_no <= 2").select("tab", F.posexplode("cells").alias("col", "text"), "line_no")
    directives = head.groupBy("tab", "col").agg(F.max(F.when(F.col("line_no") == 1, F.col("text"))).alias("header"),
                                                F.max(F.when(F.col("line_no") == 2, F.col("text"))).alias("directive"))
    data = lines.where(F.col("line_no") >= 3).join(n.where("__rows >= 3"), "tab", "left_semi")
    data = data.where(F.trim(F.coalesce(F.col("cells")[0], F.lit(""))) != "")
    return data.select("tab", "tab_order", F.col("line_no").alias("row"), "cells"), directives


# --- registrations -------------------------------------------------------------------------

# Accepted column names, best first. A template's TYPE column comes last, so it
# never wins over an explicit source column.
ALIASES = {
    "source": ("source", "kind", "type"),
    "url": ("url", "link", "repository", "repo", "record", "doi", "location"),
    "files": ("files", "file", "include", "rdf files", "rdf_files"),
    "label": ("label", "name", "title", "notes", "comment"),
    "schedule": ("re-sync", "resync", "sync", "schedule", "refresh"),
}


def pick_column(header: list[str], names: tuple[str, ...]) -> str | None:
    low = {h.strip().lower(): h for h in reversed(header)}
    return next((low[n] for n in names if n in low), None)


def registrations(table: DataFrame, row: Column | None = None) -> DataFrame:
    """(source, url, files, label, row) of a sheet; blank and comment rows and rows of unknown
    sources are dropped. Column names are resolved on the header only."""
    cols = {k: pick_column(table.columns, v) for k, v in ALIASES.items()}
    if cols["url"] is None:
        raise ValueError(f"no column of {table.columns} is known as a link column")
    get = lambda k: F.trim(F.coalesce(F.col(f"`{cols[k]}`"), F.lit(""))) if cols[k] else F.lit("")
    src = F.coalesce(F.nullif(F.lower(get("source")), F.lit("")), infer_source(get("url")), F.lit(""))
    files = F.filter(F.transform(F.split(get("files"), r"[,;\n]"), lambda x: F.trim(x)), lambda x: x != "")
    out = table.select(src.alias("source"), get("url").alias("url"), files.alias("files"), get("label").alias("label"),
                       (F.lit(None).cast("bigint") if row is None else row).alias("row"))
    return out.where((F.col("url") != "") & ~F.col("url").startswith("#") & F.col("source").isin("github", "zenodo"))


def scan_registrations(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.options(sep="\t", header=True, multiLine=True, quote='"', escape='"').csv(path)
    # one sheet file is read whole by one task: ids count its rows, the header is row 1
    return registrations(t.withColumn("__id", F.monotonically_increasing_id()), F.col("__id") + 2)


# --- RDF line formats ----------------------------------------------------------------------

_NODE = r"(?:<([^>]*)>|(_:[^\s<>\"]+))"
_HEAD = r"^\s*" + _NODE + r"\s+<([^>]*)>\s+"
_END = r"(?:\s*" + _NODE + r")?\s*\.\s*(?:#.*)?$"
_OBJECT = "^" + _NODE + _END
_AFTER_LITERAL = r"^(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?" + _END
#: Stand-ins for an escaped backslash and quote while a literal's end is looked for (not legal in a line).
_SLASH, _QUOTE = "\u0001", "\u0002"


def _decoded(digits: int, charset: str):
    """For every part but the first: its leading hex digits as a character, then the rest."""
    return lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.decode(F.unhex(F.substring(x, 1, digits)), charset), F.substring(x, digits + 1, 2 ** 31 - 1)))


def unescape(c: Column) -> Column:
    """All escapes of a literal: short ones, ``\\uXXXX`` and ``\\UXXXXXXXX``; a backslash pair is parked first
    so that it cannot start one."""
    out = F.replace(c, F.lit("\\\\"), F.lit(_SLASH))
    for esc, raw in (('\\"', '"'), ("\\'", "'"), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\\b", "\b"), ("\\f", "\f")):
        out = F.replace(out, F.lit(esc), F.lit(raw))
    for mark, digits, charset in (("u", 4, "UTF-16BE"), ("U", 8, "UTF-32")):
        parts = F.split(out, r"\\" + mark + "(?=[0-9A-Fa-f]{%d})" % digits)
        joined = F.array_join(F.transform(parts, _decoded(digits, charset)), "")
        out = F.when(F.instr(out, "\\" + mark) > 0, joined).otherwise(out)
    return F.replace(out, F.lit(_SLASH), F.lit("\\"))


def parse_lines(lines: DataFrame, line: str = "value", file_id: str | None = None, graph: str | Column | None = None) -> DataFrame:
    """N-Triples / N-Quads lines to quads plus ``ok``; blank nodes are prefixed per file.

    The subject and predicate are cut off by a short pattern, a literal's end is found by plain string
    search, and what follows by another pattern, so literals may have any length.
    """
    keep = [c for c in lines.columns if c != line]
    pre = F.substring(F.sha1(F.col(file_id)), 1, 8) if file_id else F.lit("")
    bn = lambda c: F.concat(F.lit("_:"), pre, F.substring(c, 3, 2 ** 31 - 1))
    default = graph if isinstance(graph, Column) else F.lit(graph or "urn:default")
    head = lambda i: F.nullif(F.regexp_extract(line, _HEAD, i), F.lit(""))
    tail = lambda pattern, i: F.nullif(F.regexp_extract("__tail", pattern, i), F.lit(""))
    rest = F.substring(F.col(line), F.length(F.regexp_extract(line, _HEAD, 0)) + 1, F.lit(2 ** 31 - 1))
    t = lines.where(~F.rlike(F.col(line), F.lit(r"^\s*(#|$)"))).select(
        *keep, F.rlike(F.col(line), F.lit(_HEAD)).alias("__ok"), head(1).alias("__s"), head(2).alias("__sb"), head(3).alias("__p"), rest.alias("__rest"))
    t = t.withColumn("__lit", F.startswith("__rest", F.lit('"')))
    # the text after the opening quote, its escaped backslashes and quotes parked, split at the first quote left
    body = F.replace(F.replace(F.substring("__rest", 2, 2 ** 31 - 1), F.lit("\\\\"), F.lit(_SLASH)), F.lit('\\"'), F.lit(_QUOTE))
    t = t.withColumn("__body", F.when(F.col("__lit"), body)).withColumn("__end", F.instr("__body", '"'))
    back = lambda c: F.replace(F.replace(c, F.lit(_QUOTE), F.lit('\\"')), F.lit(_SLASH), F.lit("\\\\"))
    t = t.withColumn("__tail", F.when(F.col("__lit"), F.substring(F.col("__body"), F.col("__end") + 1, F.lit(2 ** 31 - 1))).otherwise(F.col("__rest")))
    lit, A, O = F.col("__lit"), _AFTER_LITERAL, _OBJECT  # noqa: E741
    ok = F.col("__ok") & F.when(lit, (F.col("__end") > 0) & F.rlike(F.col("__tail"), F.lit(A))).otherwise(F.rlike(F.col("__tail"), F.lit(O)))
    text = unescape(back(F.substring(F.col("__body"), F.lit(1), F.col("__end") - 1)))
    node, blank = F.when(~lit, tail(O, 1)), F.when(~lit, tail(O, 2))
    return t.select(
        *keep, F.coalesce(ok, F.lit(False)).alias("ok"),
        F.coalesce(F.when(lit, tail(A, 3)).otherwise(tail(O, 3)), bn(F.when(lit, tail(A, 4)).otherwise(tail(O, 4))), default).alias("graph"),
        F.coalesce("__s", bn(F.col("__sb")), F.lit("")).alias("s"), F.when(F.col("__sb").isNotNull(), "bnode").otherwise("iri").alias("s_kind"),
        F.coalesce("__p", F.lit("")).alias("p"), F.coalesce(node, bn(blank), F.when(lit, text), F.lit("")).alias("o"),
        F.when(node.isNotNull(), "iri").when(blank.isNotNull(), "bnode").otherwise("literal").alias("o_kind"),
        F.when(lit, tail(A, 1)).alias("o_datatype"), F.coalesce(F.when(lit, tail(A, 2)), F.lit("")).alias("o_lang"))


# RDF formats by file extension and by MIME type.
FORMATS_BY_EXTENSION = {".nt": "ntriples", ".nq": "nquads", ".ttl": "turtle", ".owl": "xml", ".rdf": "xml", ".xml": "xml", ".trig": "trig", ".jsonld": "json-ld", ".n3": "n3"}
FORMATS_BY_MIME = {"application/n-triples": "ntriples", "application/n-quads": "nquads", "text/turtle": "turtle",
                   "text/n3": "n3", "application/rdf+xml": "xml", "application/trig": "trig", "application/ld+json": "json-ld"}


def guess_format(path: Column, content_type: Column) -> Column:
    """By extension, then by MIME type, else Turtle."""
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    ext = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    mime = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    return F.coalesce(F.try_element_at(table(FORMATS_BY_EXTENSION), ext), F.try_element_at(table(FORMATS_BY_MIME), mime), F.lit("turtle"))


def scan_nquads(spark: SparkSession, path: str, graph_base: str | None = None) -> DataFrame:
    """Quads of line files; lines that do not parse and files without triples drop out."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    graph = F.concat(F.lit(graph_base), F.substring_index("file", "/", -1)) if graph_base else None
    return parse_lines(lines, file_id="file", graph=graph).where("ok").select(QUAD_COLS).distinct()


def scan_permissive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(quads with file, report of (file, format, parsed, corrupt)): what does not parse is counted and skipped.

    The format is guessed from the file's name. Line formats are read as such; files of other formats are
    tried as lines too, and keep their guess in the report when no line parses.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    rows = parse_lines(lines, file_id="file")
    counts = rows.groupBy("file").agg(F.count_if("ok").alias("parsed"), F.count_if(~F.col("ok")).alias("corrupt"))
    guess = guess_format(F.col("file"), F.lit(None).cast("string"))
    report = counts.select("file", F.when(guess.isin("ntriples", "nquads") | (F.col("parsed") == 0), guess).otherwise("nquads").alias("format"), "parsed", "corrupt")
    return rows.where("ok").drop("ok"), report


# --- JSON ------------------------------------------------------------------------------------

PARTY = "ARRAY<STRUCT<name: STRING, email: STRING>>"
CKAN = (f"id STRING, title STRING, notes STRING, license_id STRING, metadata_created STRING, metadata_modified STRING, type STRING, contact {PARTY}, "
        f"contributor {PARTY}, publisher ARRAY<STRUCT<name: STRING, email: STRING, uri: STRING>>, organization STRUCT<id: STRING, title: STRING, description: STRING>, "
        "tags ARRAY<STRUCT<name: STRING>>, resources ARRAY<STRUCT<format: STRING, url: STRING>>")
FILE = "STRUCT<key: STRING, filename: STRING, checksum: STRING, links: STRUCT<self: STRING, download: STRING, content: STRING>>"
RECORD = ("id BIGINT, conceptrecid STRING, doi STRING, metadata STRUCT<title: STRING, doi: STRING, upload_type: STRING, resource_type: STRUCT<type: STRING>, version: STRING>, "
          f"links MAP<STRING, STRING>, files_list ARRAY<{FILE}>, files_map STRUCT<entries: MAP<STRING, {FILE}>>")
TERM = "STRUCT<type: STRING, value: STRING, `xml:lang`: STRING, datatype: STRING>"


def scan_ckan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CKAN).option("mode", "DROPMALFORMED").json(path)


def parse_ckan(df: DataFrame, column: str = "value") -> DataFrame:
    return df.select(F.from_json(column, CKAN).alias("r")).where("r is not null and r.id is not null").select("r.*")


def parse_records(df: DataFrame, column: str = "value") -> DataFrame:
    """Archive records with either layout of the file list: one row per file."""
    base = RECORD.split(", files_list")[0]
    v = F.col(column)
    r = df.select(F.from_json(v, base).alias("r"), F.from_json(F.get_json_object(v, "$.files"), f"ARRAY<{FILE}>").alias("as_list"),
                  F.from_json(F.get_json_object(v, "$.files.entries"), f"MAP<STRING, {FILE}>").alias("as_map"))
    named = F.transform(F.map_entries("as_map"), lambda e: F.struct(
        F.coalesce(e["value"]["key"], e["key"]).alias("key"), e["value"]["filename"].alias("filename"), e["value"]["checksum"].alias("checksum"), e["value"]["links"].alias("links")))
    listed = F.filter("as_list", lambda x: x["links"].isNotNull() | x["checksum"].isNotNull())
    r = r.withColumn("__files", F.coalesce(F.when(F.size(listed) > 0, listed), named))
    f = r.select("r.*", F.explode_outer("__files").alias("f"))
    return f.select(F.col("id").cast("string").alias("id"), "conceptrecid", F.col("metadata.title").alias("title"), F.col("metadata.upload_type").alias("upload_type"),
                    F.col("metadata.resource_type.type").alias("resource_type"), F.coalesce("f.key", "f.filename").alias("file_key"), F.col("f.checksum").alias("checksum"),
                    F.coalesce("f.links.self", "f.links.download", "f.links.content").alias("link"))


def skip_self(records: DataFrame, own_concept: str) -> DataFrame:
    return records.where(F.trim(F.coalesce("conceptrecid", F.lit(""))) != own_concept)


def parse_bindings(df: DataFrame, variables: list[str], column: str = "value", integers: tuple[str, ...] = ()) -> DataFrame:
    """SPARQL-results JSON: one row per binding; unbound variables are null, integers default to 0."""
    b = F.from_json(F.get_json_object(column, "$.results.bindings"), f"ARRAY<MAP<STRING, {TERM}>>")
    keep = [c for c in df.columns if c != column]
    rows = df.select(*keep, F.explode(b).alias("b"))
    val = lambda v: F.try_element_at("b", F.lit(v))["value"]
    return rows.select(*keep, *[(literal_int(val(v)) if v in integers else val(v)).alias(v) for v in variables])


def scan_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Remembered state; a missing or unreadable path is an empty state."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def regroup_slots(state: DataFrame) -> DataFrame:
    """Legacy ``record|slot`` keys as (record, nodes in slot order)."""
    parts = state.select(F.substring_index("key", "|", 1).alias("record"), F.substring_index("key", "|", -1).try_cast("int").alias("slot"), "node")
    items = F.array_sort(F.collect_list(F.struct("slot", "node")))
    return parts.where("slot is not null").groupBy("record").agg(F.transform(items, lambda x: x["node"]).alias("nodes"))


def scan_pages(spark: SparkSession, path: str, schema: str, max_records: int | None = None, order: str | None = None) -> DataFrame:
    """Landed page files of a paged harvest; the cap keeps the first records in key order."""
    df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    if max_records is None:
        return df
    return df.orderBy(order or df.columns[0]).limit(max_records)


# --- archives and HTML -------------------------------------------------------------------------

def _expand(batches: Iterator[pd.DataFrame], cap: int, exts: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                z = zipfile.ZipFile(io.BytesIO(content))
            except zipfile.BadZipFile:
                continue
            for m in z.infolist():
                name = m.filename
                if m.is_dir() or m.file_size > cap or not name.lower().endswith(exts):
                    continue
                if name.startswith("/") or ".." in name.replace("\\", "/").split("/"):
                    continue
                text = z.read(m).decode("utf-8", "replace")
                yield pd.DataFrame({"file": [path], "inner": [name], "label": [f"{path}!{name}"], "text": [text]})


def scan_zip(spark: SparkSession, path: str, max_bytes: int = MAX_FILE_BYTES, exts: list[str] = RDF_EXTENSIONS) -> DataFrame:
    """Members of archives that are RDF files: (file, inner, label, text). Members too large,
    or pointing outside the archive, are left out."""
    return expand_zip(sized_files(spark, path, max_bytes).where(F.lower("path").endswith(".zip")), max_bytes, exts)


def expand_zip(files: DataFrame, max_bytes: int = MAX_FILE_BYTES, exts: list[str] = RDF_EXTENSIONS) -> DataFrame:
    allowed = tuple(exts)
    return files.select("path", "content").mapInPandas(lambda it: _expand(it, max_bytes, allowed), "file string, inner string, label string, text string")


def sized_files(spark: SparkSession, path: str, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Binary files up to a size; the size filter is pushed down, larger files are not read."""
    return capped(spark.read.format("binaryFile").load(path), max_bytes)


def capped(files: DataFrame, max_bytes: int) -> DataFrame:
    return files.where(F.col("length") <= max_bytes)


def content_hash(files: DataFrame) -> DataFrame:
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, href, text) of anchors."""
    pat = r'(?is)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a>'
    hits = F.explode(F.arrays_zip(F.regexp_extract_all("html", F.lit(pat), 1).alias("href"), F.regexp_extract_all("html", F.lit(pat), 2).alias("text")))
    return pages.select("page_id", hits.alias("a")).select("page_id", F.col("a.href").alias("href"), F.regexp_replace("a.text", "<[^>]*>", "").alias("text"))


def page_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, n, tag, text) of headings, paragraphs and list items, tags stripped."""
    pat = r"(?is)<(h1|h2|h3|p|li)\b[^>]*>(.*?)</\1>"
    z = F.arrays_zip(F.regexp_extract_all("html", F.lit(pat), 1).alias("tag"), F.regexp_extract_all("html", F.lit(pat), 2).alias("text"))
    out = pages.select("page_id", F.posexplode(z).alias("n", "b"))
    text = F.trim(F.regexp_replace(F.regexp_replace("b.text", "<[^>]*>", " "), r"\s+", " "))
    return out.select("page_id", F.col("n").cast("bigint").alias("n"), F.lower("b.tag").alias("tag"), text.alias("text")).where("text <> ''")


class _Rows(HTMLParser):
    """Collects the cells of table rows."""

    def __init__(self):
        super().__init__()
        self.rows, self._row, self._cell = [], None, None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            self._cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self._cell is not None:
            self._row.append(" ".join("".join(self._cell).split()))
            self._cell = None
        elif tag == "tr" and self._row is not None:
            self.rows.append(self._row)
            self._row = None

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)


def table_rows(html: str) -> list[tuple[int, str, str]]:
    parser = _Rows()
    parser.feed(html)
    return [(i, r[0], r[1]) for i, r in enumerate(parser.rows) if len(r) >= 2]


def _tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = [(pid, *row) for pid, html in zip(pdf["page_id"], pdf["html"]) for row in table_rows(html or "")]
        yield pd.DataFrame(out, columns=["page_id", "n", "key", "value"]).astype({"page_id": "int64", "n": "int64"})


def page_tables(pages: DataFrame) -> DataFrame:
    """(page_id, n, key, value) of the first two cells of table rows; pages without a table stay in the JVM."""
    return pages.where(F.lower("html").contains("<tr")).select("page_id", "html").mapInPandas(
        _tables, "page_id bigint, n bigint, key string, value string")


# --- ontology files ------------------------------------------------------------------------------

ALT_LABELS = ["http://purl.obolibrary.org/obo/IAO_0000118", "http://www.w3.org/2004/02/skos/core#altLabel"]


def onto_labels(quads: DataFrame, order: str) -> DataFrame:
    """(s, label, declared, synonyms, synonym_list): the first label in load order wins; every IRI subject is
    declared; a term's different synonyms are counted and listed in order, separated by ``|``."""
    first = quads.where(F.col("p") == LABEL).groupBy("s").agg(
        F.min_by("o", F.struct(order, "o")).alias("label"), F.bool_or(F.col("s_kind") == "iri").alias("declared"))
    names = quads.where(F.col("p").isin(ALT_LABELS)).select("s", "o").distinct().groupBy("s").agg(
        F.count(F.lit(1)).alias("synonyms"), F.array_join(F.array_sort(F.collect_list("o")), "|").alias("synonym_list"))
    return first.join(names, "s", "left").select(
        "s", "label", "declared", F.coalesce("synonyms", F.lit(0)).alias("synonyms"), F.coalesce("synonym_list", F.lit("")).alias("synonym_list"))


TERM_KINDS = {OWL + "Class": "class", OWL + "ObjectProperty": "object", OWL + "DatatypeProperty": "data"}


def onto_terms(quads: DataFrame) -> DataFrame:
    """(iri, kind) of declared classes and properties."""
    kind = F.create_map(*[F.lit(x) for kv in TERM_KINDS.items() for x in kv])
    hit = quads.where((F.col("p") == TYPE) & F.col("o").isin(list(TERM_KINDS)) & (F.col("s_kind") == "iri"))
    return hit.select(F.col("s").alias("iri"), kind[F.col("o")].alias("kind")).distinct()
