"""Column expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from kgspark.model import RDF, XSD

# Ranks of artifact variants and formats, best first.
VARIANTS = ["full", "", "merged", "non-classified", "simple", "minimal", "basic", "base"]
FORMATS = [".ttl", ".owl", ".rdf", ".nt", ".trig", ".nq", ".jsonld", ".n3"]
RDF_EXTENSIONS = [".ttl", ".n3", ".nt", ".nq", ".trig", ".owl", ".rdf", ".jsonld"]
# Path segments of a code host that never name a repository.
NOT_A_REPO = ["tree", "blob", "releases", "issues", "pull", "wiki", "actions", "settings", "orgs", "sponsors", "topics"]
STOPWORDS_EN = ["the", "and", "of", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "are", "be",
                "at", "by", "an", "this", "have", "from", "or", "had", "not", "but", "what", "all", "were", "we", "when"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def english(lang: Column | str) -> Column:
    """No tag, or a tag matching ``en`` (``en``, ``EN``, ``en-GB``; not ``eng``)."""
    low = F.lower(_c(lang))
    return (low == "") | (low == "en") | low.startswith("en-")


def sanitize(s) -> Column:
    """Tabs and line ends to blanks, runs of white space to one blank, trimmed; null is ''."""
    spaced = F.regexp_replace(F.coalesce(_c(s), F.lit("")), r"[\t\r\n]", " ")
    return F.trim(F.regexp_replace(spaced, r"\s{2,}", " "))


def split_list(s, sep: str = ";", keep_blanks: bool = False) -> Column:
    """Split a delimited cell; blanks are dropped, so parallel lists may lose alignment."""
    parts = F.transform(F.split(sanitize(s), sep), lambda x: F.trim(x))
    return parts if keep_blanks else F.filter(parts, lambda x: x != "")


ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def date_mdy(s) -> Column:
    """ISO date or date-time as MM/dd/yyyy (calendar date as written); other text unchanged."""
    text = sanitize(s)
    day = F.substring(text, 1, 10).try_cast("date")
    return F.when(text.rlike(ISO_SHAPE), F.coalesce(F.date_format(day, "MM/dd/yyyy"), text)).otherwise(text)


def utc_stamp(ts, seconds: bool = True) -> Column:
    """``...Z`` with seconds, or with microseconds and ``+00:00``."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'" if seconds else "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def normalize_doi(s) -> Column:
    low = F.lower(F.trim(_c(s)))
    return F.regexp_replace(low, r"^(https?://(dx\.)?doi\.org/|doi:)|/+$", "")


def safe_segment(s) -> Column:
    """One path segment: other characters become ``_``, outer ``_`` dropped."""
    return F.regexp_replace(F.regexp_replace(_c(s), r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def doi_folder(s) -> Column:
    return F.regexp_replace(normalize_doi(s), r"[/:]", "_")


def slug(s) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(_c(s)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def safe_slug(s) -> Column:
    """Lower-case identifier for file names: ``doi:`` dropped, slashes to ``_``, other characters removed; never empty."""
    low = F.regexp_replace(F.lower(F.trim(_c(s))), r"^doi:\s*", "")
    return F.coalesce(F.nullif(F.regexp_replace(F.replace(low, F.lit("/"), F.lit("_")), r"[^a-z0-9._-]+", ""), F.lit("")), F.lit("id"))


def record_graph_iri(base: str, function: str, record) -> Column:
    """Readable snapshot graph of a record and function; the record is a DOI in any form or an id."""
    r = F.regexp_replace(F.trim(_c(record)), r"https?://doi\.org/|doi:", "")
    return F.concat(F.lit(f"{base}snapshot/{function}/"), F.regexp_replace(r, r"[^A-Za-z0-9._-]+", "_"))


def record_id(ref, own: str = r"10\.5281/zenodo\.") -> Column:
    """Record number out of a DOI, a record URL or a bare number; null otherwise."""
    r = F.trim(_c(ref))
    doi = F.regexp_extract(r, r"(?i)" + own + r"(\d+)", 1)
    url = F.regexp_extract(r, r"(?i)zenodo\.org/(?:api/)?(?:records?|deposit)/(\d+)", 1)
    bare = F.regexp_extract(r, r"^(\d+)$", 1)
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (doi, url, bare)])


def infer_source(url) -> Column:
    low = F.lower(F.coalesce(_c(url), F.lit("")))
    return (F.when(low.contains("github.com"), "github")
            .when(low.contains("zenodo.org") | low.rlike(r"10\.5281/zenodo\."), "zenodo"))


def owner_repo(url) -> Column:
    """``owner/repo`` from any form of a code-host URL; null for owner or feature pages.

    What follows the host is cut at the query or fragment and split; its first two segments count.
    """
    u = F.trim(_c(url))
    after = F.substring(u, F.instr(F.lower(u), "github.com") + len("github.com"), F.length(u))
    parts = F.split(F.get(F.split(F.ltrim(F.translate(after, ":", "/"), F.lit("/")), "[?#]"), F.lit(0)), "/")
    owner, name = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    repo = F.when(F.lower(name).endswith(".git"), F.substring(name, F.lit(1), F.length(name) - 4)).otherwise(name)
    fits = (F.lower(u).contains("github.com") & after.rlike("^[:/]") & owner.rlike("^[A-Za-z0-9-]+$") & ~owner.rlike("^-|-$")
            & repo.rlike("^[A-Za-z0-9._-]+$") & ~F.lower(repo).isin(NOT_A_REPO))
    return F.when(fits, F.concat_ws("/", owner, repo))


def label_fallback(label, iri, strict: bool = True) -> Column:
    """The label, else the text after ``#``.

    With ``strict`` a slash IRI gives '' (an absent marker yields the empty string, which
    is not null, so no later branch is reached); without, its last segment.
    """
    i = _c(iri)
    local = F.when(F.instr(i, "#") > 0, F.regexp_extract(i, r"^[^#]*#([\s\S]*)$", 1))
    rest = F.lit("") if strict else F.regexp_extract(i, r"([^/]*)/?$", 1)
    return F.coalesce(_c(label), local, rest)


def namespace(iri) -> Column:
    i = _c(iri)
    return F.when(F.instr(i, "#") > 0, F.concat(F.substring_index(i, "#", 1), F.lit("#"))).otherwise(
        F.regexp_extract(i, r"^([\s\S]*/)", 1))


def curie(iri, prefixes: dict[str, str]) -> Column:
    """Compact with the first prefix that fits; other IRIs unchanged."""
    i, out = _c(iri), None
    for name, ns in prefixes.items():
        cond, val = i.startswith(ns), F.concat(F.lit(name + ":"), F.substring(i, len(ns) + 1, 2 ** 31 - 1))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(i)


def expand_curie(term, prefixes: dict[str, str]) -> Column:
    t = _c(term)
    m = F.create_map(*[F.lit(x) for kv in prefixes.items() for x in kv])
    ns = F.try_element_at(m, F.substring_index(t, ":", 1))
    local = F.regexp_extract(t, r"^[^:]*:([\s\S]*)$", 1)
    return F.when(t.rlike(r"^https?://") | ns.isNull(), t).otherwise(F.concat(ns, local))


def uuid5(key, namespace_uuid: str) -> Column:
    """RFC 4122 version 5 UUID as text."""
    ns = F.unhex(F.lit(namespace_uuid.replace("-", "")))
    h = F.sha1(F.concat(ns, F.encode(_c(key), "UTF-8")))
    variant = F.element_at(
        F.array(*[F.lit(x) for x in "89ab"]), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1)
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3),
                    F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def graph_stem(graph) -> Column:
    return F.substring(F.sha1(_c(graph)), 1, 16)


def partition_iri(dataset, cls, base: str) -> Column:
    return F.concat(F.lit(base), F.substring(F.sha1(F.concat(_c(dataset), F.lit(" "), _c(cls))), 1, 24))


def snapshot_iri(base: str, function: str, url) -> Column:
    """Same record or endpoint and function -> same graph IRI, run after run."""
    return F.concat(F.lit(base + function + "/"),
                    F.substring(F.sha2(F.concat(F.lit(function + "|"), url_canon(url)), 256), 1, 24))


def escape_literal(s) -> Column:
    out = F.replace(_c(s), F.lit("\\"), F.lit("\\\\"))
    for raw, esc in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(esc))
    return out


def nt_term(value="o", kind="o_kind", datatype="o_datatype", lang="o_lang") -> Column:
    """One term in N-Triples syntax."""
    v, k, d, g = _c(value), _c(kind), _c(datatype), _c(lang)
    text = F.concat(F.lit('"'), escape_literal(v), F.lit('"'))
    lit = F.when(g != "", F.concat(text, F.lit("@"), g)).when(
        d.isNotNull(), F.concat(text, F.lit("^^<"), d, F.lit(">"))).otherwise(text)
    return F.when(k == "iri", F.concat(F.lit("<"), v, F.lit(">"))).when(k == "bnode", v).otherwise(lit)


def nt_line(with_graph: bool = True) -> Column:
    subject = F.when(F.col("s_kind") == "iri", F.concat(F.lit("<"), F.col("s"), F.lit(">"))).otherwise(F.col("s"))
    parts = [subject, F.concat(F.lit("<"), F.col("p"), F.lit(">")), nt_term()]
    if with_graph:
        parts.append(F.concat(F.lit("<"), F.col("graph"), F.lit(">")))
    return F.concat_ws(" ", *parts, F.lit("."))


def extension(path) -> Column:
    return F.lower(F.regexp_extract(_c(path), r"(\.[^./]+)$", 1))


def basename(path) -> Column:
    return F.substring_index(_c(path), "/", -1)


def dirname(path) -> Column:
    return F.regexp_extract(_c(path), r"^(.*)/[^/]*$", 1)


def variant_parts(path) -> tuple[Column, Column, Column]:
    """(stem, variant, extension) of an artifact name; only known variants split off."""
    name = basename(path)
    ext = F.regexp_extract(name, r"^.+(\.[^.]*)$", 1)
    bare = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    pat = r"(?i)^(.+?)-(" + "|".join(v for v in VARIANTS if v) + ")$"
    stem = F.regexp_extract(bare, pat, 1)
    return F.when(stem != "", stem).otherwise(bare), F.lower(F.regexp_extract(bare, pat, 2)), F.lower(ext)


def rank_of(col: Column, order: list[str], default: int = 50) -> Column:
    out = F.when(col == order[0], 0)
    for i, v in enumerate(order[1:], 1):
        out = out.when(col == v, i)
    return out.otherwise(default)


def http_url(u) -> Column:
    t = F.trim(_c(u))
    return F.when(t.rlike(r"^https?://"), t)


def url_canon(u) -> Column:
    return F.regexp_replace(F.trim(_c(u)), r"/$", "")


def excerpt(text, limit: int = 600) -> Column:
    t = F.regexp_replace(F.coalesce(_c(text), F.lit("")), r"^\s+|\s+$", "")
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.substring(t, 1, limit), F.lit("\n…(truncated)")))


def url_tail(u) -> Column:
    """Last non-empty segment of the path, or of the text when it is no URL."""
    path = F.regexp_replace(F.regexp_replace(_c(u), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    return F.try_element_at(F.filter(F.split(path, "/"), lambda x: x != ""), F.lit(-1))


def english_share(text) -> Column:
    """Share of words that are English stop words."""
    words = F.filter(F.split(F.lower(_c(text)), r"[^\p{L}]+"), lambda w: w != "")
    stop = F.array(*[F.lit(w) for w in STOPWORDS_EN])
    hits = F.size(F.filter(words, lambda w: F.array_contains(stop, w)))
    return F.when(F.size(words) > 0, hits / F.size(words)).otherwise(F.lit(0.0))


def is_english(text, threshold: float = 0.12) -> Column:
    return (F.length(F.trim(_c(text))) >= 20) & (english_share(text) >= threshold)


def human_total(n) -> Column:
    """``~234K`` (cut) / ``~1.2M`` (rounded, halves to even) style; small numbers as they are."""
    n = _c(n).cast("bigint")
    return (F.when(n >= 1000000, F.concat(F.lit("~"), F.bround(n.cast("decimal(38,6)") / 1000000, 1).cast("decimal(38,1)").cast("string"), F.lit("M")))
            .when(n >= 1000, F.concat(F.lit("~"), F.floor(n / 1000).cast("string"), F.lit("K")))
            .otherwise(n.cast("string")))


def date_dmy(s) -> Column:
    """``yyyy-MM-dd`` as DD.MM.YYYY; any other text stays."""
    c = _c(s)
    return F.coalesce(F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.date_format(c.try_cast("date"), "dd.MM.yyyy")), c)


# The kinds of template directives.
DIRECTIVE_KINDS = ["ID", "TYPE", "A", "I", "AI", "AT", "C", "DOMAIN", "RANGE"]


def parse_directive(cell) -> Column:
    """struct(kind, property, datatype, lang, split) of a template directive; nulls when absent.

    The first word after the kind is the property, without its ``@lang`` or ``^^datatype`` (also after a blank)
    and closing punctuation; ``rdfs:label`` is written out.
    """
    t = F.trim(_c(cell))
    known = t.rlike("^(" + "|".join(DIRECTIVE_KINDS) + r")(\s|$)")
    rest = F.when(known, F.regexp_replace(t, r"^\S+\s*", ""))
    found = lambda pattern: F.nullif(F.regexp_extract(rest, pattern, 1), F.lit(""))
    word = F.when(~rest.rlike(r"^(SPLIT=|\^\^|@)"), F.regexp_replace(F.regexp_replace(found(r"^(\S+)"), r"\^\^.*$|SPLIT=.*$", ""), r"@[A-Za-z]+(-[A-Za-z0-9]+)*$", ""))
    prop = F.nullif(F.regexp_replace(word, r"^<|[>,;.]+$", ""), F.lit(""))
    return F.struct(
        F.when(known, F.regexp_extract(t, r"^(\S+)", 1)).alias("kind"),
        F.when(prop == "rdfs:label", "http://www.w3.org/2000/01/rdf-schema#label").otherwise(prop).alias("property"),
        found(r"\^\^<?([^\s>]+?)>?(?:\s|$)").alias("datatype"), found(r"@([A-Za-z]+(?:-[A-Za-z0-9]+)*)(?:\s|$)").alias("lang"),
        found(r"SPLIT=(\S+)").alias("split"))


def literal_int(v, default: int | None = 0) -> Column:
    """Integer value of a literal's text, through double so that ``3.0`` counts as 3."""
    n = _c(v).try_cast("double").try_cast("bigint")
    return n if default is None else F.coalesce(n, F.lit(default))


def literal_datatype(datatype="o_datatype", lang="o_lang") -> Column:
    return F.when(_c(lang) != "", F.lit(RDF + "langString")).otherwise(F.coalesce(_c(datatype), F.lit(XSD + "string")))


def normalized_label(s) -> Column:
    return F.lower(F.trim(F.regexp_replace(_c(s), r"\s+", " ")))
