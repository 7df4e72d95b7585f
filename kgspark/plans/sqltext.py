"""Small builders for comparison SQL."""

EN = "(o_lang = '' OR lower(o_lang) = 'en' OR lower(o_lang) LIKE 'en-%')"
NODE = "o_kind <> 'literal'"
TERM = "concat_ws(chr(1), o_kind, coalesce(o_datatype, ''), o_lang, o)"
TRIPLE = "s, s_kind, p, o, o_kind, o_datatype, o_lang"
UNION_GRAPH = f"u AS (SELECT DISTINCT {TRIPLE} FROM quads)"
CLASS_TYPES = "('owl:Class', 'rdfs:Class')"
PROP_TYPES = "('rdf:Property', 'owl:ObjectProperty', 'owl:DatatypeProperty', 'owl:AnnotationProperty')"


def v(p: str, a: str, b: str, cond: str = "TRUE", src: str = "quads", keep: str = "") -> str:
    """?a p ?b with any object."""
    return f"(SELECT {keep}s AS {a}, o AS {b} FROM {src} WHERE p = '{p}' AND {cond})"


def e(p: str, a: str, b: str, src: str = "quads", keep: str = "") -> str:
    """?a p ?b with a node as object."""
    return v(p, a, b, NODE, src, keep)


def ty(cls, a: str, src: str = "quads", keep: str = "") -> str:
    classes = [cls] if isinstance(cls, str) else cls
    inside = ", ".join(f"'{c}'" for c in classes)
    return f"(SELECT DISTINCT {keep}s AS {a} FROM {src} WHERE p = 'rdf:type' AND o IN ({inside}))"


def via(p: str, prop: str, a: str, b: str, cls: str | None = None, src: str = "quads") -> str:
    """?a p ?n . [?n a cls .] ?n prop ?b"""
    t = f" JOIN {ty(cls, 'n', src)} USING (n)" if cls else ""
    return f"(SELECT {a}, {b} FROM {e(p, a, 'n', src)} JOIN {v(prop, 'n', b, src=src)} USING (n){t})"


def left(*blocks: tuple[str, str]) -> str:
    """LEFT JOINs of (block, key)."""
    return " ".join(f"LEFT JOIN {b} USING ({k})" for b, k in blocks)


def capped(sql: str, cols: str, n: int | None) -> str:
    tail = f" ORDER BY {cols} LIMIT {n}" if n else ""
    return f"SELECT DISTINCT {cols.replace(' DESC', '')} FROM {sql}{tail}"


def uuid5(expr: str, ns: str = "12345678123456781234567812345678") -> str:
    h = f"sha1(unhex('{ns}') || encode({expr}))"
    nib = f"substr('89ab', CAST(CAST('0x' || substr({h}, 17, 1) AS INTEGER) % 4 + 1 AS BIGINT), 1)"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {nib} || "
            f"substr({h}, 18, 3) || '-' || substr({h}, 21, 12))")
