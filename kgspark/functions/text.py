"""Text repairs: UTF-8 read as Latin-1, and percent-encoding of IRIs. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SUSPICIOUS = "[\u00c2-\u00f4][\u0080-\u00bf]"


def _once(c: Column) -> Column:
    """One repair, where every character is one Latin-1 byte and the bytes are UTF-8."""
    raw = F.when(~c.rlike("[^\u0000-\u00ff]"), F.encode(c, "ISO-8859-1"))
    return F.coalesce(F.when(F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8")), c)


def fix_mojibake(col, passes: int = 3) -> Column:
    """Undo UTF-8 read as Latin-1, up to ``passes`` times, while it changes and still decodes."""
    c = F.col(col) if isinstance(col, str) else col
    out = c
    for _ in range(passes):
        out = F.when(out.rlike(SUSPICIOUS), _once(out)).otherwise(out)
    return out


# Characters besides letters, digits and ``_.-~`` that stay, by part.
GRAPH_SAFE = {"path": "/%:@!$&'*+,;=", "query": "=&%:@!$'(),*+;/?", "fragment": ""}
DOI_SAFE = {"path": "/:@!$&'()*+,;=", "query": "=&:@!$'()*+,;=", "fragment": ":@!$&'()*+,;="}
IRI_PARTS = r"(?s)^(https?://[^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
#: Outside of these (letters and digits of any script included) an IRI needs encoding.
UNSAFE = r"[^\p{L}\p{N}\p{M}_\-.~:/?#\[\]@!$&'()*+,;=%]"


def quoted(part: Column, safe: str) -> Column:
    """UTF-8 percent-encoding of all but ASCII letters, digits, ``_.-~`` and ``safe``."""
    keep = "^[A-Za-z0-9_.~" + "".join("\\" + x for x in safe) + "-]$"
    one = lambda ch: F.when(ch.rlike(keep), ch).otherwise(F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1"))
    return F.array_join(F.transform(F.split(part, ""), one), "")


def pct_encode(col, mode: str = "graph") -> Column:
    """An http IRI with its parts percent-encoded; other text unchanged.

    ``graph``: only where a character is unsafe; existing escapes stay, letters of all scripts
    alone do not ask for encoding; path parameters (after ``;`` in the last segment) stay as they are.
    ``doi``: always; ``%`` is encoded too.
    """
    c = F.col(col) if isinstance(col, str) else col
    safe = GRAPH_SAFE if mode == "graph" else DOI_SAFE
    part = lambda i: F.regexp_extract(c, IRI_PARTS, i)
    params = F.regexp_extract(part(2), r"(?s)^(?:.*/)?[^/;]*(;[^/]*)$", 1) if mode == "graph" else F.lit("")
    path = F.substring(part(2), F.lit(1), F.length(part(2)) - F.length(params))
    tail = lambda sign, i, k: F.when(part(i) != "", F.concat(F.lit(sign), quoted(part(i), safe[k]))).otherwise("")
    out = F.concat(part(1), quoted(path, safe["path"]), params, tail("?", 3, "query"), tail("#", 4, "fragment"))
    todo = c.rlike(IRI_PARTS) & c.rlike(UNSAFE) if mode == "graph" else c.rlike(IRI_PARTS)
    return F.when(todo, out).otherwise(c)
