import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kgspark.model import QUAD, expand  # noqa: E402
from kgspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def quads(spark):
    """Rows from short notation: (graph, s, p, o) with o '"text"@lang^^type' for literals."""

    def make(*rows):
        out = []
        for g, s, p, o in rows:
            kind, dt, lang = "iri", None, ""
            if o.startswith('"'):
                kind = "literal"
                text, _, tail = o[1:].rpartition('"')
                lang = tail[1:] if tail.startswith("@") else ""
                dt = expand(tail[2:]) if tail.startswith("^^") else None
                o = text
            elif o.startswith("_:"):
                kind = "bnode"
            else:
                o = expand(o)
            out.append((g, expand(s), "bnode" if s.startswith("_:") else "iri", expand(p), o, kind, dt, lang))
        return spark.createDataFrame(out, QUAD)

    return make


def rows(df, *cols):
    df = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in df.collect())
