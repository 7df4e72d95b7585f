"""Class axioms of template tabs: the directives C, DOMAIN and RANGE.

A directive holds a class expression in which ``%`` stands for the cell, such as ``C 'has part' some %``. It is read
once per column and becomes rows of a small template table (path, predicate, object); the cells of all tabs are then
joined with it, so the triples of a million rows are one join. Inner nodes of an expression are blank nodes whose labels follow
from the row's id, the directive, the value and the path, so a repeated run gives the same triples.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from kgspark.model import DOMAIN, OWL, RANGE, RDF, SUBCLASS, TYPE, XSD, expand

ATTACH = {"C": SUBCLASS, "DOMAIN": DOMAIN, "RANGE": RANGE}
CELL = "%"
_TOKENS = re.compile(r"""<[^>]*>|'[^']*'|"[^"]*"|[()]|[^\s()]+""")
_FILLER = {"some": "someValuesFrom", "only": "allValuesFrom", "value": "hasValue"}
_CARDINALITY = {"min": "minCardinality", "max": "maxCardinality", "exactly": "cardinality"}
_QUALIFIED = {"min": "minQualifiedCardinality", "max": "maxQualifiedCardinality", "exactly": "qualifiedCardinality"}

TEMPLATE = "directive STRING, attach STRING, path STRING, p STRING, kind STRING, o STRING"


class Expression:
    """Rows (path, predicate, kind, object) of one class expression; ``kind`` says how the object is found:
    ``cell``, ``name`` (an IRI or label), ``node`` (a path) or ``number``."""

    def __init__(self, text: str):
        self.tokens, self.at, self.rows = _TOKENS.findall(text), 0, []
        self.root = self._union("0")
        if self.at < len(self.tokens):
            raise ValueError(f"class expression not understood at {self.tokens[self.at]!r}: {text}")

    def _next(self, *expected: str) -> str | None:
        """The next token, or only if it is one of ``expected``."""
        if self.at == len(self.tokens) or expected and self.tokens[self.at] not in expected:
            if not expected:
                raise ValueError("class expression ends too early")
            return None
        self.at += 1
        return self.tokens[self.at - 1]

    def _add(self, path: str, predicate: str, thing: tuple[str, str]) -> None:
        self.rows.append((path, predicate, *thing))

    def _joined(self, path: str, word: str, predicate: str, part) -> tuple[str, str]:
        parts = [part(f"{path}.0")]
        while self._next(word):
            parts.append(part(f"{path}.{len(parts)}"))
        if len(parts) == 1:
            return parts[0]
        node = f"{path}{word[0]}"
        self._add(node, TYPE, ("name", OWL + "Class"))
        self._add(node, OWL + predicate, ("node", f"{node}l0"))
        for k, thing in enumerate(parts):
            self._add(f"{node}l{k}", RDF + "first", thing)
            self._add(f"{node}l{k}", RDF + "rest", ("node", f"{node}l{k + 1}") if k + 1 < len(parts) else ("name", RDF + "nil"))
        return "node", node

    def _union(self, path: str) -> tuple[str, str]:
        return self._joined(path, "or", "unionOf", self._intersection)

    def _intersection(self, path: str) -> tuple[str, str]:
        return self._joined(path, "and", "intersectionOf", self._primary)

    @staticmethod
    def _name(token: str) -> tuple[str, str]:
        return ("cell", CELL) if token.strip("'\"") == CELL else ("name", expand(token.strip("<>'\"")))

    def _primary(self, path: str) -> tuple[str, str]:
        if self._next("("):
            inside = self._union(path)
            if not self._next(")"):
                raise ValueError("a bracket is not closed")
            return inside
        if self._next("not"):
            self._add(f"{path}n", TYPE, ("name", OWL + "Class"))
            self._add(f"{path}n", OWL + "complementOf", self._primary(f"{path}.0"))
            return "node", f"{path}n"
        inverse = self._next("inverse")
        first = self._name(self._next())
        how = self._next(*_FILLER, *_CARDINALITY, "Self")
        if how is None:
            if inverse:
                raise ValueError("inverse stands before a property only")
            return first
        node = f"{path}r"
        self._add(node, TYPE, ("name", OWL + "Restriction"))
        if inverse:
            self._add(f"{node}i", OWL + "inverseOf", first)
            first = ("node", f"{node}i")
        self._add(node, OWL + "onProperty", first)
        if how == "Self":
            self._add(node, OWL + "hasSelf", ("number", "true"))
        elif how in _FILLER:
            self._add(node, OWL + _FILLER[how], self._primary(f"{path}.0"))
        else:
            n = self._next()
            filler = None if self.at == len(self.tokens) or self.tokens[self.at] in (")", "and", "or") else self._primary(f"{path}.0")
            self._add(node, OWL + (_CARDINALITY if filler is None else _QUALIFIED)[how], ("number", n))
            if filler is not None:
                self._add(node, OWL + "onClass", filler)
        return "node", node


def templates(directives: DataFrame) -> DataFrame:
    """Template rows of all axiom directives; there are as many as there are different directives in the headers."""
    kinds = "|".join(ATTACH)
    texts = [r[0] for r in directives.where(F.trim("directive").rlike(rf"^\s*({kinds})(\s|$)")).select(F.trim("directive")).distinct().collect()]
    out = []
    for text in texts:
        kind, _, rest = text.strip().partition(" ")
        e = Expression(re.sub(r"SPLIT=\S+", "", rest).strip() or CELL)
        out.append((text, ATTACH[kind], "", ATTACH[kind], *e.root))
        out += [(text, ATTACH[kind], *row) for row in e.rows]
    return directives.sparkSession.createDataFrame(out, TEMPLATE)


def axiom_triples(values: DataFrame, directives: DataFrame, index: DataFrame, resolve) -> tuple[DataFrame, DataFrame]:
    """(triples with id as subject or blank nodes, unresolved (tab, row, id, header, value)).

    ``values`` are split cells of axiom columns with their directive; ``resolve`` finds the IRI of a label. An axiom whose cell,
    or a name of whose expression, is not found is left out and reported.
    """
    t = templates(directives)
    cell = resolve(values, index).select("tab", "row", "id", "header", "directive", "value", F.col("iri").alias("cell_iri"))
    names = t.where("kind = 'name'").select("directive", F.col("o").alias("value")).distinct()
    named = resolve(names, index)
    lost = named.where("iri IS NULL").select("directive", F.col("value").alias("name"))
    ok = cell.where("cell_iri IS NOT NULL").join(lost, "directive", "left_anti")
    rows = ok.join(t, "directive").join(named.select("directive", F.col("value").alias("o"), F.col("iri").alias("name_iri")), ["directive", "o"], "left")
    label = lambda path: F.concat(F.lit("_:"), F.substring(F.sha1(F.concat_ws("|", "id", "directive", "value", path)), 1, 20))
    kind = F.col("kind")
    o = F.when(kind == "cell", F.col("cell_iri")).when(kind == "name", F.col("name_iri")).when(kind == "node", label(F.col("o"))).otherwise(F.col("o"))
    number = F.when(F.col("p") == OWL + "hasSelf", XSD + "boolean").otherwise(XSD + "nonNegativeInteger")
    top = F.col("path") == ""
    triples = rows.select(
        F.when(top, F.col("id")).otherwise(label(F.col("path"))).alias("s"), F.when(top, "iri").otherwise("bnode").alias("s_kind"), "p", o.alias("o"),
        F.when(kind == "node", "bnode").when(kind == "number", "literal").otherwise("iri").alias("o_kind"), F.when(kind == "number", number).alias("o_datatype"), F.lit("").alias("o_lang"))
    missing = cell.where("cell_iri IS NULL").select("tab", "row", "id", "header", "value").unionByName(
        cell.join(lost, "directive").select("tab", "row", "id", "header", F.col("name").alias("value")))
    return triples, missing
