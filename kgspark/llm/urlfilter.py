"""Allow and block lists for URLs: a trie over reversed host labels and path segments, longest match first.

A rule is a host and the start of a path. It fits its host and all subdomains if the path starts with
the rule's path. Of the rules that fit, the one with most host labels wins, then the longest path; the
same rule in both lists blocks. A URL without a fitting rule gets the default verdict.

The trie is broadcast in blocks of at most ``BLOCK`` rules, whose size is known before anything is
sent; a larger rule table takes several blocks, each pass keeping the better match, so the broadcast
never grows with the rules. Pages are judged in place: no shuffle, and only the url column is read.

Defined cases: a null url or one without ``://`` has an empty host and path; a rule's last path segment
may be partial (``/en/1`` fits ``/en/15``); null or empty hosts in the rule table are ignored; no
rules: every URL gets the default; repeated pages are judged one by one; an empty table stays empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kgspark.llm.common import worker_cache

BLOCK = 200_000
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for end in "?#":
        rest = rest.split(end, 1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_FOLD), slash + path


class Trie:
    """Nodes are dicts. Host labels from the top-level domain down, then path segments under "/".

    A rule ends in a node's "=" entry: {partial last segment: (verdict, rule text)}.
    """

    def __init__(self, rules: Iterator[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.translate(_FOLD).split(".")):
                node = node.setdefault("." + label, {})
            *segments, last = path.split("/")
            for s in segments:
                node = node.setdefault("/" + s, {})
            ends = node.setdefault("=", {})
            if ends.get(last, ("allow",))[0] != "block":
                ends[last] = (verdict, host.translate(_FOLD) + path)

    def best(self, host: str, path: str):
        """(host labels, path length, verdict, rule) of the best fit or None."""
        node, depth, tops = self.root, 0, []
        for label in reversed(host.split(".")):
            node = node.get("." + label)
            if node is None:
                break
            depth += 1
            tops.append((depth, node))
        segments = path.split("/")
        for depth, node in reversed(tops):
            found, used = None, 0
            for s in segments:
                ends = node.get("=")
                if ends:
                    for n in range(len(s), -1, -1):
                        hit = ends.get(s[:n])
                        if hit:
                            found = (depth, used + n, *hit)
                            break
                node = node.get("/" + s)
                if node is None:
                    break
                used += len(s) + 1
            if found:
                return found
        return None


def _blocks(spark: SparkSession, rules, size: int) -> Iterator[list[tuple[str, str, str]]]:
    """Rules (host, path, verdict) in bounded lists; ``rules`` is a list or a table of those columns."""
    if not isinstance(rules, DataFrame):
        clean = [r for r in rules if r[0]]
        for i in range(0, len(clean), size):
            yield clean[i:i + size]
        return
    t = rules.where("host is not null and host != ''").select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict")
    n = -(-t.count() // size)
    for i in range(n):
        yield [tuple(r) for r in t.where(F.pmod(F.xxhash64("host", "path"), F.lit(n)) == i).collect()]


def judge(url: Column, rules, spark: SparkSession, default: str = "allow", block: int = BLOCK) -> Column:
    """A struct column (host, path, rule, verdict); rule is null where none fits."""
    sent = [(uuid.uuid4().hex, spark.sparkContext.broadcast(b)) for b in _blocks(spark, rules, block)]

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def verdict(urls: pd.Series) -> pd.DataFrame:
        tries = [worker_cache(f"trie:{k}", lambda b=b: Trie(b.value)) for k, b in sent]
        out = []
        for u in urls:
            host, path = host_path(u if isinstance(u, str) else None)
            fits = [f for t in tries if (f := t.best(host, path))] if host else []
            top = max(fits, key=lambda f: (f[0], f[1], f[2] == "block"), default=None)
            out.append((host, path, top[3] if top else None, top[2] if top else default))
        return pd.DataFrame(out, columns=["host", "path", "rule", "verdict"], dtype=object)

    return verdict(url.cast("string"))


def filter_urls(pages: DataFrame, rules, id_col: str = "page_id", url_col: str = "url", default: str = "allow", block: int = BLOCK) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page."""
    v = pages.select(F.col(id_col).alias("page_id"), judge(F.col(url_col), rules, pages.sparkSession, default, block).alias("v"))
    return v.select("page_id", "v.host", "v.path", "v.rule", "v.verdict")
