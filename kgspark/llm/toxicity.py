"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

``P(grade <= k) = sigmoid(threshold_k - w . x)``: one weight vector is shared by all ordered thresholds.
``x`` holds the presence of words and of word beginnings (``PREFIXES`` letters of longer words, for inflected
families). The model is fitted on at most ``SAMPLE`` labelled documents (those with the smallest hashes of
their id, so the sample is the same at every run), equal ones once; of their features those are kept
whose likelihood ratio for the label stands out among as many as were tried, ``FEATURES`` at most. What reaches the
driver is bounded by these two numbers. All documents are then scored in one map, without a shuffle.

The labels know toxic and not toxic only. ``grade`` orders the toxic ones by how many different words marking
toxic texts they hold: up to two grade 1, up to four grade 2, more grade 3; labels above 1 are
taken as grades of their own.

Defined cases: null texts and texts without words have no features and get the base severity; labels
without a document, documents without a label, and null labels are left out of training; of several
labels of a document the highest counts; with no labels, or of one grade only, no document is
rejected; repeated documents are scored one by one; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kgspark.llm.common import as_bytes, small_batches
from kgspark.session import materialize

SAMPLE, FEATURES, LEAST_DOCS, PREFIXES = 20_000, 1_000, 3, (4, 5, 6)
#: Documents at least this likely toxic are rejected: one marking word is enough, weak hints are not.
REJECT = 0.25
#: Letters and non-ASCII characters make words; A-Z become a-z.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> set[str]:
    return set(as_bytes(text).translate(_TABLE).decode("utf-8", "replace").split())


def matched(found: set[str], known: dict[str, int]) -> dict[str, set[int]]:
    """The known features of every word that has any: ``word`` or ``beginning*``."""
    out = {}
    for w in found:
        hit = {known[w]} if w in known else set()
        for n in PREFIXES:
            if len(w) > n and (p := w[:n] + "*") in known:
                hit.add(known[p])
        if hit:
            out[w] = hit
    return out


class OrdinalModel:
    """features: name -> column; weights; thresholds (ascending)."""

    def __init__(self, features: list[str], weights: np.ndarray, thresholds: np.ndarray):
        self.features, self.weights, self.thresholds = {w: k for k, w in enumerate(features)}, weights, thresholds

    def score(self, text: str | None) -> float:
        cols = set().union(*matched(words(text), self.features).values()) if self.features else set()
        return float(sum(self.weights[k] for k in sorted(cols)))

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(score)[:, None], -60, 60)))


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, n_features: int, n_grades: int, ridge: float = 0.1, rounds: int = 600,
                rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by full-batch Adam on the ridge-penalised log likelihood."""
    docs = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.array([c for r in rows for c in r], np.int64)
    share = np.array([(grades > k).mean() for k in range(n_grades - 1)]).clip(1e-4, 1 - 1e-4)
    base = np.log(1 - share) - np.log(share)
    # thresholds = first + cumulated exponentials of the gaps, so they stay in order
    p = np.concatenate([np.zeros(n_features), [base[0]], np.log(np.maximum(np.diff(base), 0.05))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, rounds + 1):
        w, th = p[:n_features], p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1:]))])
        s = np.bincount(docs, w[cols], len(rows))
        cdf = np.concatenate([np.zeros((len(rows), 1)), 1 / (1 + np.exp(np.clip(s[:, None] - th[None, :], -60, 60))), np.ones((len(rows), 1))], 1)
        i = np.arange(len(rows))
        hi, lo = cdf[i, grades + 1], cdf[i, grades]
        prob = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / prob, lo * (1 - lo) / prob  # derivatives of log prob by the bordering thresholds
        ds = dlo - dhi
        dth = np.array([dhi[grades == k].sum() - dlo[grades == k + 1].sum() for k in range(n_grades - 1)])
        gaps = np.exp(p[n_features + 1:])
        g = np.concatenate([np.bincount(cols, ds[docs], n_features) - ridge * w, [dth.sum()],
                            np.array([dth[k + 1:].sum() for k in range(n_grades - 2)]) * gaps])
        g /= max(1, len(rows))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return p[:n_features], p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1:]))])


def sample_words(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Stored (doc, label, words) of at most ``sample`` labelled documents."""
    spark = docs.sparkSession
    small_batches(spark)
    few = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("k")).agg(F.max(label_col).cast("int").alias("label"))
    few = few.orderBy(F.xxhash64("k"), "k").limit(sample)
    # at most ``sample`` ids: a broadcast of a known size
    joined = docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(few), "k").select("k", "label", "text", F.xxhash64("text").alias("th"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(words(t.as_py())) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(found, pa.list_(pa.string()))], ["k", "label", "th", "words"])

    kind = joined.schema["k"].dataType.simpleString()
    stored = materialize(joined.mapInArrow(split, f"k {kind}, label int, th long, words array<string>"), "labelled")
    return stored.groupBy("th", "words").agg(F.min("k").alias("k"), F.max("label").alias("label"))


def grade(label: int, marked: int) -> int:
    """Grades 0-3 from a binary label: toxic texts by their number of different marking words."""
    return 0 if label <= 0 else 1 if marked <= 2 else 2 if marked <= 4 else 3


def _ratio(pos, df, n_pos: int, n: int):
    """Twice the log likelihood ratio of a feature's label share against the overall one."""
    def part(k, size, share):
        return F.when(k > 0, k * F.log(k / (size * share))).otherwise(0.0)

    share = n_pos / n
    return 2 * (part(pos, df, share) + part(df - pos, df, 1 - share))


def fit(found: DataFrame, n_features: int = FEATURES) -> OrdinalModel:
    """The model of a sample (k, label, words); labels above 1 are taken as grades of their own."""
    spark = found.sparkSession
    found = materialize(found, "sample")
    nothing = OrdinalModel([], np.zeros(0), np.array([60.0, 61.0, 62.0]))
    positive = (F.col("label") > 0).cast("int")
    n, n_pos, top = found.agg(F.count("*"), F.coalesce(F.sum(positive), F.lit(0)), F.coalesce(F.max("label"), F.lit(0))).first()
    if not n or not 0 < n_pos < n:
        return nothing
    begin = F.flatten(F.array(*[F.transform(F.filter("words", lambda w, k=k: F.char_length(w) > k), lambda w, k=k: F.concat(F.substring(w, 1, k), F.lit("*"))) for k in PREFIXES]))
    each = found.select(positive.alias("y"), F.explode(F.array_distinct(F.concat("words", begin))).alias("w"))
    counts = materialize(each.groupBy("w").agg(F.count("*").alias("df"), F.sum("y").alias("pos")).where(F.col("df") >= LEAST_DOCS), "counts")
    tried = max(2, counts.count())
    best = counts.withColumn("g", _ratio(F.col("pos"), F.col("df"), n_pos, n)).where(F.col("g") >= 2 * np.log(tried) + 2).orderBy(
        F.col("g").desc(), "w").limit(n_features).collect()
    if not best:
        return nothing
    names = [r["w"] for r in best]
    marks = {k for k, r in enumerate(best) if r["pos"] > 0.8 * r["df"]}
    sent = spark.sparkContext.broadcast({w: k for k, w in enumerate(names)})

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = [matched(set(w), sent.value) for w in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([sorted(set().union(*h.values())) for h in hits], pa.list_(pa.int64())),
                pa.array([sum(bool(x & marks) for x in h.values()) for h in hits], pa.int64())], ["label", "cols", "marked"])

    rows = sorted((r["label"], r["marked"], r["cols"]) for r in found.select("label", "words").mapInArrow(reduce, "label int, cols array<long>, marked long").collect())
    grades = np.array([y if top > 1 else grade(y, m) for y, m, _ in rows])
    weights, thresholds = fit_ordinal([c for _, _, c in rows], grades, len(names), max(2, int(grades.max()) + 1))
    return OrdinalModel(names, weights, thresholds)


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """``docs`` with a column ``toxicity``: severity (expected grade), grade (most likely), p_toxic, rejected."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast((list(model.features), model.weights, model.thresholds))

    @F.pandas_udf("severity double, grade int, p_toxic double, rejected boolean")
    def judge(texts):
        import pandas as pd

        m = OrdinalModel(*sent.value)
        above = m.above(np.array([m.score(t if isinstance(t, str) else None) for t in texts], float).reshape(-1))
        exact = -np.diff(np.concatenate([np.ones((len(texts), 1)), above, np.zeros((len(texts), 1))], 1), axis=1)
        p = above[:, 0]
        return pd.DataFrame({"severity": above.sum(1), "grade": exact.argmax(1).astype("int32"), "p_toxic": p, "rejected": p >= reject})

    return docs.withColumn("toxicity", judge(F.col(text_col).cast("string")))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> OrdinalModel:
    return fit(sample_words(docs, labels, id_col, text_col, label_col, sample))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The documents that are not rejected, all columns unchanged."""
    return score(docs, train(docs, labels, id_col, text_col), text_col, reject).where(~F.col("toxicity.rejected")).drop("toxicity")
