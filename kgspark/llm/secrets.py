"""Secret scans with a random forest that removes false positives; DataFrame functions only.

A candidate is a run of at least ``MIN`` letters, digits and ``+/_-=`` in a text, without a name and equals sign before its value. Shorter values are no candidates. The forest judges it by
length, character transitions (changes between letters, digits and cases, vowel and consonant
alternation, share of digits and distinct characters), dictionary coverage (share of its four-letter
fragments found in frequent words of the corpus) and path (what surrounds it in its word). Training takes labelled findings (a bounded sample, ``SAMPLE``); the dictionary is
counted over all documents and its ``WORDS`` most frequent words are kept, a report of fixed size.

``weak_labels`` labels findings where no reviewed ones exist, by evidence (``EVIDENCE``: quotes, assignment and names in
the neighbouring words) that is no feature: a quoted assignment to a name that says secret is one, a
finding without assignment and name is not, all others have no label and are not trained on.

Defined cases: null and empty texts have no findings; a candidate repeated in a text is found at each
place; repeated documents are scanned one by one; labels of one class only give that class's share as
probability; an empty table gives an empty result. Texts are read whole, as arrays of words.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from kgspark.session import materialize

MIN, SAMPLE, WORDS, FRAGMENT = 16, 20_000, 5_000, 4
TREES, DEPTH, SEED = 24, 6, 11
CANDIDATE = r"[A-Za-z0-9+/_=\-]{16,}"
#: A name before a long enough value belongs to the context, not to the secret.
PREFIX = r"^[A-Za-z0-9_\-]+=+(?=[A-Za-z0-9+/_=\-]{16})"
NAMED = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|credential|auth|bearer|private[_-]?key)"
FEATURES = ["length", "switches", "case_switches", "alternation", "digits", "distinct", "hex", "coverage", "path"]
#: What weak labels are made of; the forest never sees it.
EVIDENCE = ["quoted", "assigned", "named_near", "named_far"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word, secret, around, before, before2, after): one row per candidate, ``word`` its place among the text's words."""
    words = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"\s+")
    src = docs.select(F.col(id_col).alias("doc_id"), words.alias("w"))
    at = F.filter(F.transform("w", lambda x, i: F.when((F.char_length(x) >= MIN) & x.rlike(CANDIDATE), i)), lambda i: i.isNotNull())
    hit = src.where(F.exists("w", lambda x: (F.char_length(x) >= MIN) & x.rlike(CANDIDATE))).select("doc_id", F.explode(
        F.transform(at, lambda i: F.struct(
            i.alias("word"), F.get("w", i).alias("around"), F.coalesce(F.get("w", i - 1), F.lit("")).alias("before"),
            F.coalesce(F.get("w", i - 2), F.lit("")).alias("before2"), F.coalesce(F.get("w", i + 1), F.lit("")).alias("after")))).alias("c")).select("doc_id", "c.*")
    each = hit.withColumn("found", F.regexp_extract_all("around", F.lit(CANDIDATE), F.lit(0))).withColumn("secret", F.explode("found")).drop("found")
    return each.withColumn("secret", F.regexp_replace("secret", PREFIX, ""))


def dictionary(docs: DataFrame, text_col: str = "text", words: int = WORDS) -> DataFrame:
    """The most frequent words (4 to 12 letters) of all documents."""
    w = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col).cast("string")), F.lit(r"(?<![\p{L}0-9])\p{L}{4,12}(?![\p{L}0-9])"), F.lit(0))).alias("w"))
    return w.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "w").limit(words)


def _fragments(c: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.char_length(c) - (FRAGMENT - 1)), lambda i: F.substring(F.lower(c), i, F.lit(FRAGMENT)))


def featured(found: DataFrame, words: DataFrame) -> DataFrame:
    """Findings with the forest's features and the evidence of weak labels. ``words`` is a dictionary of bounded size."""
    known = words.select(F.explode(_fragments(F.col("w"))).alias("f")).distinct()
    each = found.select("secret").distinct()
    share = each.select("secret", F.explode(_fragments(F.col("secret"))).alias("f")).join(known.withColumn("k", F.lit(1)), "f", "left").groupBy("secret").agg(
        (F.count("k") / F.count("*")).alias("coverage"))
    s, n = F.col("secret"), F.char_length("secret")
    rate = lambda pattern: F.regexp_count(s, F.lit(pattern)) / n
    flag = lambda c: c.cast("double")
    lead = F.expr("substring_index(around, secret, 1)")
    return found.join(share, "secret").withColumns({
        "length": F.least(n, F.lit(256)).cast("double"),
        "switches": rate(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
        "case_switches": rate(r"(?<=[a-z])(?=[A-Z])"),
        "alternation": rate(r"(?i)(?<=[aeiouy])(?=[b-df-hj-np-tv-xz])|(?<=[b-df-hj-np-tv-xz])(?=[aeiouy])"),
        "digits": rate("[0-9]"),
        "distinct": F.size(F.array_distinct(F.split(s, ""))) / n,
        "hex": flag(s.rlike("^[0-9a-fA-F]+$")),
        "path": F.regexp_count(F.col("around"), F.lit(r"[/\\]|://|\.")).cast("double"),
        "quoted": flag(lead.rlike("[\"'`]$")),
        "assigned": flag(lead.rlike("[=:][\"'`]?$") | F.col("before").rlike("[=:]$")),
        "named_near": flag(F.col("before").rlike(NAMED) | lead.rlike(NAMED)),
        "named_far": flag(F.col("before2").rlike(NAMED)),
    })


def weak_labels(f: DataFrame) -> DataFrame:
    assigned, named = F.col("assigned") > 0, (F.col("named_near") > 0) | (F.col("named_far") > 0)
    return f.withColumn("label", F.when(assigned & (F.col("quoted") > 0) & named, 1.0).when(~assigned & ~named, 0.0))


class SecretModel:
    def __init__(self, forest, share: float):
        self.forest, self.share = forest, share

    def judge(self, f: DataFrame, threshold: float = 0.5) -> DataFrame:
        """``f`` with probability and is_secret."""
        if self.forest is None:
            out = f.withColumn("probability", F.lit(self.share))
        else:
            x = VectorAssembler(inputCols=FEATURES, outputCol="__x").transform(f)
            out = self.forest.transform(x).withColumn("probability", F.round(F.get(vector_to_array("__p"), 1), 9)).drop("__x", "__raw", "__p", "__y")
        return out.withColumn("is_secret", F.col("probability") >= threshold)


def train(labelled: DataFrame, sample: int = SAMPLE) -> SecretModel:
    """A forest on at most ``sample`` labelled findings per class (columns FEATURES, label), chosen by hash of the candidate and its neighbours."""
    key = F.xxhash64("secret", "around", "before", "before2", "after")
    once = labelled.select(*FEATURES, "label", key.alias("k")).where("label is not null").dropDuplicates(["k"])
    ranked = once.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("k"))).where(F.col("r") <= sample)
    rows = materialize(ranked.select(*FEATURES, "label"), "findings")
    n, pos = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or not 0 < pos < n:
        return SecretModel(None, float(pos / n) if n else 0.0)
    x = VectorAssembler(inputCols=FEATURES, outputCol="__x").transform(rows)
    forest = RandomForestClassifier(featuresCol="__x", labelCol="label", predictionCol="__y", probabilityCol="__p", rawPredictionCol="__raw",
                                    numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return SecretModel(forest.fit(x), float(pos / n))


def scan_secrets(docs: DataFrame, model: SecretModel | None = None, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = 0.5) -> DataFrame:
    """(doc_id, word, secret, probability, is_secret) for every candidate of every document."""
    found = materialize(featured(materialize(candidates(docs, id_col, text_col), "candidates"), materialize(dictionary(docs, text_col), "dictionary")), "features")
    model = model or train(labelled if labelled is not None else weak_labels(found))
    return model.judge(found, threshold).select("doc_id", "word", "secret", "probability", "is_secret")
