"""Registered queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kgspark.llm import chat, decontam, exactdup, hardneg, licenses, neardup, ngramjoin, packing, phrases, secrets, shards, toxicity, urlfilter
from kgspark.llm.common import table
from kgspark.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UP, LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return deco


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]

SQL3 = f"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS r FROM pages),
cut AS (SELECT page_id, CASE WHEN r IS NULL THEN '' ELSE regexp_replace(r, '[?#](.|\\n)*$', '') END AS r FROM rest),
part AS (SELECT page_id, translate(CASE WHEN strpos(r, '/') > 0 THEN substr(r, 1, strpos(r, '/') - 1) ELSE r END, {UP}, {LOW}) AS host,
  CASE WHEN strpos(r, '/') > 0 THEN substr(r, strpos(r, '/')) ELSE '' END AS path FROM cut),
rules(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
fit AS (SELECT page_id, host, path, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, length(p) DESC) AS k
  FROM part JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT part.page_id, part.host, part.path, fit.rule, coalesce(fit.v, 'allow') AS verdict FROM part LEFT JOIN fit ON part.page_id = fit.page_id AND k = 1
"""


@query("op3_url_filters", SQL3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def _component_sql(size: int, percent: int, extra: str = "") -> str:
    """Sets of ``size``-word shingles, links of at least ``percent`` percent, components."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UP}, {LOW}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {size - 1}], ' ') AS g FROM d, unnest(generate_series(1, greatest(1, len(w) - {size - 1}))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= {percent} * (a.n + b.n - c)),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id{extra} FROM d JOIN r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op5_minhash_near_dedup", _component_sql(5, 75, ", d.doc_id = min(r.y) AS kept"))
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_dedup(table(spark, sf_dir, "documents"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {UP}, {LOW}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 12], ' ') AS g, least(13, len(w)) AS size
  FROM b, unnest(generate_series(1, greatest(1, len(w) - 12))) AS t(k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM win),
occ AS (SELECT DISTINCT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS g
  FROM d, sizes, unnest(generate_series(1, len(w) - size + 1)) AS t(k) WHERE len(w) >= size),
hit AS (SELECT doc_id, k, occ.size, item_id FROM occ JOIN win ON occ.g = win.g AND occ.size = win.size),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, k, size FROM hit), unnest(generate_series(k, k + size - 1)) AS t(p) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op7_benchmark_decontamination", SQL7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return found.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"), decontam.contaminated().alias("contaminated"))


SQL9 = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), {UP}, {LOW}) AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g ON n.t = g.t
"""


@query("op9_exact_dedup", SQL9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_dedup(table(spark, sf_dir, "documents"))


CONVERSATION = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
_SAID = CONVERSATION[0][3]
_LENGTH = "length(regexp_replace({0}, '(\\\\|### |</turn>)', '\\\\\\1', 'g'))"

SQL6 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_SAID}'), (-7, 1, 'assistant', '{_SAID}'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + {_LENGTH.format('role')} + {_LENGTH.format('text')}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@query("op6_chat_formatting", SQL6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.union(spark.createDataFrame(CONVERSATION, "conv_id long, turn long, role string, text string"))
    return chat.digests(chat.format_conversations(turns)).drop("n_tokens", "n_loss_tokens")


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    t = F.col("toxicity")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", t["severity"].alias("severity"), t["grade"].alias("grade"), t["p_toxic"].alias("p_toxic"),
        t["rejected"].alias("rejected"), (~t["rejected"]).alias("kept"))


@query("op2_secret_scans")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@query("op8_license_scans")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op10_token_binary_output")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark).rstrip('/')}/kgspark/shards-{uuid.uuid4().hex}"
    index = shards.materialise(table(spark, sf_dir, "documents"), path, key="training-order")
    if index.isEmpty():
        return index.withColumn("stored_crc32", F.lit(None).cast("long"))
    return shards.verified(index, shards.read_records(spark, path))


@query("op11_ngram_jaccard_join", _component_sql(3, 90))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.similarity_join(table(spark, sf_dir, "documents"))


SQL12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10
"""


@query("op12_hard_negative_mining", SQL12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


SQL13 = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), {UP}, {LOW}), '[.,;:!?\\x0A-\\x0D]') AS ps FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (SELECT lang, unnest(ps) AS piece FROM d)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, w[i:i + k - 1] AS w FROM p, unnest(generate_series(1, 5)) AS a(k), unnest(generate_series(1, len(w) - k + 1)) AS b(i)),
f AS (SELECT lang, w, count(*) AS f FROM g GROUP BY lang, w),
c AS (SELECT lang, w, f AS a FROM f WHERE len(w) >= 2 AND f >= 100),
inner_ AS (SELECT lang, w[i:i + k - 1] AS w, max(a) AS g FROM c, unnest(generate_series(2, 4)) AS x(k), unnest(generate_series(1, len(w) - k + 1)) AS y(i) WHERE k < len(w) GROUP BY ALL),
kept AS (SELECT c.lang, c.w, a FROM c LEFT JOIN inner_ ON c.lang = inner_.lang AND c.w = inner_.w WHERE g IS NULL OR 100 * g < 100 * a),
cuts AS (SELECT kept.lang, kept.w, a, k, l.f AS l, r.f AS r, n, CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM kept, unnest(generate_series(1, len(kept.w) - 1)) AS t(k) JOIN f l ON l.lang = kept.lang AND l.w = kept.w[1:k]
  JOIN f r ON r.lang = kept.lang AND r.w = kept.w[k + 1:len(kept.w)] JOIN n ON n.lang = kept.lang),
best AS (SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, n, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM best WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000
"""


@query("op13_phrase_collocations", SQL13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
