"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import (
    bpe, dart, kneser, langid, merkle, negatives, packing, pii, quality, repeats, topk, toxicity, url_rules,
)
from tradeloom.llm.common import table
from tradeloom.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")), "prose-2")
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return entries.select(*base, "fail_bits")


QUERIES["op2_quality_rules"] = op2_quality_rules
ORACLES["op2_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, w, i FROM (
    SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i
    FROM (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d) x) y
),
win AS (
  SELECT doc_id, i, CASE WHEN lead(i, 7) OVER o IS NOT NULL THEN
    w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o
      || ' ' || lead(w, 5) OVER o || ' ' || lead(w, 6) OVER o || ' ' || lead(w, 7) OVER o END AS v
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
twice AS (SELECT doc_id, i, v IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, v) > 1 AS twice FROM win),
covered AS (
  SELECT doc_id, max(CASE WHEN twice THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS 7 PRECEDING) AS c
  FROM twice
),
rep AS (SELECT doc_id, sum(c) AS n_repeat_words FROM covered GROUP BY doc_id),
words AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) x
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
m AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(t) - length(replace(t, '!', '')) AS n_exclaim,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN words USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)
),
b AS (
  SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 14 * n_words OR word_chars < 2 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_exclaim > n_words THEN 32 ELSE 0 END AS fail_bits
  FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept,
  CAST(fail_bits AS BIGINT) AS fail_bits
FROM b
"""

#: Fixed rules of the page filter: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


QUERIES["op5_url_rules"] = op5_url_rules
ORACLES["op5_url_rules"] = r"""
WITH rules(rh, rp, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
),
fit AS (
  SELECT page_id, rh || rp AS rule, rv, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
  FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT h.page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
FROM h LEFT JOIN (SELECT * FROM fit WHERE k = 1) f ON f.page_id = h.page_id
"""


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    out = langid.predict(docs, model)
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


QUERIES["op9_language_id"] = op9_language_id


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, vocabulary, bpe.train_lexicon(docs, vocabulary), digests=True)


QUERIES["op1_bpe"] = op1_bpe


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialize(pii.find(table(spark, sf_dir, "documents")), "pii-candidates")
    return pii.decide(found, pii.learn(found))


QUERIES["op3_pii"] = op3_pii


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


QUERIES["op6_top_k"] = op6_top_k
ORACLES["op6_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) t
WHERE rank <= 10
"""


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.word_count(F.col("text")))


QUERIES["op8_packing"] = op8_packing


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES["op7_near_duplicates"] = op7_near_duplicates


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(table(spark, sf_dir, "documents"), digests=True).withColumnRenamed("kept", "kept_sha256")


QUERIES["op4_repeats"] = op4_repeats


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return kneser.classify(table(spark, sf_dir, "documents"), labels.where("quality = 1 and toxic = 0"))


QUERIES["op10_kneser_ney"] = op10_kneser_ney


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES["op13_merkle_manifest"] = op13_merkle_manifest


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, relabel=relabel)


QUERIES["op11_hard_negatives"] = op11_hard_negatives
ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, a.lab AS alab, c.vec_id, c.lab,
    CAST(list_dot_product(CAST(a.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE lab = alab) t
  WHERE k <= 5
),
neg AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND s.lab <> s.alab
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 10
"""


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, labels, held)


QUERIES["op12_toxicity"] = op12_toxicity
