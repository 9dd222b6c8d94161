"""The registered query of each operator: its whole table, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bitsliced, bpe, byte_bpe, langid, lexical, lm, neardup, packing, quality, runs, secrets, toxicity
from .common import id_remainder, table


def _documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return table(spark, sf_dir, "documents", *cols)


def _with_held_out(docs: DataFrame, m: int, rest: int) -> DataFrame:
    return docs.select("doc_id", (id_remainder(m) == rest).alias("held_out"), "text")


def op1_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_documents(spark, sf_dir, "doc_id", "text"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir, "doc_id", "text"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(_documents(spark, sf_dir, "doc_id", "text"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text", "lang")
    train = docs.where(id_remainder(4) != 2).select("text", "lang")
    return langid.identify(_with_held_out(docs, 4, 2), train)


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return lm.score(_with_held_out(docs, 7, 2), docs.where(id_remainder(7) != 2))


def op7_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_products(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.learn(docs.where(id_remainder(4) != 2), labels, docs.select("text"))
    return toxicity.score(_with_held_out(docs, 4, 2), model)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.learn(docs.where(id_remainder(5) != 0), labels)
    return quality.score(_with_held_out(docs, 5, 0), model)


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_documents(spark, sf_dir, "doc_id", "text"))


def op11_byte_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_documents(spark, sf_dir, "doc_id", "text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(_documents(spark, sf_dir, "doc_id", "text"))


def op13_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "benchmark", "item_id", "text"), _documents(spark, sf_dir, "doc_id", "text"))


QUERIES = {
    "op1_prefix_forest": op1_prefix_forest,
    "op2_secret_scan": op2_secret_scan,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_language_id": op5_language_id,
    "op6_language_model": op6_language_model,
    "op7_bit_sliced_top_k": op7_bit_sliced_top_k,
    "op8_toxicity": op8_toxicity,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_byte_bpe_segment_tree": op11_byte_bpe_segment_tree,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_max_sketch_search": op13_max_sketch_search,
}

# Largest integer inner products, all pairs of a query and another row.
OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# All documents that share a term with an item, scored in full.
OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT doc_id, 25 + CAST((75 * CAST(n AS HUGEINT) * n_docs) // n_terms AS BIGINT) AS m FROM n, total),
item_words AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark),
item AS (SELECT item_id, term, count(*) AS times FROM item_words GROUP BY item_id, term),
weighed AS (
  SELECT item_id, item.term, times,
         CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM item JOIN df ON item.term = df.term, total),
scored AS (
  SELECT item_id, tf.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM weighed JOIN tf ON weighed.term = tf.term JOIN m ON tf.doc_id = m.doc_id
  GROUP BY item_id, tf.doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {"op7_bit_sliced_top_k": OP7_SQL, "op13_max_sketch_search": OP13_SQL}
