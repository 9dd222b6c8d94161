"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.

quality     rows that the classifier scores below 0.3 go
language    rows without a letter, or unlike every learned language, go (with none learned, the former only)
near_dedup  one row of each class of near duplicates stays
secrets     secrets in the text are masked
packing     the texts' token pieces, placed into sequences of 2048
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm import langid, neardup, packing, quality, secrets
from meterwise.llm.common import id_remainder, store, table

LEAST_COSINE = 0.1  # with any language's prototype; unrelated letters stay within about 0.05 of 0


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.learn(docs.where(id_remainder(5) != 0).select("doc_id", "text"), labels)
    return quality.keep_good(docs, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    langs, prototypes = langid.prototypes(docs.where(id_remainder(4) != 2).select("text", "lang"))
    return langid.keep_known(docs, langs, prototypes, LEAST_COSINE)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # the classifier, the sampling and the packing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
