"""Shared helpers: slices, samples, most frequent rows, words."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from meterwise.llm import common


def test_slices_cover_every_row_within_the_limit():
    texts = ["a" * n for n in (3, 0, 50, 7, 7, 7, 100, 1)] + [None]
    batch = pa.record_batch({"text": pa.array(texts, pa.string()), "k": pa.array(range(9))})
    parts = list(common.slices(batch, 20))
    assert [x for p in parts for x in p.column("k").to_pylist()] == list(range(9))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 20 for p in parts)


def test_most_frequent_is_a_whole_number_of_steps(spark):
    df = spark.createDataFrame([(k, 1000 // (k + 1) + 1) for k in range(500)], "k long, c long")
    for bound in (0, 1, 10, 100, 500, 1000):
        got = [r.c for r in common.most_frequent(df, "c", bound).collect()]
        rest = sorted((r.c for r in df.collect()), reverse=True)
        assert len(got) <= bound and sorted(got, reverse=True) == rest[:len(got)]
    assert common.most_frequent(df, "c", 500).count() == 500
    assert common.most_frequent(df.where("false"), "c", 5).count() == 0


def test_most_frequent_of_equal_counts_is_not_empty(spark):
    df = spark.createDataFrame([(k, 7) for k in range(5000)], "k long, c long")
    got = sorted(r.k for r in common.most_frequent(df, "c", 1000).collect())
    assert 850 < len(got) < 1150
    assert got == sorted(r.k for r in common.most_frequent(df.repartition(3), "c", 1000).collect())


def test_hash_sample(spark):
    ids = spark.range(5000).select(F.col("id").alias("doc_id")).union(spark.createDataFrame([(None,), (1,), (1,)], "doc_id long"))
    few = common.hash_sample(ids, 500, 1)
    got = sorted(r.doc_id for r in few.collect())
    assert 400 < len(got) < 600 and len(set(got)) == len(got)
    assert got == sorted(r.doc_id for r in common.hash_sample(ids, 500, 1).collect())
    assert common.hash_sample(ids, 5000, 1).count() == 5000 and common.hash_sample(ids.where("false"), 5, 1).count() == 0


def test_words():
    offs, codes, uniq = common.words(pa.array([" B b\tA ", None, "", "É é"]), "ascii")
    assert [[uniq[c] for c in codes[a:b]] for a, b in zip(offs, offs[1:])] == [["b", "b", "a"], [], [], ["É", "é"]]
    offs, codes, uniq = common.words(pa.array(["É é"]), "utf8")
    assert len(uniq) == 1
    assert common.segment_sum(np.array([1.0, 2, 3]), np.array([0, 0, 2, 3])).tolist() == [0, 3, 3]


def test_sieve_keeps_every_key_and_few_others(spark):
    rows = spark.range(60000).selectExpr("id AS k", "'x' AS text").union(spark.createDataFrame([(None, "n")], "k long, text string"))
    keys = common.store(spark.createDataFrame([(k * 17 - 50,) for k in range(1000)] + [(None,), (86,)], "k long"), "keys")
    got = common.sieve(rows, keys, "k")
    assert got.columns == rows.columns
    assert {r.k for r in got.join(keys, "k", "left_semi").collect()} == {17 * k - 50 for k in range(3, 1000)}
    assert got.count() < 0.15 * rows.count()
    full = common.sieve(rows, keys, "k", bound=64)  # more keys than bits: more rows pass, none is lost
    assert full.join(keys, "k", "left_semi").count() == 997
    assert common.sieve(rows, keys.where("false"), "k").count() == 0
