"""Vectors in blocks: a stated query set against all rows.

Rows are dealt by hash of their id to shards of bounded size; each shard becomes
one row that holds its ids, vectors and whatever index a caller builds of them.
Query rows form blocks likewise. Every (shard, query block) pair yields a few rows
per query, and a window keeps the best ones over all shards. The pairs are formed by
tasks that each read some files of shards and some of query blocks: neither side is
copied for the other in a shuffle or broadcast, whose size would be quadratic.

Vectors that are null, empty, or hold null or non-finite components take no
part, nor do rows without an id. Only vectors of one length are compared. Of
several rows with one id the least vector counts (exact repeats thus count
once). With no queries or no candidates there are no result rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

EVERY = 50  # query ids are divisible by it
TOP = 5
FILES, FILE_VALUES = 64, 1 << 21  # shards are dealt to a file each up to FILES, and to one for every FILE_VALUES components if more


def valid(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, vec, dim`` of the rows that take part, one per id."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    rows = rows.where("vec_id is not null and size(vec) > 0").where(F.coalesce(finite, F.lit(False)))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))


def blocks(rows: DataFrame, size: int | Column, build: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]], parts: str) -> DataFrame:
    """One row per shard of about ``size`` vectors (which may depend on dim): dim, shard,
    shards (of that dim) and the arrays named in ``parts`` that ``build(ids, vectors)`` makes."""
    counts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.ceil(F.count("*") / size).cast("int").alias("shards"))
    values, shards = counts.agg(F.sum(F.col("n") * F.col("dim")), F.sum("shards")).first()
    files = max(1, min(shards or 0, max(FILES, -(-(values or 0) // FILE_VALUES))))
    dealt = rows.join(F.broadcast(counts.drop("n")), "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))
    names = parts.split()

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        made = build(pdf["vec_id"].to_numpy(np.int64), np.stack([np.asarray(v, np.float64) for v in pdf["vec"]]))
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "shards": [int(pdf["shards"].iloc[0])], **{n: [made[n].tobytes()] for n in names}})
    schema = "dim int, shard int, shards int, " + ", ".join(f"{n} binary" for n in names)
    # a broadcast row a dim, and files by shard: else all vectors of a dim may meet in one task and file, which a reader holds whole
    dealt = dealt.select("dim", "shard", "shards", "vec_id", "vec").repartition(files, "dim", "shard")
    return dealt.groupBy("dim", "shard").applyInPandas(run, schema)


def search(shards: DataFrame, queries: DataFrame, find: Callable[[dict, int], tuple], score_type: str) -> DataFrame:
    """Meets every shard with every query block of its dim and keeps each query's TOP
    rows. Both are read from storage, again by each task that needs them.

    ``find(row, dim)`` gets the binary columns (the query block's prefixed with q_)
    and returns (query ids, vec ids, scores)."""
    left, right = (df.drop("shard", "shards") for df in (shards, queries))
    right = right.select(*(F.col(c).alias(f"q_{c}") for c in right.columns))
    pairs = left.join(right.hint("shuffle_replicate_nl"), F.col("dim") == F.col("q_dim")).drop("q_dim")
    names = [c for c in pairs.columns if c != "dim"]
    kind = pa.float64() if score_type == "double" else pa.int64()

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in names}
                qid, vid, score = find(row, b.column("dim")[i].as_py())
                yield common.batch_of(query_id=pa.array(qid, pa.int64()), vec_id=pa.array(vid, pa.int64()), score=pa.array(score, kind))
    # a handful of large rows at a time
    pairs.sparkSession.conf.set(common.ARROW_BATCH_CONF, str(common.ARROW_BATCH_BYTES))
    hits = pairs.select("dim", *names).mapInArrow(run, f"query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
