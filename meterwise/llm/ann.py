"""Approximate nearest neighbours with a hash-prefix forest.

Each of ``TREES`` trees gives a vector a string of ``BITS`` bits, the signs of
its products with random directions; a tree is the sorted array of its shard's
strings. A query descends every tree to the vectors with the longest common
prefix (binary search), then all trees ascend together, one bit at a time, until
at least ``WANTED`` entries share the prefix. Their union is ranked by the exact
cosine in double precision. Every vector is indexed; shards are searched
independently and their best rows merged, so recall holds at any size.

Zero vectors take no part; the other cases are in ``vectors``.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

TREES, BITS = 48, 20
WANTED = 1400  # entries of a shard, over all trees, that end the ascent
SHARD, BLOCK = 2048, 512
SEED = 1


@functools.lru_cache(maxsize=8)
def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(dim, TREES * BITS))


def strings(x: np.ndarray) -> np.ndarray:
    """(TREES, rows) hash strings as integers, first bit most significant."""
    bits = (x @ directions(x.shape[1]) >= 0).reshape(len(x), TREES, BITS)
    return (bits @ (1 << np.arange(BITS - 1, -1, -1))).T.astype(np.int32)


def build(ids: np.ndarray, x: np.ndarray) -> dict[str, np.ndarray]:
    """A shard's vectors and its trees: sorted strings and the rows they belong to."""
    s = strings(x)
    order = np.argsort(s, axis=1, kind="stable").astype(np.int32)
    return {"ids": ids, "x": x, "tree": np.take_along_axis(s, order, 1), "rows": order}


def ranges(tree: np.ndarray, q: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """In a sorted array, the range that shares ``level`` bits with each query string."""
    drop = BITS - level
    low = q >> drop << drop
    return np.searchsorted(tree, low), np.searchsorted(tree, low + (1 << drop))


def candidates(tree: np.ndarray, rows: np.ndarray, q: np.ndarray, wanted: int = WANTED):
    """For each query a mask of the shard's rows that the forest proposes."""
    n_q, n = q.shape[1], tree.shape[1]
    lo, hi = np.zeros((TREES, n_q), np.int64), np.zeros((TREES, n_q), np.int64)
    open_ = np.arange(n_q)
    for level in range(BITS, -1, -1):  # from the leaves upwards, all trees together
        for t in range(TREES):
            lo[t, open_], hi[t, open_] = ranges(tree[t], q[t, open_], level)
        open_ = open_[(hi - lo)[:, open_].sum(axis=0) < wanted]
        if not len(open_):
            break
    for k in range(n_q):
        mask = np.zeros(n, bool)
        for t, a, z in zip(range(TREES), lo[:, k].tolist(), hi[:, k].tolist()):
            mask[rows[t, a:z]] = True
        yield mask


def find(row: dict, dim: int) -> tuple[list[int], list[int], list[float]]:
    """Best rows of one shard for one block of queries."""
    ids, qid = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
    x, qx = np.frombuffer(row["x"]).reshape(-1, dim), np.frombuffer(row["q_x"]).reshape(-1, dim)
    tree = np.frombuffer(row["tree"], np.int32).reshape(TREES, -1)
    rows = np.frombuffer(row["rows"], np.int32).reshape(TREES, -1)
    norm, qnorm = np.sqrt((x * x).sum(axis=1)), np.sqrt((qx * qx).sum(axis=1))
    out: tuple[list, list, list] = ([], [], [])
    for k, mask in enumerate(candidates(tree, rows, strings(qx))):
        at = np.flatnonzero(mask)
        at = at[ids[at] != qid[k]]
        score = (x[at] @ qx[k]) / (norm[at] * qnorm[k])
        best = np.lexsort((ids[at], -score))[:vectors.TOP]
        out[0].extend([int(qid[k])] * len(best))
        out[1].extend(ids[at[best]].tolist())
        out[2].extend(score[best].tolist())
    return out


def neighbours(embeddings: DataFrame, every: int = vectors.EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every ``every``-th id of ``embeddings``
    (vec_id, embedding) against all others."""
    rows = common.store(vectors.valid(embeddings).where(F.exists("vec", lambda v: v != 0)), "vectors")
    shards = common.store(vectors.blocks(rows, SHARD, build, "ids x tree rows"), "forest")
    asked = rows.where(F.col("vec_id") % every == 0)
    queries = common.store(vectors.blocks(asked, BLOCK, lambda ids, x: {"ids": ids, "x": x}, "ids x"), "queries")
    return vectors.search(shards, queries, find, "double")
