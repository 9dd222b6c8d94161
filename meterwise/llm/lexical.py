"""Ranked lexical search with hashed max-sketches.

Items (queries) and documents are bags of terms: maximal stretches of letters, digits
and non-ASCII characters, only A-Z lower-cased. A document's impact for a term is

    w * ((1000000000 * tf) div (1000 * tf + 8 * m)),  w = floor(1000 * ln((2N + 2) / (2df + 1))),
    m = 100 - 75 + (75 * n * N) div L

(N documents with a term, L all their terms, n the document's, df the documents that
hold the term, tf its occurrences); a score sums the impacts of an item's terms,
repeats included. Corpus statistics cover all documents.

1. The documents are read once into a forward index: (doc_id, n, items' terms, tf).
2. N, L and df are aggregated from it.
3. In each task, the impacts of a document fold into a sketch: the largest impact of
   the terms that share a hashed coordinate. Looking up all items' terms in the
   sketches of a slice of documents gives upper bounds of all scores. Per item,
   documents are scored exactly by descending bound until no bound reaches the item's
   k-th best score so far. A task hands on k rows an item, of which the best k stay.

Items go through these steps in blocks of bounded text, so the terms, weights and items
that tasks are sent are bounded however many items there are.

Null texts, and texts without terms, have no score; a document with a null doc_id counts
and ranks after its equals. Every row of documents is one document, also if an id
repeats. Exactly repeated items count once; items that share an id are ranked each on
its own. Equal scores go by doc_id. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

ITEM_BYTES = 4 << 20  # text of the items of one block
COORDINATES = 1 << 10  # of a sketch
CELLS = 1 << 20  # items x documents, or looked up rows x documents, at once
FIRST = 16  # documents an item that are scored in the first round

TERM_BYTE = np.zeros(256, bool)
TERM_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets of each text's terms, all terms as bytes)."""
    t = pa.concat_arrays([pc.ascii_lower(common.text_bytes(texts))])
    size = pc.binary_length(t).to_numpy(zero_copy_only=False).astype(np.int64)
    edge = np.concatenate([[0], np.cumsum(size)])
    total = int(edge[-1])
    if not total:
        return np.zeros(len(size) + 1, np.int64), pa.array([], pa.binary())
    lo = int(np.frombuffer(t.buffers()[1], np.int32)[t.offset])
    data = np.frombuffer(t.buffers()[2], np.uint8)[lo:lo + total]
    inside = TERM_BYTE[data]
    fresh = np.zeros(total + 1, bool)  # a text begins
    fresh[edge] = True
    begin = np.flatnonzero(inside & (fresh[:-1] | ~np.concatenate([[False], inside[:-1]])))
    end = np.flatnonzero(inside & (fresh[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    if not len(begin):
        return np.zeros(len(size) + 1, np.int64), pa.array([], pa.binary())
    bounds = np.stack([begin, end], 1).ravel().astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
    return np.searchsorted(begin, edge), pieces.take(pa.array(np.arange(0, len(bounds), 2)))  # every other piece is a gap


class Items:
    """A block of items: their distinct terms, and each item's terms with repeats counted."""

    def __init__(self, texts: list[str | None]):
        offs, all_terms = terms(pa.array(texts, pa.string()))
        enc = all_terms.dictionary_encode()
        self.vocabulary: pa.Array = enc.dictionary
        v = max(1, len(self.vocabulary))
        item = np.repeat(np.arange(len(texts)), np.diff(offs))
        key, self.times = np.unique(item * v + enc.indices.to_numpy().astype(np.int64), return_counts=True)
        self.term = key % v
        self.begin = np.searchsorted(key // v, np.arange(len(texts) + 1))
        self.coordinate = np.array([zlib.crc32(t) % COORDINATES for t in self.vocabulary.to_pylist()], np.int64)
        # what an item looks up in a sketch: at most COORDINATES rows
        of = np.repeat(np.arange(len(texts)), np.diff(self.begin))
        key, where = np.unique(of * COORDINATES + self.coordinate[self.term], return_inverse=True)
        self.look = key % COORDINATES
        self.look_times = np.bincount(where, self.times, len(key)).astype(np.int64)
        self.look_begin = np.searchsorted(key // COORDINATES, np.arange(len(texts) + 1))


def index(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """One row per document with terms: (doc_id, n, term, tf), the terms of ``vocabulary`` by their number."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        offs, found = terms(b.column("text"))
        n = np.diff(offs)
        number = pc.index_in(found, value_set=vocabulary)
        hit = pc.is_valid(number).to_numpy(zero_copy_only=False)
        v = max(1, len(vocabulary))
        row = np.repeat(np.arange(len(n)), n)[hit]
        key, tf = np.unique(row * v + number.drop_null().to_numpy().astype(np.int64), return_counts=True)
        at = pa.array(np.searchsorted(key // v, np.arange(len(n) + 1)), pa.int32())
        out = common.batch_of(doc_id=b.column("doc_id"), n=pa.array(n, pa.int64()),
                              term=pa.ListArray.from_arrays(at, pa.array(key % v, pa.int32())),
                              tf=pa.ListArray.from_arrays(at, pa.array(tf, pa.int64())))
        return out.filter(pa.array(n > 0))
    return common.map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                           "doc_id long, n long, term array<int>, tf array<long>")


class Scorer:
    """Exact scores and bounds of one block of items under given corpus statistics."""

    def __init__(self, items: Items, n_docs: int, n_terms: int, df: dict[int, int]):
        self.items, self.n_docs, self.n_terms = items, n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1)))
                                for t in range(len(items.vocabulary))], np.int64)

    def impacts(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        wide = n if 75 * int(n.max()) * self.n_docs < 1 << 62 else n.astype(object)
        m = (25 + 75 * wide * self.n_docs // self.n_terms).astype(np.int64)
        return self.weight[term] * (1000000000 * tf // (1000 * tf + 8 * m[doc]))

    def best(self, state: Best, n: np.ndarray, ids: np.ndarray, null: np.ndarray,
             doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """Take the documents of a slice (their entries sorted by document and term) into ``state``."""
        it = self.items
        impact = self.impacts(n, doc, term, tf)
        sketch = np.zeros((COORDINATES, len(n)), np.int64)
        np.maximum.at(sketch, (it.coordinate[term], doc), impact)
        key = doc * len(it.vocabulary) + term
        n_items = len(it.begin) - 1
        a = 0
        while a < n_items:  # as many items as their looked up rows allow
            b = max(a + 1, int(np.searchsorted(it.look_begin, it.look_begin[a] + CELLS // len(n), "right")) - 1)
            b = min(b, n_items, a + max(1, CELLS // len(n)))
            s = slice(int(it.look_begin[a]), int(it.look_begin[b]))
            bound = np.zeros((b - a, len(n)), np.int64)
            filled = np.flatnonzero(np.diff(it.look_begin[a:b + 1]))
            if len(filled):
                rows = sketch[it.look[s]] * it.look_times[s, None]
                bound[filled] = np.add.reduceat(rows, it.look_begin[a:b][filled] - it.look_begin[a], axis=0)
            take = FIRST
            while True:
                least = np.maximum(state.threshold(a, b), 1)
                open_ = bound >= least[:, None]
                some = np.flatnonzero(open_.any(axis=1))
                if not len(some):
                    break
                if take < len(n):
                    top = np.argpartition(-bound[some], take, axis=1)[:, :take]
                else:
                    top = np.tile(np.arange(len(n)), (len(some), 1))
                i, d = np.repeat(some, top.shape[1]), top.ravel()
                chosen = open_[i, d]
                i, d = i[chosen], d[chosen]
                bound[i, d] = -1
                state.add(a + i, self.scores(a + i, d, key, impact), ids[d], null[d])
                take *= 2
            a = b

    def scores(self, item: np.ndarray, doc: np.ndarray, key: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Exact scores of (item, document) pairs, some pairs at a time."""
        it, out = self.items, np.zeros(len(item), np.int64)
        count = np.diff(it.begin)[item]
        ends = np.cumsum(count)
        a = 0
        while a < len(item):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CELLS, "right")))
            c = count[a:b]
            first = np.cumsum(c) - c
            at = np.repeat(it.begin[item[a:b]] - first, c) + np.arange(int(c.sum()))
            wanted = np.repeat(doc[a:b], c) * len(it.vocabulary) + it.term[at]
            where = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            part = np.where(key[where] == wanted, impact[where], 0) * it.times[at]
            out[a:b] = np.add.reduceat(part, first)  # items with an open bound have terms
            a = b
        return out


class Best:
    """The k best documents of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.zeros(n_items, np.int64)  # k-th best score, 0 while there are fewer
        self.rows = np.zeros((0, 4), np.int64)  # item, score, null id, id: best first within an item

    def threshold(self, a: int, b: int) -> np.ndarray:
        return self.least[a:b]

    def add(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([item, score, null, ids], 1)[score > 0]])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        begin = np.searchsorted(rows[:, 0], rows[:, 0])
        place = np.arange(len(rows)) - begin
        self.rows = rows[place < self.k]
        kth = rows[place == self.k - 1]
        self.least[kth[:, 0]] = kth[:, 1]


def candidates(indexed: DataFrame, scorer: Scorer, k: int) -> DataFrame:
    """The k best documents of each item among each task's."""
    n_items = len(scorer.items.begin) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Best(n_items, k)
        for batch in batches:
            entries = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("term")).to_numpy())])
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(entries, entries[a] + CELLS, "right")) - 1)
                part = batch.slice(a, min(b, a + COORDINATES) - a)
                a += part.num_rows
                lists = part.column("term")
                term = lists.flatten().to_numpy().astype(np.int64)
                if not len(term):
                    continue
                doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
                ids = part.column("doc_id")
                scorer.best(state, part.column("n").to_numpy(), pc.fill_null(ids, 0).to_numpy(),
                            pc.is_null(ids).to_numpy(zero_copy_only=False), doc, term, part.column("tf").flatten().to_numpy())
        for a in range(0, len(state.rows), 1 << 16):
            item, score, null, ids = state.rows[a:a + (1 << 16)].T
            yield common.batch_of(item=pa.array(item, pa.int32()), doc_id=pa.array(ids, pa.int64(), mask=null > 0),
                                  score=pa.array(score, pa.int64()))
    return indexed.mapInArrow(run, "item int, doc_id long, score long")


def search(items: DataFrame, docs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` documents (doc_id, text) of highest score above 0 for each item
    (item_id, text): item_id, rank from 1, doc_id, score."""
    spark = items.sparkSession
    id_type = items.schema["item_id"].dataType
    items = common.store(items.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct(), "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(size / ITEM_BYTES)
    out = None
    for block in range(blocks):
        # one block's items, ITEM_BYTES of text on average, are all that the driver holds
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        some = Items([r["text"] for r in mine])
        if not len(some.vocabulary):
            continue
        indexed = common.store(index(docs, some.vocabulary), "index")
        n_docs, n_terms = indexed.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        df = {r["term"]: r["n"] for r in indexed.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
        best = candidates(indexed, Scorer(some, n_docs, n_terms, df), k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(mine)],
                                      T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_type)]))
        part = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # one row an item of the block
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], T.StructType([T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType()),
                                                      T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return out
