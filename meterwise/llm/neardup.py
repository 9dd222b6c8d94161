"""MinHash near-duplicate classes: improved consistent weighted sampling over
TF-IDF word shingles, banded, verified by weighted Jaccard similarity.

A text's words are its lower-cased parts between white space, a shingle five of
them in a row (the whole text if it has fewer). A shingle weighs tf * idf with
idf = 2 + ln(N / df) / ln(N): smoothed, so that the text shared by a large group
of near copies keeps its weight and the group its similarity. df is exact, over
all documents, for every shingle. The sampling knows that of the ``FREQUENT`` most
frequent ones, which fits a task; any other counts there as in one document (its idf
would lie between theirs and that). Verified links know all: where the others decide
whether a pair is similar enough, their own df is joined.

1. One pass counts every shingle exactly, by buckets of their hashes; another gives
   every document a 64-bit key of its words and its bands: ROWS consistent weighted
   samples (Ioffe) per band.
2. Documents of equal words are one class member from here on. Of the members
   that share a band value (a bucket) the one that shares most values with others
   leads, so a text leads its near copies; each member is verified against its
   leaders by exact weighted Jaccard similarity. Of the members of a bucket that
   then holds several classes, all pairs of different classes that can still reach
   the threshold are verified: those that share one of their rarest shingles, with
   enough weight after it (a positional prefix filter, which loses no pair). Never
   all pairs of a bucket, and no link that joins two classes is lost.
3. Components of the verified links by min-label propagation with pointer
   jumping over the leaders, each round written out; a member follows one leader.

Null texts and texts without words are classes of their own. Repeated rows are
exact copies. A class is named by its least document id (a null id counts as
none). Empty input gives no rows; extra columns are ignored. A pair of
similarity 0.8 misses all bands with probability 2e-4, one of 0.9 with 2e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 3
EARLIER = 16
FREQUENT = 1 << 18  # shingles whose document frequency the sampling knows
BUCKET_BYTES = 8 << 20  # of text, whose shingles one task counts, about
HELD = 1 << 21  # shingles that a task sums before it hands them on
IDF_BASE = 2.0
SEED = 4
CELLS = 1 << 16  # random triples of the sampling

MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (offsets, hashes ascending within a text,
    term frequencies, words per text)."""
    offs, codes, uniq = common.words(texts, "utf8")
    n = len(offs) - 1
    per = np.diff(offs)
    hashed = pd.util.hash_array(np.array(uniq, dtype=object), categorize=False) if uniq else np.zeros(0, np.uint64)
    w = hashed[codes]
    count = np.where(per >= WORDS, per - WORDS + 1, np.minimum(per, 1))
    start = np.concatenate([[0], np.cumsum(count)])
    h = np.zeros(int(start[-1]), np.uint64)
    long = per >= WORDS
    # position of each shingle's first word
    first = np.repeat(offs[:-1] - start[:-1], count) + np.arange(len(h))
    whole = np.repeat(long, count)
    for j in range(WORDS):
        h[whole] = h[whole] * MIX + w[first[whole] + j]
    for d in np.flatnonzero(~long & (per > 0)).tolist():
        x = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in w[offs[d]:offs[d + 1]]:
                x = x * MIX + c
            h[start[d]] = x + np.uint64(per[d])
    h = _mix(h)
    for a, z in zip(start[:-1].tolist(), start[1:].tolist()):
        if z - a > 1:
            h[a:z].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[start[:-1][count > 0]] = True
    at = np.flatnonzero(new)
    tf = np.diff(np.concatenate([at, [len(h)]]))
    return np.searchsorted(at, start), h[at], tf.astype(np.float32), per


class Idf(NamedTuple):
    """Weights of the shingles that have one of their own; all others weigh ``rest``."""

    hashes: np.ndarray  # ascending
    values: np.ndarray
    rest: float
    texts: int
    least: float = 1.0  # what the others weigh at least, as a part of ``rest``

    @classmethod
    def of(cls, hashes: np.ndarray, df: np.ndarray, n: int, most: int = 1) -> Idf:
        """For document frequencies ``df`` of ``hashes`` among ``n`` documents; any other
        shingle counts as in one, and is in ``most`` at most."""
        order = np.argsort(hashes)
        one, low = (float(cls.weight(np.array([x]), n)[0]) for x in (1, min(most, max(n, 1))))
        return cls(hashes[order], cls.weight(df[order], n), one, n, low / one)

    @staticmethod
    def weight(df: np.ndarray, n: int) -> np.ndarray:
        return (IDF_BASE + np.log(max(n, 1) / df) / np.log(max(n, 2))).astype(np.float32)

    def reached(self, threshold: float) -> float:
        """The similarity by these weights that a pair has at least, which has ``threshold`` by exact ones."""
        return threshold if self.least == 1 else self.least * threshold / (self.least * threshold + 1 - threshold)


def _summary(hashes: np.ndarray, counts: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums of equal ``hashes``; where they are more than ``bound``, the largest, all
    less the largest count left out, which is given too (a mergeable summary of
    frequent items: nothing is counted short by more than the sum of these)."""
    h, inv = np.unique(hashes, return_inverse=True)
    n = np.bincount(inv, counts, len(h)).astype(np.int64)
    if len(h) <= bound:
        return h, n, 0
    cut = int(np.partition(n, len(n) - bound - 1)[len(n) - bound - 1])
    return h[n > cut], n[n > cut] - cut, cut


def shingle_counts(docs: DataFrame) -> tuple[DataFrame, int]:
    """(``shingle, n``: in how many texts of ``docs`` (text) each shingle is, of all
    shingles that are in two and more; the number of texts with words). Every shingle is
    counted exactly: tasks hand sorted hashes on, dealt to buckets by their first bits,
    and each bucket sums its own; it is bounded, as there are more for more texts."""
    docs.sparkSession.conf.set(common.ARROW_BATCH_CONF, str(common.ARROW_BATCH_BYTES))
    size, n_texts = docs.agg(F.sum(F.octet_length("text")), F.count_if(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))).first()
    bits = max(1, ((size or 0) // BUCKET_BYTES).bit_length())
    bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

    def dealt(parts: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(parts)
        h.sort()
        at = np.flatnonzero(np.append(True, h[1:] != h[:-1])[:len(h)])
        h, n = h[at], np.diff(at, append=len(h))
        once, more = n == 1, n > 1
        blobs = [[x.tobytes() for x in np.split(v, np.searchsorted(by, bounds))] for v, by in ((h[once], h[once]), (h[more], h[more]), (n[more], h[more]))]
        some = [b for b in range(1 << bits) if blobs[0][b] or blobs[1][b]]
        return common.batch_of(bucket=pa.array(some, pa.int32()), **{c: pa.array([v[b] for b in some], pa.binary()) for c, v in zip(("once", "more", "n"), blobs)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        for batch in batches:
            for b in common.slices(batch):
                parts.append(shingles(b.column("text"))[1])
                if sum(map(len, parts)) > HELD:
                    yield dealt(parts)
                    parts = []
        if parts:
            yield dealt(parts)

    def summed(bucket: pa.Table) -> pa.Table:
        once, more, n = (np.frombuffer(b"".join(bucket.column(c).to_pylist()), t) for c, t in (("once", np.uint64), ("more", np.uint64), ("n", np.int64)))
        h, total, _ = _summary(np.concatenate([once, more]), np.concatenate([np.ones(len(once), np.int64), n]), len(once) + len(more))
        return pa.table({"shingle": pa.array(h[total > 1].view(np.int64)), "n": pa.array(total[total > 1])})
    counts = docs.select("text").mapInArrow(run, "bucket int, once binary, more binary, n binary").groupBy("bucket").applyInArrow(summed, "shingle long, n long")
    return common.store(counts, "counts"), n_texts


def frequent(counts: DataFrame, n_texts: int, bound: int = FREQUENT) -> Idf:
    """Weights of the ``bound`` most frequent shingles of ``shingle_counts``."""
    top = common.most_frequent(counts, "n", bound).select("shingle", "n").toArrow()  # at most bound rows, about
    n = top["n"].to_numpy()
    # the others are in a step of most_frequent no higher than the least of these
    most = int(np.ceil(n.min() * 2 ** (1 / 16))) if len(n) and counts.count() > len(n) else 1
    return Idf.of(top["shingle"].to_numpy().view(np.uint64), n, n_texts, most)


def document_frequencies(docs: DataFrame, bound: int = FREQUENT) -> Idf:
    """Weights by exact document frequencies over all ``docs`` (text) of their
    ``bound`` most frequent shingles; any other counts as in one document."""
    return frequent(*shingle_counts(docs), bound)


def _random_cells() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    r = rng.gamma(2.0, 1.0, CELLS).astype(np.float32)
    c = np.log(rng.gamma(2.0, 1.0, CELLS)).astype(np.float32)
    return r, c, rng.random(CELLS, np.float32)


def signatures(offs: np.ndarray, h: np.ndarray, weight: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """(texts, k) consistent weighted samples as 64-bit values; a text needs a
    shingle. Two texts agree in a column with their weighted Jaccard similarity."""
    r, c, beta = _random_cells()
    inverse = 1 / r
    odd = np.random.default_rng(SEED + 1).integers(1, 1 << 62, k, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(offs) - 1, k), np.uint64)
    log_w = np.log(weight)
    starts = offs[:-1]
    low = np.uint64(0xFFFFFFFF)
    step = 1 << 15
    rank = np.empty(len(h), np.uint64)
    for j in range(k):
        for a in range(0, len(h), step):
            z = a + step
            x = h[a:z] * odd[j]
            cell = (x >> np.uint64(48)).astype(np.intp)
            t = np.floor(log_w[a:z] * inverse[cell] + beta[cell])
            ln_a = c[cell] - r[cell] * (t - beta[cell] + 1)
            bits = ln_a.view(np.int32).astype(np.int64)
            bits = np.where(bits < 0, 0x7FFFFFFF - (bits & 0x7FFFFFFF), bits + 0x80000000)  # ordered as the floats are
            rank[a:z] = bits.astype(np.uint64) << np.uint64(32) | (_tie(x) & low)
        out[:, j] = np.minimum.reduceat(rank, starts)
    return out


def _tie(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    return (x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)


def _keys(texts: pa.Array) -> list[int | None]:
    """64-bit key of each text's words; None without words."""
    out = []
    for s in common.text_bytes(texts).to_pylist():
        w = s.lower().split()
        out.append(int.from_bytes(hashlib.blake2b(" ".join(w).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) if w else None)
    return out


def _weights(h: np.ndarray, tf: np.ndarray, idf: Idf) -> np.ndarray:
    own = np.full(len(h), idf.rest, np.float32)
    if len(idf.hashes):
        at = np.minimum(np.searchsorted(idf.hashes, h), len(idf.hashes) - 1)
        hit = idf.hashes[at] == h
        own[hit] = idf.values[at[hit]]
    return tf * own


def _own(h: np.ndarray, idf: Idf) -> np.ndarray:
    """Which of ``h`` have a weight of their own."""
    if not len(idf.hashes):
        return np.zeros(len(h), bool)
    return idf.hashes[np.minimum(np.searchsorted(idf.hashes, h), len(idf.hashes) - 1)] == h


def sketch(docs: DataFrame, idf: Idf, id_col: str = "doc_id") -> DataFrame:
    """``id_col, key, bands`` of every row of ``docs``; null key and bands without words."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        keys = _keys(b.column("text"))
        first = {k: i for i, k in reversed(list(enumerate(keys))) if k is not None}
        rows = sorted(first.values())
        bands: list = [None] * b.num_rows
        if rows:
            offs, h, tf, _ = shingles(b.column("text").take(pa.array(rows)))
            some = np.flatnonzero(np.diff(offs) > 0)
            sig = signatures(np.append(offs[some], len(h)), h, _weights(h, tf, idf))
            value = np.zeros((len(some), BANDS), np.uint64)
            for j in range(ROWS):
                value = _mix(value * MIX + sig[:, j::ROWS] + np.uint64(j + 1))
            of = {keys[rows[i]]: v for i, v in zip(some.tolist(), value.view(np.int64).tolist())}
            bands = [of.get(k) for k in keys]
            keys = [k if k in of else None for k in keys]
        return common.batch_of(**{id_col: b.column(id_col)}, key=pa.array(keys, pa.int64()), bands=pa.array(bands, pa.list_(pa.int64())))
    return common.map_text(docs.select(id_col, "text"), run, f"{id_col} {id_type}, key long, bands array<long>")


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of (hashes ascending, weights) and another."""
    (ha, wa), (hb, wb) = a, b
    at = np.searchsorted(hb, ha)
    hit = (at < len(hb)) & (hb[np.minimum(at, len(hb) - 1)] == ha)
    both = float(np.minimum(wa[hit], wb[at[hit]]).sum(dtype=np.float64))
    return both / (float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - both)


def _weighed(keys: np.ndarray, t: pa.Array, idf: Idf, known: pa.Array | None = None) -> tuple[list[tuple], list[int]]:
    """(shingles and weights of each distinct key's text, which of them each row has);
    ``known``: rows' [(shingle, document frequency)] of shingles without a weight of their own."""
    _, rep, inv = np.unique(keys, return_index=True, return_inverse=True)
    out: list[tuple] = []
    for part in common.slices(common.batch_of(text=t.take(pa.array(rep)))):
        offs, h, tf, _ = shingles(part.column("text"))
        w = _weights(h, tf, idf)
        for x, y in zip(offs[:-1].tolist(), offs[1:].tolist()):
            if known is not None:
                df = known[int(rep[len(out)])].as_py() or []
                hashes = np.array([d["shingle"] for d in df], np.int64).view(np.uint64)
                at = x + np.searchsorted(h[x:y], hashes)
                w[at] = tf[at] * Idf.weight(np.array([d["n"] for d in df], np.int64), idf.texts)
            out.append((h[x:y], w[x:y]))
    return out, inv.tolist()


def verify(pairs: DataFrame, texts: DataFrame, idf: Idf, threshold: float = SIMILARITY, counts: DataFrame | None = None) -> DataFrame:
    """``pairs`` (member, leader) with their similarity; ``texts``: key, text. Where it
    depends on the document frequencies of shingles without a weight of their own
    whether a pair reaches ``threshold``, these are taken from ``counts``, so that
    every pair is on the side of ``threshold`` where exact weights put it."""
    def ends(rows: DataFrame, texts: DataFrame) -> DataFrame:
        for key, end in (("member", ""), ("leader", "_")):
            rows = rows.join(texts.select(F.col("key").alias(key), *(F.col(c).alias(c + end) for c in texts.columns if c != "key")), key)
        return rows

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        (mine, i), (theirs, k) = (_weighed(b.column(c).to_numpy(), b.column(t), idf) for c, t in (("member", "text"), ("leader", "text_")))
        sim = np.array([similarity(mine[x], theirs[y]) for x, y in zip(i, k)])
        # the weight in common and apart changes by a factor between ``least`` and 1
        low, high = (sim * p / (sim * p + (1 - sim) * q) for p, q in ((idf.least, 1), (1, idf.least)))
        return common.batch_of(member=b.column("member"), leader=b.column("leader"), sim=pa.array(sim, pa.float64()),
                               open=pa.array((low < threshold) & (high >= threshold - 1e-9) & (idf.least < 1)))
    found = common.map_text(ends(pairs.select("member", "leader"), texts).select("member", "leader", "text", "text_"), run,
                            "member long, leader long, sim double, open boolean", limit=common.ARROW_BATCH_BYTES)
    if idf.least == 1 or counts is None:
        return found.drop("open")
    found = common.store(found, "told")
    doubtful = found.where("open").select("member", "leader")
    if doubtful.isEmpty():
        return found.drop("open")
    keys = common.store(doubtful.select(F.explode(F.array("member", "leader")).alias("key")).distinct(), "keys")

    def rest(b: pa.RecordBatch) -> pa.RecordBatch:
        offs, h, _, _ = shingles(b.column("text"))
        own = _own(h, idf)
        at = np.concatenate([[0], np.cumsum(~own)])[offs]
        return common.batch_of(key=b.column("key"), shingle=pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h[~own].view(np.int64))))
    asked = common.store(common.sieve(texts, keys, "key").join(keys, "key", "left_semi"), "doubtful")
    rare = common.store(common.map_text(asked, rest, "key long, shingle array<long>").select("key", F.explode("shingle").alias("shingle")), "rare")
    known = rare.join(common.sieve(counts, rare, "shingle"), "shingle").groupBy("key").agg(F.collect_list(F.struct("shingle", "n")).alias("known"))

    def exact(b: pa.RecordBatch) -> pa.RecordBatch:
        (mine, i), (theirs, k) = (_weighed(b.column(c).to_numpy(), b.column("text" + e), idf, b.column("known" + e)) for c, e in (("member", ""), ("leader", "_")))
        return common.batch_of(member=b.column("member"), leader=b.column("leader"), sim=pa.array([similarity(mine[x], theirs[y]) for x, y in zip(i, k)], pa.float64()))
    settled = common.map_text(ends(doubtful, asked.join(known, "key", "left")).select("member", "leader", "text", "text_", "known", "known_"), exact,
                              "member long, leader long, sim double", limit=common.ARROW_BATCH_BYTES)
    return found.where("not open").drop("open").unionByName(settled)


def links(members: DataFrame, docs: DataFrame, idf: Idf, threshold: float = SIMILARITY, counts: DataFrame | None = None) -> DataFrame | None:
    """Verified (member, leader, sim) among ``members`` (key, bands, rep); ``docs``:
    doc_id, text; ``counts``: document frequencies of the shingles that have no weight in ``idf``."""
    rows = members.select("key", F.posexplode("bands").alias("band", "value"))
    shared = rows.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    groups = common.store(rows.join(shared, ["band", "value"]).select(F.xxhash64("band", "value").alias("bucket"), "key", "n"), "buckets")
    reach = groups.groupBy("key").agg(F.sum("n").alias("reach"))
    asked = common.store(members.select("key", "rep").join(reach, "key"), "asked")
    if asked.isEmpty():
        return None
    texts = common.store(_texts(docs, asked.select("key", "rep")), "texts")
    groups = common.store(groups.join(asked, "key").select("bucket", "key", "reach"), "groups")
    lead = groups.groupBy("bucket").agg(F.max(F.struct("reach", "key")).getField("key").alias("leader"))
    first = groups.join(lead, "bucket").where("key <> leader").select(F.col("key").alias("member"), "leader").distinct()
    found = common.store(verify(first, texts, idf, threshold, counts), "sims")
    roots = common.store(roots_of(found.where(F.col("sim") >= threshold)), "roots")
    placed = _placed(groups, roots)
    several = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    mixed = common.store(placed.join(several, "bucket").groupBy("key", "root").agg(F.collect_list("bucket").alias("buckets")), "mixed")
    if not mixed.isEmpty():
        pairs = common.store(_unseen(candidates(mixed, texts, idf, idf.reached(threshold)), found), "pairs")
        found = found.unionByName(common.store(verify(pairs, texts, idf, threshold, counts), "sims"))
    return found.where(F.col("sim") >= threshold)


def _placed(rows: DataFrame, roots: DataFrame, key: str = "key") -> DataFrame:
    """``rows`` with the root of their ``key``: itself where it has no link."""
    return rows.join(roots.withColumnRenamed("key", key), key, "left").withColumn("root", F.coalesce("root", key))


def _unseen(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """``pairs`` (member, leader) that ``found`` holds in neither order."""
    for ends in (("member", "leader"), ("leader", "member")):
        pairs = pairs.join(found.select(*(F.col(c).alias(e) for c, e in zip(("member", "leader"), ends))), ["member", "leader"], "left_anti")
    return pairs


def candidates(mixed: DataFrame, texts: DataFrame, idf: Idf, threshold: float) -> DataFrame:
    """``member, leader``: all pairs of ``mixed`` (key, root, buckets) of different
    roots and a common bucket that can reach ``threshold``. With all shingles in one
    order, rarest first, two texts that reach it share a shingle among those that
    a ``threshold`` of their weight follows, and from their first common one on
    (itself included) each still has the weight that they must have in common. A
    pair that shares one of the ``EARLIER`` shingles before is not given again."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        offs, h, tf, _ = shingles(b.column("text"))
        w = _weights(h, tf, idf).astype(np.float64)
        at = pa.array(offs, pa.int32())
        return common.batch_of(key=b.column("key"), total=pa.array(common.segment_sum(w, offs)),
                               shingle=pa.ListArray.from_arrays(at, pa.array(h.view(np.int64))), weight=pa.ListArray.from_arrays(at, pa.array(w)))
    held = common.map_text(texts.join(mixed.select("key"), "key", "left_semi"), run, "key long, total double, shingle array<long>, weight array<double>")
    each = held.select("key", "total", F.explode(F.arrays_zip("shingle", "weight")).alias("s")).select("key", "total", "s.shingle", "s.weight")
    each = common.store(each, "shingles")
    shared = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    # those of one text alone come first in the order: their weight is what the shared ones leave of the total
    whole = Window.partitionBy("key")
    order = whole.orderBy("n", "shingle")
    rest = F.sum("weight").over(whole) - F.sum("weight").over(order) + F.col("weight")
    head = (each.join(shared, "shingle").withColumn("rest", rest)
            .where(F.col("rest") >= F.col("total") * (threshold - 1e-6)).select("shingle", "key", "total", "rest",
                    F.collect_list("shingle").over(order.rowsBetween(-EARLIER, -1)).alias("earlier")))
    head = common.store(head.join(mixed, "key"), "heads")
    other = head.select("shingle", *(F.col(c).alias(f"{c}_") for c in ("key", "total", "rest", "earlier", "root", "buckets")))
    both = (F.col("total") + F.col("total_")) * (threshold / (1 + threshold) - 1e-6)  # weight in common that the threshold needs
    can = (F.col("root") < F.col("root_")) & (F.least("rest", "rest_") >= both) & ~F.arrays_overlap("earlier", "earlier_") & F.arrays_overlap("buckets", "buckets_")
    return head.join(other, "shingle").where(can).select(F.col("key").alias("member"), F.col("key_").alias("leader")).distinct()


def _texts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """``key, text`` of each asked (key, rep), rep the id of a document of that key."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        same = [a == k for a, k in zip(_keys(b.column("text")), b.column("key").to_pylist())]
        return b.filter(pa.array(same, pa.bool_()))
    joined = common.sieve(docs.select(_id().alias("rep"), "text"), asked, "rep").join(asked, "rep").select("key", "text")
    return common.map_text(joined, run, "key long, text string").dropDuplicates(["key"])


def _id() -> F.Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def roots_of(found: DataFrame) -> DataFrame:
    """``key, root`` of both ends of ``found`` (member, leader); equal roots are
    connected. A member has one edge, to its least leader; that one is joined to the
    member's other leaders, so components run over leaders alone."""
    least = F.min("leader").over(Window.partitionBy("member"))
    stars = common.store(found.select("member", "leader", least.alias("hub")).distinct(), "stars")
    hubs = stars.select("member", "hub").distinct()
    leaders = stars.select(F.col("leader").alias("member")).distinct()
    between = stars.where("leader <> hub").select(F.col("hub").alias("a"), F.col("leader").alias("b"))
    own = hubs.join(leaders, "member", "left_semi").select(F.col("member").alias("a"), F.col("hub").alias("b"))
    roots = components(between.union(own))
    alone = leaders.join(hubs, "member", "left_anti").withColumn("hub", F.col("member"))
    return _placed(hubs.union(alone), roots, "hub").select(F.col("member").alias("key"), "root")


def components(edges: DataFrame) -> DataFrame:
    """``key, root`` of every end of ``edges`` (a, b): the least key it can reach."""
    both = common.store(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = common.store(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "key"), "labels")
    while True:
        near = (both.join(label.select(F.col("key").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
                .withColumnRenamed("a", "key"))
        step = label.join(near, "key").select("key", "root", F.least("root", "near").alias("next"))
        jump = label.select(F.col("key").alias("next"), F.col("root").alias("far"))
        moved = common.store(step.join(jump, "next").select("key", "root", F.least("next", "far").alias("next")), "labels")
        label = moved.select("key", F.col("next").alias("root"))
        if moved.where("next <> root").isEmpty():
            return label


def keep_one(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row, all columns, of each class of ``docs``: that of least doc_id (null
    first), then of least hash of its text. Rows are told apart by file and position,
    so null and repeated ids do no harm; a ``docs`` that is not read from files is
    written first."""
    place = ("_metadata.file_path", "_metadata.row_index")
    try:
        docs.select(*place)
    except AnalysisException:
        docs = common.store(docs, "docs")
    mark = "row_of_class"
    while mark in docs.columns:
        mark += "_"
    rows = docs.select("*", F.xxhash64(*place).alias(mark))
    named = classes(rows.select(F.col(mark).alias("doc_id"), "text"), threshold)
    told = rows.select(F.col(mark).alias("doc_id"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    first = F.min(F.struct("id", "hash", F.col("doc_id").alias("row"))).getField("row")
    kept = named.join(told, "doc_id").groupBy("class_id").agg(first.alias(mark)).select(mark)
    return rows.join(kept, mark, "left_semi").select(*docs.columns)


def classes(docs: DataFrame, threshold: float = SIMILARITY, bound: int = FREQUENT) -> DataFrame:
    """``doc_id, class_id, class_size`` of every row of ``docs`` (doc_id, text):
    class_id is the least document id of the class, class_size its rows. ``bound``:
    how many shingles' weights the sampling knows; links are verified by those of all."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts, n_texts = shingle_counts(docs)
    idf = frequent(counts, n_texts, bound)
    rows = common.store(sketch(docs, idf), "sketch")
    keyed = rows.where("key is not null")
    members = common.store(keyed.groupBy("key").agg(  # rows of a key have the same bands
        F.min(_id()).alias("rep"), F.min("doc_id").alias("least"), F.count("*").alias("rows"), F.first("bands").alias("bands")), "members")
    found = links(members, docs, idf, threshold, counts)
    if found is None:
        named = members.select("key", F.col("least").alias("class_id"), F.col("rows").alias("class_size"))
    else:
        roots = roots_of(found)
        owned = members.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
        total = owned.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("rows").alias("class_size"))
        named = owned.select("key", "root").join(total, "root").select("key", "class_id", "class_size")
    alone = rows.where("key is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return keyed.select("doc_id", "key").join(named, "key").select("doc_id", "class_id", "class_size").union(alone)
