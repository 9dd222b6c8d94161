"""Best-fit packing of token sequences by exact-complement hashing.

1. Every document is encoded (ids plus one end id 0) and cut into pieces of at
   most ``capacity`` tokens; the pieces' rows are written once.
2. A packing depends only on how many pieces there are of each length, a
   histogram of at most ``capacity`` rows. ``plan`` works on that histogram:
   an index of the lengths on hand answers which single length, pair or triple
   of lengths sums exactly to a gap; such combinations are consumed as often as
   the counts allow. What is left goes, longest first, to the open sequence
   with the smallest gap that holds it (best fit), whole groups of equal
   sequences at a time.
3. Pieces of a length are numbered without sorting them in one place: rows are
   dealt to buckets by hash, bucket sizes give the first number of each bucket,
   and only a bucket's rows are sorted. A piece's number and length say which
   sequence and offset it gets, so a hot length is no hot group.

Null and empty texts are one piece holding the end id. Repeated rows are packed
like any others. Empty input gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe, common

CAPACITY = 2048
BUCKET_ROWS = 2000  # pieces numbered together
SLICE_BYTES = 2 << 20  # text bytes encoded at once
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(total: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of sequences of ``total`` tokens: (sequence, piece, start, length);
    all are full but for a sequence's first."""
    k = -(-total // capacity)
    doc = np.repeat(np.arange(len(total)), k)
    piece = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
    head = total - (k - 1) * capacity
    start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
    return doc, piece, start, np.where(piece == 0, head[doc], capacity)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with the CRC-32 of their ids."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        common.give_back()
        ids, offs = bpe.vocabulary(path or bpe.default_path()).encode(b.column("text"))
        n = np.diff(offs)
        doc, piece, start, length = cut(n + 1, capacity)
        raw, end = ids.astype("<u4").tobytes(), b"\0\0\0\0"
        at, upto = offs[doc] + start, offs[doc] + start + length
        final = start + length == n[doc] + 1  # holds the end id
        crc = [zlib.crc32(end, zlib.crc32(raw[4 * x:4 * y - 4])) if z else zlib.crc32(raw[4 * x:4 * y])
               for x, y, z in zip(at.tolist(), upto.tolist(), final.tolist())]
        return common.batch_of(doc_id=b.column("doc_id").take(pa.array(doc)), piece=pa.array(piece, pa.int32()),
                               start=pa.array(start, pa.int64()), length=pa.array(length, pa.int64()), ids_crc32=pa.array(crc, pa.int64()))
    return common.map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PIECES, SLICE_BYTES)


class _Complements:
    """Lengths on hand; finds one, two or three that sum exactly to a gap."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()

    def find(self, gap: int) -> tuple[int, ...] | None:
        left = self.left
        if gap <= 0:
            return None
        if left[gap]:
            return (gap,)
        if pair := self._pair(gap):
            return pair
        on_hand = np.flatnonzero(left[:max(gap - 1, 0)])
        for a in on_hand[::-1].tolist():  # a is the longest of the three
            if 3 * a < gap:
                break
            left[a] -= 1
            pair = self._pair(gap - a, a)
            left[a] += 1
            if pair:
                return (a, *pair)
        return None

    def _pair(self, gap: int, most: int | None = None) -> tuple[int, int] | None:
        half, top = gap // 2, gap - 1 if most is None else min(most, gap - 1)
        long = np.arange(top, gap - half - 1, -1)
        hit = np.flatnonzero((self.left[long] > 0) & (self.left[gap - long] > 0) & ((2 * long != gap) | (self.left[long] > 1)))
        return (int(long[hit[0]]), gap - int(long[hit[0]])) if len(hit) else None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) for a histogram."""
    hist = np.zeros(capacity + 1, np.int64)
    for k, n in counts.items():
        hist[k] = n
    groups: list[tuple[tuple[int, ...], int]] = []
    if hist[capacity]:
        groups.append(((capacity,), int(hist[capacity])))
        hist[capacity] = 0
    index = _Complements(hist)
    left = index.left
    rest = np.zeros_like(hist)
    for size in range(capacity - 1, 0, -1):
        while left[size]:
            left[size] -= 1
            found = index.find(capacity - size)
            left[size] += 1
            if found is None:
                rest[size], left[size] = left[size], 0
                break
            whole = (size, *found)
            times = min(int(left[x]) // whole.count(x) for x in set(whole))
            for x in whole:
                left[x] -= times
            groups.append((whole, times))
    open_: dict[int, list[list]] = {}  # gap -> [[lengths, count], ...]
    for size in np.flatnonzero(rest)[::-1].tolist():
        n = int(rest[size])
        while n:
            fits = [g for g in open_ if g >= size]
            if not fits:
                each = capacity // size
                if whole := n // each:
                    open_.setdefault(capacity - each * size, []).append([(size,) * each, whole])
                if part := n % each:
                    open_.setdefault(capacity - part * size, []).append([(size,) * part, 1])
                n = 0
                continue
            gap = min(fits)
            lengths, have = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
            each = min(gap // size, n)
            take = min(have, n // each)
            if have > take:
                open_.setdefault(gap, []).append([lengths, have - take])
            open_.setdefault(gap - each * size, []).append([lengths + (size,) * each, take])
            n -= each * take
    groups += [(tuple(lengths), n) for same in open_.values() for lengths, n in same]
    return groups


def _slots(groups: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place in a group's sequence: (length << 40 | number of its first
    piece, first sequence id, offset), ordered by the first."""
    used: dict[int, int] = {}
    rows, seq = [], 0
    for lengths, n in groups:
        offset = 0
        for x in lengths:
            rows.append((x << 40 | used.get(x, 0), seq, offset))
            used[x] = used.get(x, 0) + n
            offset += x
        seq += n
    rows.sort()
    return tuple(np.array(c, np.int64) for c in (zip(*rows) if rows else ((), (), ())))


def number(rows: DataFrame, key: str, order: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with ``number``, 0, 1, ... within each ``key``, of any order that
    is fixed by the columns ``order``; no task sorts a whole key."""
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy(key, "bucket").agg(F.count("*").alias("size"))
    before = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(key, "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy(key, "bucket").orderBy(*order)
    ranked = dealt.withColumn("rank", F.row_number().over(within) - 1)
    return (ranked.join(first, [key, "bucket"])
            .withColumn("number", F.col("first") + F.col("rank")).drop("bucket", "rank", "first"))


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with ``sequence_id`` and ``offset``."""
    cut_rows = common.store(pieces(docs, capacity, path), "pieces")
    hist = {r["length"]: r["n"] for r in cut_rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    key, seq, offset = _slots(plan(hist, capacity))

    def place(batches):
        for b in batches:
            mine = b.column("length").to_numpy() << 40 | b.column("number").to_numpy()
            at = np.searchsorted(key, mine, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(seq[at] + (mine - key[at]), pa.int64()), pa.array(offset[at], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    ranked = number(cut_rows, "length", ["doc_id", "piece", "start", "ids_crc32"])
    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
