"""Exact top-k inner products on a bit-sliced index.

Each component is quantised to floor(256 * x). A shard's index holds, for every
attribute and binary place, the bitmap of its rows that have this bit (values
are counted from the attribute's least one, so they are not negative). A query's
score of all rows at once is the sum of these slices: each factor is written in
signed binary digits, a digit shifts the attribute's slices, a negative digit
takes their complements, and all slices of one place are added by full adders
on whole bitmaps, three into one and a carry for the next place. The sum's
slices are then read from the most significant one downward: rows that have the
bit stay in the lead while there are enough of them, else they are chosen and
the rest go on. Rows that tie at the boundary to the last slice are resolved by
id. The scores of the chosen rows are their exact integer products.

Sums of a query and a shard that might leave ``SAFE`` are not sliced but formed of
exact integers; a score among the best that does not fit a long, or a component
from 2^62 / 256 on, raises OverflowError. The other cases are in ``vectors``.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

SCALE = 256
SHARD, BLOCK = 32768, 1024
VALUES = 1 << 21  # components of a shard: longer vectors have fewer rows
EXACT_ROWS = 8192  # handled at once as objects
SAFE = 1 << 61  # bound on the sum over attributes of a factor times the shard's widest value


def quantise(x: np.ndarray) -> np.ndarray:
    v = np.floor(x * SCALE)
    if v.size and np.abs(v).max() >= 2.0 ** 62:
        raise OverflowError("a component times 256 does not fit 62 bits")
    return v.astype(np.int64)


def narrow(v: np.ndarray) -> np.ndarray:
    """``v`` in the least integer type that holds it."""
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= v.min(initial=0) and v.max(initial=0) <= np.iinfo(kind).max:
            return v.astype(kind)
    return v


def vectors_of(data: bytes, rows: int, dim: int) -> np.ndarray:
    """What ``narrow`` made, from its bytes."""
    return np.frombuffer(data, f"i{len(data) // (rows * dim)}").reshape(rows, dim)


def exact_best(ids: np.ndarray, v: np.ndarray, q: np.ndarray, own: int, k: int) -> tuple[list[int], list[int]]:
    """(ids, scores) of the k best rows but ``own``, in integers of any size."""
    factor = q.astype(object)
    score = np.concatenate([(v[r:r + EXACT_ROWS].astype(object) * factor).sum(axis=1) for r in range(0, len(v), EXACT_ROWS)])
    at = sorted((r for r in range(len(ids)) if ids[r] != own), key=lambda r: (-score[r], ids[r]))[:k]
    if any(abs(score[r]) >= 1 << 63 for r in at):
        raise OverflowError("a score does not fit a long")
    return ids[at].tolist(), [int(score[r]) for r in at]


def bitmap(flags: np.ndarray) -> np.ndarray:
    """Flags (..., rows) as 64-bit words, row 0 the lowest bit of the first."""
    n = flags.shape[-1]
    wide = np.zeros((*flags.shape[:-1], -(-n // 64) * 64), bool)
    wide[..., :n] = flags
    return np.packbits(wide, axis=-1, bitorder="little").view(np.uint64)


def build(ids: np.ndarray, x: np.ndarray) -> dict[str, np.ndarray]:
    """A shard's quantised vectors and their slices."""
    v = quantise(x)
    low = v.min(axis=0)
    u = v - low
    places = np.array([int(m).bit_length() for m in u.max(axis=0)], np.int64)
    slices = [bitmap((u[:, j] >> np.arange(p)[:, None]) & 1 == 1) for j, p in enumerate(places.tolist()) if p]
    words = -(-len(v) // 64)
    return {"ids": ids, "v": narrow(v), "places": places, "slices": np.concatenate(slices) if slices else np.zeros((0, words), np.uint64)}


@functools.lru_cache(maxsize=1 << 16)
def signed_digits(q: int) -> tuple[tuple[int, int], ...]:
    """(place, +1 or -1) of the non-adjacent form of q."""
    out, k = [], 0
    while q:
        if q & 1:
            d = 2 - (q & 3)
            out.append((k, d))
            q -= d
        q >>= 1
        k += 1
    return tuple(out)


def terms(q: np.ndarray, places: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the slices that a query adds, place by place; how many at each place).
    The complement of a slice has its number plus that of all slices."""
    digits = [(j, place, sign) for j, f in enumerate(q.tolist()) for place, sign in signed_digits(f)]
    j, at, sign = np.array(digits, np.int64).reshape(-1, 3).T
    wide = places[j]
    ends = np.cumsum(wide)
    bit = np.arange(wide.sum()) - np.repeat(ends - wide, wide)
    place = np.repeat(at, wide) + bit
    number = np.repeat(first[j] + np.where(sign < 0, places.sum(), 0), wide) + bit
    return number[np.argsort(place, kind="stable")], np.bincount(place)


class Adder:
    """Adds slices on bitmaps of ``words`` words, in arrays that are used again."""

    def __init__(self, words: int):
        self.words, self.most = words, -1

    def reserve(self, most: int) -> None:
        """For ``most`` slices at a place. The place before carries no more than that, and one."""
        if most > self.most:
            self.most = most
            make = lambda n: np.empty((n, self.words), np.uint64)
            self.rows, self.half, self.both = make(2 * most + 2), make(most + 1), make(most + 1)
            self.carries = [make(most + 2), make(most + 2)]

    def add(self, slices: np.ndarray, numbers: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """Slices of the sum of the slices named by ``numbers``, ``counts`` of them at each place."""
        self.reserve(int(counts.max(initial=0)))
        out: list[np.ndarray] = []
        rows, (came, goes) = self.rows, self.carries
        counts, at, carried, place = counts.tolist(), 0, 0, 0
        while place < len(counts) or carried:
            own = counts[place] if place < len(counts) else 0
            n = carried + own
            rows[:carried] = came[:carried]
            np.take(slices, numbers[at:at + own], axis=0, out=rows[carried:n], mode="clip")
            at, carried, place = at + own, 0, place + 1
            while n > 2:
                k = n // 3
                a, b, c, half, both = rows[:k], rows[k:2 * k], rows[2 * k:3 * k], self.half[:k], self.both[:k]
                np.bitwise_xor(a, b, out=half)
                np.bitwise_and(a, b, out=both)
                np.bitwise_xor(half, c, out=a)
                np.bitwise_and(half, c, out=half)
                np.bitwise_or(both, half, out=goes[carried:carried + k])
                rows[k:n - 2 * k] = rows[3 * k:n]
                n, carried = n - 2 * k, carried + k
            if n == 2:
                np.bitwise_and(rows[0], rows[1], out=goes[carried])
                carried += 1
                out.append(rows[0] ^ rows[1])
            else:
                out.append(rows[0].copy() if n else np.zeros(self.words, np.uint64))
            came, goes = goes, came
        return out


def score_slices(q: np.ndarray, places: np.ndarray, slices: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Slices of every row's score, up to a constant of the query."""
    return Adder(slices.shape[-1]).add(np.concatenate([slices, ~slices]), *terms(q, places, first))


def top_rows(total: list[np.ndarray], among: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k rows of ``among`` (bitmap) with the largest sums; the
    first rows of those that tie."""
    chosen, lead = np.zeros_like(among), among
    for s in reversed(total):
        have = lead & s
        n = int(np.bitwise_count(chosen | have).sum())
        if n > k:
            lead = have
        else:
            chosen, lead = chosen | have, lead & ~s
            if n == k:
                lead = np.zeros_like(lead)
                break
    numbers = lambda bits: np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))
    sure = numbers(chosen)
    return np.concatenate([sure, numbers(lead)[:k - len(sure)]])


def find(row: dict, dim: int) -> tuple[list[int], list[int], list[int]]:
    """Best rows of one shard for one block of queries."""
    ids, qid = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
    v, qv = vectors_of(row["v"], len(ids), dim), vectors_of(row["q_v"], len(qid), dim).astype(np.int64)
    places = np.frombuffer(row["places"], np.int64)
    words = -(-len(ids) // 64)
    slices = np.frombuffer(row["slices"], np.uint64).reshape(-1, words)
    first = np.cumsum(places) - places
    signed, adder = np.concatenate([slices, ~slices]), Adder(words)
    everyone = bitmap(np.ones(len(ids), bool))
    widest = [2 * max(-low, high) for low, high in zip(v.min(axis=0).tolist(), v.max(axis=0).tolist())]  # no value less the least one is wider
    out: tuple[list, list, list] = ([], [], [])
    for k, q in enumerate(qv):
        if sum(m * abs(f) for m, f in zip(widest, q.tolist())) >= SAFE:
            near, score = exact_best(ids, v, q, int(qid[k]), vectors.TOP)
            out[0].extend([int(qid[k])] * len(near))
            out[1].extend(near)
            out[2].extend(score)
            continue
        among = everyone.copy()
        own = int(np.searchsorted(ids, qid[k]))
        if own < len(ids) and ids[own] == qid[k]:
            among[own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
        at = top_rows(adder.add(signed, *terms(q, places, first)), among, vectors.TOP)
        out[0].extend([int(qid[k])] * len(at))
        out[1].extend(ids[at].tolist())
        out[2].extend((v[at].astype(np.int64) @ q).tolist())
    return out


def top_products(embeddings: DataFrame, every: int = vectors.EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every ``every``-th id of ``embeddings``
    (vec_id, embedding) against all others."""
    rows = common.store(vectors.valid(embeddings), "vectors")
    size = F.least(F.lit(SHARD), F.ceil(F.lit(VALUES) / F.col("dim")))
    shards = common.store(vectors.blocks(rows, size, build, "ids v places slices"), "slices")
    asked = rows.where(F.col("vec_id") % every == 0)
    queries = common.store(vectors.blocks(asked, BLOCK, lambda ids, x: {"ids": ids, "v": narrow(quantise(x))}, "ids v"), "queries")
    return vectors.search(shards, queries, find, "long")
