"""Periodic runs of words: an online, sparse dynamic program over diagonals.

A run is a stretch of words with smallest period q (words q apart are identical), at
least max(12, 2q) long, that no neighbouring word extends keeping period q. Word i and
its earlier occurrence i - q meet on diagonal q; a diagonal on which consecutive words
meet is active, its match length grows word by word, and when it ends with at least
max(12 - q, q) matches its run (matches + q words) is emitted at once.

Kept sparse without losing a run:

* A run of period q has at least max(6, q) matches, so occurrences count by context:
  lags below 12 need the same six words, lags from 6 * 2^t to 12 * 2^t the same
  6 * 2^t words. A context is named by two contexts of half its length, and only
  words whose half contexts occur again get a name.
* Where a context recurs after q words over a stretch (so the stretch has period q),
  earlier occurrences within the stretch lie at multiples of q. Their diagonals cover
  exactly the stretch and would emit it again with a larger period, so only lag q
  advances there. A diagonal of which a part fell away like this is not maximal when
  it ends, and is dropped.

Words are read in blocks with a bounded number of meetings; active diagonals are
carried from block to block. Time follows the meetings, which stay near the number of
words unless very long stretches of one period are separated by a few other words.

Null text has no words; texts are read whole. Repeated rows and extra columns change
nothing, each row stands for itself; a null doc_id counts as the empty id; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SHORTEST = 12  # words of a run, at least
CONTEXT = 6  # a run's matches, at least: max(SHORTEST - q, q) over all q
MEETINGS = 1 << 20  # (word, earlier occurrence) pairs looked at together


def _named(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each distinct key, how often the key occurs)."""
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    return inverse, count[inverse]


def _contexts(doc: np.ndarray, word: np.ndarray):
    """(context length, positions, names) for 6, 12, 24, ... words ending at a position.
    Equal names: the same words of the same document. Positions whose context can't
    occur again are left out."""
    n = len(word)
    name, often = _named(doc * (int(word.max()) + 1) + word)
    at = np.flatnonzero(often > 1)
    whole = np.full(n, -1, np.int64)
    whole[at] = name[at]
    single, length = whole, 1
    for step in (1, 1, 3):  # 2, 3, 6 words
        tail = single if step == 1 else whole
        at = at[at >= step]
        at = at[(whole[at - step] >= 0) & (tail[at] >= 0)]
        if not len(at):
            return
        name, often = _named(whole[at - step] * n + tail[at])
        whole = np.full(n, -1, np.int64)
        whole[at[often > 1]] = name[often > 1]
        at = at[often > 1]
        length += step
    while len(at):
        yield length, at, whole[at]
        at = at[at >= length]
        at = at[whole[at - length] >= 0]
        if not len(at):
            return
        name, often = _named(whole[at - length] * n + whole[at])
        whole = np.full(n, -1, np.int64)
        at = at[often > 1]
        whole[at] = name[often > 1]
        length *= 2


def _diagonals(n: int, length: int, at: np.ndarray, name: np.ndarray, least: int, most: int):
    """Ended diagonals of lags [least, most): (lag, first meeting, last meeting), from
    the positions ``at`` whose contexts are ``name``."""
    order = np.lexsort((at, name))
    key = name[order] * n + at[order]  # sorted by context, then position
    place = np.empty(len(at), np.int64)
    place[order] = np.arange(len(at))
    prior = np.where((place > 0) & (name[order[place - 1]] == name), at - at[order[place - 1]], 0)
    # stretches of consecutive positions whose context recurs after the same lag
    opens = np.ones(len(at), bool)
    opens[1:] = (at[1:] != at[:-1] + 1) | (prior[1:] != prior[:-1])
    opened = at[np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))]
    nearest = (prior >= least) & (prior < most)
    lo = np.searchsorted(key, name * n + np.maximum(at - most + 1, 0))
    hi = np.searchsorted(key, name * n + np.minimum(at - least, opened - prior - 1), "right")
    hi[prior == 0] = lo[prior == 0]
    farther = np.maximum(hi - lo, 0)
    meets = np.cumsum(farther + nearest)
    carried = np.zeros((0, 2), np.int64)  # lag, first meeting, of diagonals active at the block's end
    a, last = 0, -2
    while a < len(at):
        base = meets[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(meets, base + MEETINGS, "right")))
        s = slice(a, b)
        far = np.repeat(np.arange(a, b), farther[s])
        pos = at[order[np.repeat(lo[s] - np.cumsum(farther[s]) + farther[s], farther[s]) + np.arange(len(far))]]
        near = np.flatnonzero(nearest[s]) + a
        i = np.concatenate([at[far], at[near]])
        lag = np.concatenate([at[far] - pos, prior[near]])
        step = np.sort(lag * n + i)
        starts = np.ones(len(step), bool)
        starts[1:] = step[1:] != step[:-1] + 1
        head = step[starts]
        tail = step[np.concatenate([starts[1:], [True]])] if len(step) else step
        lag, first, end = head // n, head % n, tail % n
        # diagonals active at the end of the last block go on, or have ended there
        goes_on = np.zeros(len(carried), bool)
        if len(carried) and len(lag) and at[a] == last + 1:
            joins = np.flatnonzero(first == at[a])
            where = np.minimum(np.searchsorted(carried[:, 0], lag[joins]), len(carried) - 1)
            hit = carried[where, 0] == lag[joins]
            first[joins[hit]] = carried[where[hit], 1]
            goes_on[where[hit]] = True
        ended = carried[~goes_on]
        yield ended[:, 0], ended[:, 1], np.full(len(ended), last)
        last = at[b - 1]
        active = end == last
        yield lag[~active], first[~active], end[~active]
        carried = np.stack([lag[active], first[active]], 1)  # in order of lag
        a = b
    yield carried[:, 0], carried[:, 1], np.full(len(carried), last)


def find(offs: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of all documents (words offs[d] to offs[d + 1]): (start, length, period),
    start counted from the first document's first word, by start, then period."""
    n = len(word)
    found = []
    if n:
        doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
        for length, at, name in _contexts(doc, word):
            least = 1 if length == CONTEXT else length
            for lag, first, last in _diagonals(n, length, at, name, least, 2 * length):
                matches = last - first + length
                ok = matches >= np.maximum(SHORTEST - lag, lag)
                if not ok.any():
                    continue
                lag, matches, begin, end = lag[ok], matches[ok], first[ok] - length + 1, last[ok] + 1
                d = doc[begin]
                left = (begin - lag > offs[d]) & (word[begin - 1] == word[begin - 1 - lag])
                stop = np.minimum(end, n - 1)
                right = (end < offs[d + 1]) & (word[stop] == word[stop - lag])
                whole = ~left & ~right
                found.append(np.stack([begin - lag, matches + lag, lag], 1)[whole])
    if not found:
        return (np.zeros(0, np.int64),) * 3
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)  # of one stretch only the smallest period
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs[:, 0], runs[:, 1], runs[:, 2]


def planted(doc_id: str, n: int) -> np.ndarray | None:
    """The word that stands at each place of a document whose words are made periodic
    by its id, None for the others."""
    h = zlib.crc32(doc_id.encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def digests(b: pa.RecordBatch, plant: bool = True) -> pa.RecordBatch:
    """Runs and collapsed text of each row of (doc_id, text)."""
    offs, word, distinct = common.words(b.column("text"), lower="")
    ids = ["" if d is None else str(d) for d in b.column("doc_id").to_pylist()]
    rows = range(len(ids))
    if plant:
        word = word.copy()
        for d in rows:
            o, e = int(offs[d]), int(offs[d + 1])
            if (moved := planted(ids[d], e - o)) is not None:
                word[o:e] = word[o:e][moved]
    start, length, period = find(offs, word)
    cover = np.zeros(len(word) + 1, np.int64)  # words that a run holds after its first period
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    keep = np.cumsum(cover[:-1]) == 0
    of_doc = np.searchsorted(start, offs)
    out = {k: [] for k in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")}
    for d in rows:
        o, e = int(offs[d]), int(offs[d + 1])
        r = slice(int(of_doc[d]), int(of_doc[d + 1]))
        mine = list(zip((start[r] - o).tolist(), length[r].tolist(), period[r].tolist()))
        s, n, q = min(mine, key=lambda x: (-x[1], x[0], x[2])) if mine else (None, None, None)
        kept = " ".join([distinct[w] for w in word[o:e][keep[o:e]].tolist()])
        for k, v in zip(out, (len(mine), s, n, q, 1000 * n // q if mine else None,
                              hashlib.sha256("".join(f"{x},{y},{z}\n" for x, y, z in mine).encode()).hexdigest(),
                              hashlib.sha256(kept.encode()).hexdigest())):
            out[k].append(v)
    kinds = {k: pa.string() if k.endswith("sha256") else pa.int64() for k in out}
    return common.batch_of(doc_id=b.column("doc_id"), **{k: pa.array(v, kinds[k]) for k, v in out.items()})


def periodic_runs(docs: DataFrame, plant: bool = True) -> DataFrame:
    """Number of runs, the longest run, and hashes of all runs and of the text without
    repeated periods, for each row of ``docs`` (doc_id, text). ``plant``: make the words
    of every tenth document periodic first, as the query's contract asks."""
    return common.map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                           lambda b: digests(b, plant), SCHEMA)
