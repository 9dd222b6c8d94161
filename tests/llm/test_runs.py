"""Periodic runs against a comparison of all words at all lags."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL

from meterwise.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def _random_words(rng):
    kind = rng.randrange(4)
    if kind == 0:
        return [rng.randrange(2) for _ in range(rng.randrange(60))]
    if kind == 1:
        return sum((([rng.randrange(3) for _ in range(rng.randrange(1, 20))] * rng.randrange(1, 8))[:rng.randrange(1, 150)]
                    for _ in range(rng.randrange(1, 5))), [])
    if kind == 2:
        return sum((([rng.randrange(2) for _ in range(rng.randrange(1, 4))] * rng.randrange(1, 12) + [9] * rng.randrange(3)) * rng.randrange(1, 6)
                    for _ in range(rng.randrange(1, 4))), [])
    a, b = [0], [0, 1]  # Fibonacci words have the most runs
    for _ in range(rng.randrange(3, 10)):
        a, b = b, b + a
    return b[:rng.randrange(1, len(b) + 1)]


@pytest.mark.parametrize("meetings", [1 << 20, 50, 7])
def test_runs_equal_brute_force(meetings, monkeypatch):
    monkeypatch.setattr(runs, "MEETINGS", meetings)  # blocks of many, some and few words
    rng = random.Random(meetings)
    docs = [_random_words(rng) for _ in range(800)]
    offs = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    start, length, period = runs.find(offs, np.array(sum(docs, []), np.int64))
    of = np.searchsorted(offs, start, "right") - 1
    got = [[] for _ in docs]
    for d, s, n, q in zip(of.tolist(), start.tolist(), length.tolist(), period.tolist()):
        got[d].append((s - int(offs[d]), n, q))
    for d, g in zip(docs, got):
        assert g == brute_runs(d), d


@pytest.mark.parametrize("words, want", [
    ([7] * 200_000, [(0, 200_000, 1)]),
    (list(range(100)) * 2000, [(0, 200_000, 100)]),
    ([1] * 7 + [2] + ([1] * 7 + [2]) * 20_000, [(0, 160_008, 8)]),
    ([1] * 3000 + [2] + [1] * 3000, [(0, 3000, 1), (3001, 3000, 1)]),
    (list(range(50_000)) * 2, [(0, 100_000, 50_000)]),
])
def test_long_documents(words, want):
    found = runs.find(np.array([0, len(words)]), np.array(words, np.int64))
    assert list(zip(*(x.tolist() for x in found))) == want


def test_awkward_rows(spark):
    hit = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:12]  # these are made periodic
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", "x " * 11, "x " * 12, "x x " * 13, "ab cd " * 6 + "ab", "a b " * 6 + "z " + "a b " * 6,
             " ".join(f"w{i}" for i in range(300)), "é É é É " * 5, "w " * 3000]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(i, t, "x") for i, t in zip(hit, texts)]
    rows += [(5, "x " * 12, "again"), (None, " ".join(map(str, range(40))), None)]
    got = runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, start string")).collect()
    assert Counter(map(tuple, got)) == Counter(brute_row(i, t) for i, t, _ in rows)
    assert runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_unplanted_texts_stay_as_they_are(spark):
    hit = next(i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0)
    docs = spark.createDataFrame([(hit, " ".join(map(str, range(90))))], "doc_id long, text string")
    assert runs.periodic_runs(docs, plant=False).first().n_runs == 0 and runs.periodic_runs(docs).first().n_runs == 1


def test_query_on_documents(spark):
    from meterwise.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op12_periodic_runs"](spark, SF_SMALL).collect()
    short = {i: t for i, t in docs.items() if len(t) < 20_000}  # brute force is quadratic
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    for r in got:
        if r.doc_id in short:
            assert tuple(r) == brute_row(r.doc_id, short[r.doc_id])
