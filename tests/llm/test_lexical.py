"""Ranked search against the score of every item and document."""

import math
import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from conftest import SF_SMALL

from meterwise.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def bag(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(items, docs, k=10):
    bags = [(i, b) for i, b in ((i, bag(t)) for i, t in docs) if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in sorted(set(items), key=str):
        scored = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * b[t] // (1000 * b[t] + 8 * m))
                        for t, times in bag(text).items() if t in b)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item_id, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return Counter(out)


def test_terms():
    texts = ["", None, "Ab1 cd-EF", "É_é\x7fx\x00y", "a", "b", "  ", "日本 x　y"]
    offs, found = lexical.terms(pa.array(texts, pa.string()))
    got = [[t.decode() for t in found[a:b].to_pylist()] for a, b in zip(offs, offs[1:])]
    assert got == [TERM.findall((t or "").translate(LOWER)) for t in texts]


@pytest.mark.parametrize("cells, coordinates, block", [(1 << 20, 1 << 10, 1 << 20), (64, 4, 150)])
def test_search_equals_brute_force(spark, monkeypatch, cells, coordinates, block):
    for name, value in (("CELLS", cells), ("COORDINATES", coordinates), ("ITEM_BYTES", block), ("FIRST", 2)):
        monkeypatch.setattr(lexical, name, value)  # small: many slices, rounds, collisions and blocks
    rng = random.Random(cells)
    word = [f"w{i}" for i in range(60)] + ["É", "dé", "X1"]
    weight = [1 / (i + 1) for i in range(len(word))]
    docs = [(i, " ".join(rng.choices(word, weight, k=rng.randrange(30)))) for i in range(300)]
    docs += [(7, "w3 w9 w3"), (7, "w3 w9 w3"), (None, "w59 w58"), (400, "w59 w58"), (401, None), (402, "- _"), (403, "w1 w2 " * 4000)]
    items = [(i, " ".join(rng.choices(word, k=rng.randrange(1, 12)))) for i in range(12)]
    items += [(3, items[3][1]), (3, "W59, w58; w58"), (20, None), (21, ""), (22, "nowhere"), (None, "w40 w41"), (23, "w1 " * 500 + "é É")]
    got = lexical.search(spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, rank int"),
                         spark.createDataFrame([(i, t, "y") for i, t in docs], "doc_id long, text string, item_id string").repartition(3)).collect()
    assert Counter(map(tuple, got)) == brute(items, docs)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    for i, d in ((items.limit(0), docs), (items, docs.limit(0)), (items, docs.where("text = 'x'")), (items.limit(0), docs.limit(0))):
        out = lexical.search(i, d)
        assert out.collect() == [] and out.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert lexical.search(items, docs, k=1).collect() == [] or lexical.search(items, docs, k=1).count() == 1


def test_wide_lengths_stay_exact():
    import numpy as np
    items = lexical.Items(["a"])
    big = lexical.Scorer(items, 10 ** 12, 10 ** 15, {0: 5})
    n = np.array([10 ** 7], np.int64)
    m = 25 + 75 * 10 ** 7 * 10 ** 12 // 10 ** 15
    zero, one = np.zeros(1, np.int64), np.ones(1, np.int64)
    assert big.impacts(n, zero, zero, one)[0] == big.weight[0] * (1000000000 // (1000 + 8 * m))


def test_query_equals_its_sql(spark):
    from meterwise.llm.queries import OP13_SQL, QUERIES
    got = QUERIES["op13_max_sketch_search"](spark, SF_SMALL)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(OP13_SQL)
    assert [c[0] for c in want.description] == got.columns
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())
