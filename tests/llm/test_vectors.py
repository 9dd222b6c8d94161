"""Nearest neighbours and top-k products against all pairs."""

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from meterwise.llm import ann, bitsliced, vectors

SF = "/root/testdata/sf0.1"


def _embeddings(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)


def _top(score, ids, own):
    at = np.flatnonzero(ids != own)
    return at[np.lexsort((ids[at], -score[at]))[:vectors.TOP]]


def test_neighbours_recall(spark):
    from meterwise.llm.queries import QUERIES
    ids, x = _embeddings(spark, SF)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = QUERIES["op1_prefix_forest"](spark, SF).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {int(i) for i in ids if i % 50 == 0}
    hit = 0
    for q, rows in by.items():
        score = unit @ unit[np.flatnonzero(ids == q)[0]]
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - score[np.flatnonzero(ids == r.vec_id)[0]]) < 1e-9 for r in rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        hit += len({r.vec_id for r in rows} & set(ids[_top(score, ids, q)].tolist()))
    assert hit / (5 * len(by)) >= 0.9


def test_descent_finds_the_longest_prefix():
    x = np.random.default_rng(0).normal(size=(300, 16))
    made = ann.build(np.arange(300), x)
    q = ann.strings(x[:5])
    for mask, k in zip(ann.candidates(made["tree"], made["rows"], q, wanted=1), range(5)):
        assert mask[k]  # its own string is the longest match
    for mask in ann.candidates(made["tree"], made["rows"], q, wanted=300 * ann.TREES):
        assert mask.all()


def test_products_are_exact(spark):
    from meterwise.llm.queries import QUERIES
    ids, x = _embeddings(spark, SF_SMALL)
    v = np.floor(256 * x).astype(np.int64)
    got = sorted(map(tuple, QUERIES["op7_bit_sliced_top_k"](spark, SF_SMALL).collect()))
    want = []
    for k in np.flatnonzero(ids % 50 == 0):
        s = v @ v[k]
        want += [(int(ids[k]), n + 1, int(ids[a]), int(s[a])) for n, a in enumerate(_top(s, ids, ids[k]))]
    assert got == sorted(want)


@pytest.mark.parametrize("q", [0, 1, -1, 7, -6, 255, 1000, -12345])
def test_signed_digits(q):
    digits = bitsliced.signed_digits(q)
    assert sum(d << k for k, d in digits) == q and all(abs(d) == 1 for _, d in digits)
    assert all(b - a > 1 for (a, _), (b, _) in zip(digits, digits[1:]))


def test_sliced_sums_and_selection():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 12))
    x[100:160] = x[99]  # ties
    made = bitsliced.build(np.arange(500), x)
    q = bitsliced.quantise(rng.normal(size=12))
    total = bitsliced.score_slices(q, made["places"], made["slices"], np.cumsum(made["places"]) - made["places"])
    bits = np.stack([np.unpackbits(s.view(np.uint8), bitorder="little")[:500] for s in total]).astype(np.int64)
    sums = (bits << np.arange(len(bits))[:, None]).sum(axis=0)
    want = made["v"] @ q
    assert (sums - sums[0] == want - want[0]).all()
    for k in (1, 5, 70, 500, 600):
        got = bitsliced.top_rows(total, bitsliced.bitmap(np.ones(500, bool)), k)
        assert sorted(got) == sorted(np.lexsort((np.arange(500), -want))[:k])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (100, None), (150, [nan, 1.0]), (200, [inf, 0.0]), (250, [None, 1.0]), (300, [0.0, 0.0]), (350, []),
            (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, -0.5]), (1, [1.0, 1.0]), (None, [1.0, 0.0]), (4, [1.0, 0.0, 0.0]), (400, [2.0, 0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    cos = {(r.query_id, r["rank"]): (r.vec_id, round(r.score, 6)) for r in ann.neighbours(df).collect()}
    assert [cos[0, k] for k in (1, 2, 3, 4)] == [(1, 0.707107), (2, 0.707107), (50, 0.0), (3, -0.894427)]
    assert cos[400, 1] == (4, 0.894427) and {q for q, _ in cos} == {0, 50, 400}
    top = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in bitsliced.top_products(df).collect()}
    assert [top[0, k] for k in (1, 2, 3, 4, 5)] == [(1, 65536), (2, 65536), (50, 0), (300, 0), (3, -65536)]
    assert {q for q, _ in top} == {0, 50, 300, 400}
    for empty in (df.where("false"), df.where("vec_id = 0"), df.where("vec_id = 3")):
        assert ann.neighbours(empty).collect() == [] and bitsliced.top_products(empty).collect() == []


def test_several_shards_and_query_blocks(spark, monkeypatch):
    """Best rows merged over many shards and blocks, ties and repeated vectors included."""
    for of in (ann, bitsliced):
        monkeypatch.setattr(of, "SHARD", 90)
        monkeypatch.setattr(of, "BLOCK", 4)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 8))
    x[300:340] = x[299]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    ids, v = np.arange(700), np.floor(256 * x).astype(np.int64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = sorted(map(tuple, bitsliced.top_products(df).collect()))
    assert got == [(q, n + 1, int(a), int(v[a] @ v[q])) for q in range(0, 700, 50) for n, a in enumerate(_top(v @ v[q], ids, q))]
    near = ann.neighbours(df).collect()
    hit = sum(r.score >= np.sort(np.delete(unit @ unit[r.query_id], r.query_id))[-vectors.TOP] - 1e-9 for r in near)
    assert len(near) == 14 * vectors.TOP and hit / len(near) >= 0.9


def test_large_components(spark):
    """Products beyond the slices' range stay exact; what no long holds raises."""
    big = 3.0e6
    rows = [(0, [big, -big, 1.0]), (1, [big, big, 0.5]), (2, [big, -big, 0.0]), (3, [-big, big, 2.0]), (4, [1.0, 0.0, 0.0])]
    v = [[int(256 * c) for c in x] for _, x in rows]
    want = sorted(((sum(a * b for a, b in zip(v[0], v[k])), k) for k in range(1, 5)), key=lambda t: (-t[0], t[1]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(bitsliced.top_products(df).collect(), key=lambda r: r["rank"])
    assert [(r.score, r.vec_id) for r in got] == want
    assert bitsliced.exact_best(np.arange(5), np.array(v), np.array(v[0]), 0, 5) == ([k for _, k in want], [s for s, _ in want])
    huge = bitsliced.quantise(np.array([[1e16, 1.0], [1e16, 2.0]]))
    with pytest.raises(OverflowError):
        bitsliced.exact_best(np.arange(2), huge, huge[0], 0, 5)
    with pytest.raises(OverflowError):
        bitsliced.quantise(np.array([4e16]))


def test_pairs_are_not_copied(spark):
    """No side is broadcast or shuffled once for each block of the other: either is quadratic
    in the input, and a broadcast passes the driver."""
    df = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(120)], "vec_id long, embedding array<double>")
    for top in (bitsliced.top_products, ann.neighbours):
        plan = top(df)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan
        below = plan[plan.index("MapInArrow"):]
        assert not any(k in below for k in ("Broadcast", "Exchange", "Generate"))


def test_shards_of_one_length_are_spread(spark):
    """Vectors of one length do not all meet in one task and file."""
    df = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(1000)], "vec_id long, embedding array<double>")
    made = vectors.blocks(vectors.valid(df), 50, bitsliced.build, "ids v places slices").withColumn("part", F.spark_partition_id()).collect()
    assert [(r.dim, r.shards) for r in made] == [(2, 20)] * 20 and len({r.part for r in made}) > 5
    assert sorted(np.concatenate([np.frombuffer(r.ids, np.int64) for r in made])) == list(range(1000))


def test_long_vectors_have_smaller_shards(spark, monkeypatch):
    monkeypatch.setattr(bitsliced, "VALUES", 1000)
    x = np.random.default_rng(4).normal(scale=300, size=(260, 40))
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())] + [(1000, [1.0]), (1001, [2.0])], "vec_id long, embedding array<double>")
    ids, v = np.arange(260), np.floor(256 * x).astype(np.int64)
    want = [(q, n + 1, int(a), int(v[a] @ v[q])) for q in range(0, 260, 50) for n, a in enumerate(_top(v @ v[q], ids, q))]
    assert sorted(map(tuple, bitsliced.top_products(df).collect())) == [*want, (1000, 1, 1001, 256 * 512)]


@pytest.mark.parametrize("most, kind", [(127, np.int8), (128, np.int16), (32768, np.int32), (1 << 31, np.int64)])
def test_narrow(most, kind):
    v = np.array([[most, -most, 0], [1, 2, 3]])
    made = bitsliced.narrow(v)
    assert made.dtype == kind and (bitsliced.vectors_of(made.tobytes(), 2, 3) == v).all()
    assert (bitsliced.narrow(-v - 1) == -v - 1).all()


def test_slices_at_all_places():
    """Factors and values of up to 29 bits, of both signs, in one adder for all queries."""
    rng = np.random.default_rng(6)
    x = rng.integers(-1 << 29, 1 << 29, (130, 5)) >> rng.integers(0, 29, (130, 5))
    made = bitsliced.build(np.arange(130), x / 256)
    first, adder = np.cumsum(made["places"]) - made["places"], bitsliced.Adder(made["slices"].shape[1])
    signed = np.concatenate([made["slices"], ~made["slices"]])
    for q in [np.zeros(5, int), *(rng.integers(-1 << 29, 1 << 29, (40, 5)) >> rng.integers(0, 29, (40, 5)))]:
        total = adder.add(signed, *bitsliced.terms(q, made["places"], first))
        sums = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(object) << k for k, s in enumerate(total)), np.zeros(130, object))
        want = (x.astype(object) * q.astype(object)).sum(axis=1)
        assert (sums - sums[0] == want - want[0]).all()
