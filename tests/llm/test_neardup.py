"""Near-duplicate classes against all pairs."""

import numpy as np
import pyarrow as pa
from conftest import SF_SMALL

from meterwise.llm import neardup as N


def brute(rows, threshold=N.SIMILARITY):
    """class id of each row by verified similarity of all pairs."""
    offs, h, tf, per = N.shingles(pa.array([t for _, t in rows], pa.string()))
    idf = N.Idf.of(*np.unique(h, return_counts=True), max(int((per > 0).sum()), 1))
    w = N._weights(h, tf, idf)
    docs = [(h[a:b], w[a:b]) for a, b in zip(offs[:-1], offs[1:])]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = {}
    for i, (hashes, _) in enumerate(docs):
        for x in hashes.tolist():
            where.setdefault(x, []).append(i)
    pairs = {(a, b) for l in where.values() for k, a in enumerate(l) for b in l[k + 1:]}
    for a, b in pairs:
        if N.similarity(docs[a], docs[b]) >= threshold:
            parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return [(d, least[find(i)]) for i, (d, _) in enumerate(rows)], idf


def test_query_equals_brute_force(spark):
    from meterwise.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in QUERIES["op4_near_duplicates"](spark, SF_SMALL).collect()}
    assert got == dict(brute(rows)[0]) and len(set(got.values())) < len(got)


def _variants(rng, n, words=200, edits=4):
    """Near copies of one text in which a few words are replaced, and of another of which a third is shared."""
    base = [f"w{x}" for x in rng.integers(0, 5000, words)]
    out = []
    for _ in range(n):
        t = list(base)
        for k in rng.integers(0, words, edits):
            t[k] = f"x{rng.integers(1 << 30)}"
        out.append(" ".join(t))
    return out


def test_large_group_of_near_copies_and_shared_passages(spark):
    rng = np.random.default_rng(3)
    texts = _variants(rng, 60, edits=2)
    shared = " ".join(f"p{x}" for x in range(80))
    texts += [shared + " " + " ".join(f"u{x}" for x in rng.integers(0, 1 << 30, 80)) for _ in range(40)]
    texts += [texts[0]] * 20 + _variants(rng, 30, edits=5)
    rows = list(enumerate(texts))
    want, _ = brute(rows)
    got = [(r.doc_id, r.class_id) for r in N.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(want)


def test_samples_agree_with_the_weighted_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    b = np.concatenate([a[:220], rng.integers(0, 1 << 62, 80).astype(np.uint64)])
    h, w = [], []
    for x in (a, b):
        x = np.sort(x)
        h.append(x)
        w.append((1 + (x % np.uint64(7)).astype(np.float32)))
    w[1][::3] *= 2  # the same shingle may weigh differently
    sim = N.similarity((h[0], w[0]), (h[1], w[1]))
    sig = N.signatures(np.array([0, 300, 600]), np.concatenate(h), np.concatenate(w), 3000)
    assert abs((sig[0] == sig[1]).mean() - sim) < 0.04


def test_edges(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None), (2, ""), (3, " \n "), (4, text), (5, text.upper()), (6, text + " "), (7, "short one"), (8, "Short  one"), (9, "one short"),
            (10, "long " * 60000), (4, text), (None, text), (11, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, class_id int")
    got = [(r.doc_id, r.class_id, r.class_size) for r in N.classes(df).collect()]
    assert len(got) == len(rows)
    assert got.count((4, 4, 5)) == 2 and (5, 4, 5) in got and (6, 4, 5) in got and (None, 4, 5) in got
    assert {(7, 7, 2), (8, 7, 2), (9, 9, 1), (10, 10, 1), (1, 1, 1), (2, 2, 1), (3, 3, 1), (11, 11, 1)} <= set(got)
    assert N.classes(df.where("false")).collect() == []
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect() if r.text and len(r.text) < 100 and r.text.strip()) == [0, 7, 9]
    assert kept.where(r"text is null or text rlike '^\\s*$'").count() == 4


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(1, 30)] + [(100, 200 + k) for k in range(50)] + [(900, 800)]
    got = {r.key: r.root for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 1 for k in range(1, 31)) and all(got[200 + k] == 100 for k in range(50)) and got[900] == got[800] == 800


def test_classes_in_one_bucket_come_apart(spark):
    """Three groups that share every band value."""
    rng = np.random.default_rng(9)
    texts = [t for _ in range(3) for t in _variants(rng, 4, words=120, edits=1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, idf = brute(list(enumerate(texts)))
    rows = N.sketch(docs, idf).collect()
    members = spark.createDataFrame([(r.key, [7] * N.BANDS, r.doc_id) for r in rows], "key long, bands array<long>, rep long")
    found = N.links(members, docs, idf)
    roots = {r.key: r.root for r in N.components(found.selectExpr("member AS a", "leader AS b")).collect()}
    of = {r.doc_id: roots[r.key] for r in rows}
    assert [len({of[k] for k in range(g, g + 4)}) for g in (0, 4, 8)] == [1, 1, 1] and len(set(of.values())) == 3


def test_links_in_a_crowded_bucket_are_all_found(spark):
    """Pairs of near copies among many other members of one large bucket."""
    rng = np.random.default_rng(4)
    texts = [t for _ in range(60) for t in _variants(rng, 2, words=120, edits=1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, idf = brute(list(enumerate(texts)))
    keys = {r.doc_id: r.key for r in N.sketch(docs, idf).collect()}
    members = spark.createDataFrame([(k, [7, *(k + b for b in range(1, N.BANDS))], d) for d, k in keys.items()], "key long, bands array<long>, rep long")
    found = {frozenset((r.member, r.leader)) for r in N.links(members, docs, idf).collect()}
    assert found == {frozenset((keys[d], keys[d + 1])) for d in range(0, len(texts), 2)}


def test_frequencies_are_those_of_the_shingles(spark):
    """Every shingle in two documents and more has its own exact df; with a bound, the frequent ones have."""
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    _, h, _, per = N.shingles(pa.array(texts, pa.string()))
    hashes, df = np.unique(h, return_counts=True)
    n = int((per > 0).sum())
    one = np.ones(len(hashes), np.float32)
    got = N.document_frequencies(docs)
    assert np.array_equal(N._weights(hashes, one, got), N._weights(hashes, one, N.Idf.of(hashes, df, n))) and len(got.hashes) == (df > 1).sum()
    few = N.document_frequencies(docs, bound=2000)
    assert 0 < len(few.hashes) <= 2000
    assert np.isin(hashes[df > 2.2 * len(h) / 2000], few.hashes).all()
    own = np.isin(hashes, few.hashes)
    assert np.array_equal(N._weights(hashes, one, few)[own], N._weights(hashes, one, N.Idf.of(hashes, df, n))[own])
    none = N.document_frequencies(docs.where("false"))
    assert len(none.hashes) == 0 and np.isfinite(none.rest)


def test_summary_errs_by_no_more_than_it_says():
    rng = np.random.default_rng(2)
    held, n, lost = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    seen = []
    for _ in range(30):
        h = (rng.pareto(0.7, 3000) * 10).astype(np.uint64)
        seen.append(h)
        held, n, cut = N._summary(np.concatenate([held, h]), np.concatenate([n, np.ones(len(h), np.int64)]), 200)
        lost += cut
        assert len(held) <= 200
    hashes, count = np.unique(np.concatenate(seen), return_counts=True)
    got = dict(zip(held.tolist(), n.tolist()))
    assert lost <= len(np.concatenate(seen)) / 200
    assert all(c - lost <= got.get(x, 0) <= c for x, c in zip(hashes.tolist(), count.tolist()))


def test_roots_of_links_that_cross(spark):
    links = [(1, 10), (2, 10), (3, 10), (3, 20), (4, 20), (20, 30), (5, 40), (40, 50), (6, 60)]
    root = {r.key: r.root for r in N.roots_of(spark.createDataFrame(links, "member long, leader long")).collect()}
    groups = {}
    for k, r in root.items():
        groups.setdefault(r, set()).add(k)
    assert sorted(map(sorted, groups.values())) == [[1, 2, 3, 4, 10, 20, 30], [5, 40, 50], [6, 60]]


def test_survivor_does_not_depend_on_files(spark):
    text = " ".join(f"w{k}" for k in range(80))
    rows = [(9, text), (4, text + " more"), (7, text), (4, text), (None, None), (12, "other words that stand alone here")]
    kept = [sorted(map(tuple, N.keep_one(spark.createDataFrame(r, "doc_id long, text string").repartition(p)).collect()), key=str)
            for r, p in ((rows, 1), (rows[::-1], 3))]
    assert kept[0] == kept[1] and len(kept[0]) == 3 and any(r[0] == 4 for r in kept[0])


def test_links_know_the_frequency_of_every_shingle(spark):
    """A passage in most texts makes them similar only while its shingles count as rare."""
    rng = np.random.default_rng(8)
    passage = " ".join(f"p{x}" for x in range(120))
    texts = [passage + " " + " ".join(f"u{x}" for x in rng.integers(0, 1 << 40, 11)) for _ in range(40)]
    texts += _variants(rng, 3, words=120, edits=1)
    texts += [" ".join(f"v{x}" for x in rng.integers(0, 1 << 40, 60)) + " end of every other text here" for _ in range(17)]
    rows = list(enumerate(texts))
    want, exact = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = N.document_frequencies(docs, bound=2)
    assert len(few.hashes) <= 2 < len(exact.hashes) and few.least < 1
    for bound in (2, N.FREQUENT):
        got = [(r.doc_id, r.class_id) for r in N.classes(docs, bound=bound).collect()]
        assert sorted(got) == sorted(want)
    assert len({c for _, c in want[:40]}) == 40


def test_counting_hands_few_rows_on(spark):
    docs = spark.createDataFrame([(f"a{k} b c d e f g h {k}",) for k in range(400)], "text string").repartition(40)
    counts, n = N.shingle_counts(docs)
    assert n == 400 and {r.n for r in counts.collect()} == {400} and counts.count() == 3


def test_joins_get_few_rows_besides_those_they_look_up(spark, monkeypatch):
    """Of the texts and of all shingles' frequencies, those in question."""
    rng = np.random.default_rng(11)
    passage = " ".join(f"p{x}" for x in range(120))
    texts = [passage + " " + " ".join(f"u{x}" for x in rng.integers(0, 1 << 40, 14)) for _ in range(10)]  # similar enough or not, by the frequencies
    rows = list(enumerate(texts + [" ".join(f"v{x}" for x in rng.integers(0, 1 << 40, 12)) for _ in range(1500)] * 2))
    seen = []
    real = N.common.sieve
    monkeypatch.setattr(N.common, "sieve", lambda r, keys, col, **k: seen.append((col, r.count(), real(r, keys, col, **k).count())) or real(r, keys, col, **k))
    got = [(r.doc_id, r.class_id) for r in N.classes(spark.createDataFrame(rows, "doc_id long, text string"), bound=2).collect()]
    assert sorted(got) == sorted(brute(rows)[0])
    assert [s for s in seen if s[0] == "rep"] and all(n == len(rows) and passed < 0.1 * n for col, n, passed in seen if col == "rep")
    assert [s for s in seen if s[0] == "shingle"] and all(passed < 0.2 * n for col, n, passed in seen if col == "shingle")
