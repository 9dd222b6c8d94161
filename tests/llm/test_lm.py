"""Language model scores: counts, probabilities and state."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from meterwise.llm import lm

SF = "/root/testdata/sf0.01"


def _tokens(text):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0D]+", low) + [None]


def test_query_counts_and_base_score(spark):
    from meterwise.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    c = Counter(t for i, x in docs.items() if zlib.crc32(str(i).encode()) % 7 != 2 for t in _tokens(x))
    n, v = sum(c.values()), len(c)
    got = QUERIES["op6_language_model"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        t = _tokens(docs[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[x] > 0 for x in t), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), rel_tol=1e-9)
        assert r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_tail_words_meet_their_counts(spark, monkeypatch):
    """With a tiny head the join gives the same as the head alone."""
    docs = spark.createDataFrame([(k, False, f"a b c{k % 7} d{k % 3} a x{k}") for k in range(40)] + [(90, True, "a zz zz"), (91, True, None), (91, True, ""), (None, True, "a")],
                                 "doc_id long, held_out boolean, text string")
    train = docs.where("not held_out").select("doc_id", "text")
    monkeypatch.setattr(lm, "VOCABULARY", 3)
    whole = sorted(map(tuple, lm.score(docs, train).collect()), key=str)
    monkeypatch.setattr(lm, "HEAD", 5)
    split = sorted(map(tuple, lm.score(docs, train).collect()), key=str)
    for a, b in zip(whole, split):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-5)
    empty = [r for r in whole if r[0] == 91]
    assert len(empty) == 2 and all(r[2] == 1 and r[3] == 1 for r in empty)
    none = lm.score(docs, train.where("false")).collect()
    assert len(none) == 44 and all(r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in none)
    assert lm.score(docs.where("false"), train).count() == 0


@pytest.fixture(scope="module")
def net():
    counts = np.array([50, 30, 20, 10, 5, 5, 3, 2, 2, 1], float)
    net, _ = lm.build(counts, 12.0)
    rng = np.random.default_rng(0)
    for a in (net.wc, net.ww):
        a += rng.normal(0, 0.3, a.shape).astype(np.float32)
    return net


def test_probabilities_sum_to_one(net):
    h = np.random.default_rng(1).normal(size=(4, lm.HIDDEN)).astype(np.float32)
    n = len(net.cls)
    p = np.stack([np.exp(net.log_probs(h, np.full(4, w))) for w in range(n)])
    assert np.allclose(p.sum(axis=0), 1, atol=1e-4)


def test_untrained_network_is_the_unigram():
    counts = np.array([8.0, 4, 2, 1])
    net, order = lm.build(counts, 5.0)
    got = np.exp(net.log_probs(np.zeros((5, lm.HIDDEN), np.float32), np.arange(5)))
    want = np.append(counts[order] + 1, 6) / 24 * 24 / (counts.sum() + 4 + 6)
    assert np.allclose(got, want, atol=1e-4)


def test_gradients(net):
    rng = np.random.default_rng(2)
    n = len(net.cls)
    words, targets = rng.integers(0, n, (5, 3)), rng.integers(0, n, (5, 3))
    fresh, mask = np.zeros((5, 3), bool), rng.random((5, 3)) < 0.9
    fresh[0] = True
    fresh[3, 1] = True
    h0 = np.zeros((3, lm.HIDDEN))
    wide = lm.Net(net.cls, net.first, *(a.astype(np.float64) for a in net.weights()))
    _, grads, _ = wide.gradients(words, targets, fresh, mask, h0)
    for k, g in enumerate(grads):
        for at in rng.integers(0, g.size, 6):
            w = [a.copy() for a in wide.weights()]
            side = []
            for d in (1e-5, -1e-5):
                x = [a.copy() for a in w]
                x[k].ravel()[at] += d
                side.append(lm.Net(net.cls, net.first, *x).gradients(words, targets, fresh, mask, h0)[0])
            assert abs((side[0] - side[1]) / 2e-5 - g.ravel()[at]) < 1e-5


def test_state_is_carried_through_whole_texts(net):
    rng = np.random.default_rng(3)
    n = len(net.cls)
    sizes = [1, 700, 3, 150, 64, 65, 128, 2]
    ids = rng.integers(0, n, sum(sizes))
    offs = np.concatenate([[0], np.cumsum(sizes)])
    got = lm.score_texts(net, 2, offs, ids)
    for k in range(len(sizes)):
        h, total, before = np.zeros((1, lm.HIDDEN), np.float32), 0.0, 2
        for w in ids[offs[k]:offs[k + 1]]:
            h = net.step(np.array([before]), h)[0]
            total += float(net.log_probs(h, np.array([w]))[0])
            before = w
        assert math.isclose(got[k], total / math.log(10), rel_tol=1e-4)


def test_training_lowers_the_loss():
    net, order = lm.build(np.array([10.0, 10, 10, 10]), 1.0)
    cycle = np.tile(np.argsort(order)[[0, 1, 2, 3]], 15000)
    offs = np.arange(0, len(cycle) + 1, 100)
    before = lm.score_texts(net, 3, offs, cycle).sum()
    after = lm.score_texts(lm.train_shard(net, 3, offs, cycle, 200), 3, offs, cycle).sum()
    assert after > 0.5 * before


def test_tokens():
    offs, codes, uniq = lm.tokens(pa.array(["A b\x0bB", None, " ", "É a"], pa.string()))
    words = uniq.to_pylist()
    got = [[words[c] for c in codes[a:b]] for a, b in zip(offs, offs[1:])]
    assert got == [["a", "b", "b", ""], [""], [""], ["É", "a", ""]]


def test_every_training_text_is_learned_from(spark, monkeypatch):
    """All rows, repeated and null ids too, are in a group of a round; groups follow the rows; weights are the mean by tokens."""
    monkeypatch.setattr(lm, "GROUP_BYTES", 400)
    rows = [(k, f"a b{k % 5} c x{k}") for k in range(4000)] + [(7, "a b"), (7, "a b"), (None, "a"), (8, None)]
    train = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    dealt, n = lm._groups(train)
    got = dealt.groupBy("turn", "shard").count().collect()
    assert sum(r["count"] for r in got) == len(rows) and n > 50 and max(r["count"] for r in got) < 100
    seen = []
    real = lm._tree_sum
    monkeypatch.setattr(lm, "_tree_sum", lambda r: seen.append(real(r)) or seen[-1])
    net, vocab = lm.fit(train, ["a", "c", lm.END], np.array([4000.0, 4000, 4004]), 8000.0)
    assert sum(k for k, _ in seen) == sum(len(_tokens(t)) for _, t in rows)
    assert np.allclose(np.concatenate([a.ravel() for a in net.weights()]), seen[-1][1] / seen[-1][0], atol=1e-6)


def test_weights_are_summed_in_a_tree(spark):
    rows = spark.createDataFrame([(k, bytearray(np.array([k, 1.0]).tobytes())) for k in range(200)], "n long, w binary").repartition(90)
    n, w = lm._tree_sum(rows)
    assert n == 19900 and w.tolist() == [19900.0, 200.0]


def test_windows_hold_every_token_once():
    """Lanes that have ended leave the windows; a lane's texts follow each other in order."""
    rng = np.random.default_rng(4)
    size = np.append(rng.integers(1, 40, 60), 900)
    offs = np.concatenate([[0], np.cumsum(size)])
    dealt = lm.lanes(offs, 16)
    seen, starts, width = [[] for _ in dealt], [], []
    for at, fresh in lm.windows(offs, dealt, 8):
        width.append(at.shape[1])
        starts += at[fresh].tolist()
        for k in range(at.shape[1]):
            seen[k] += at[:, k][at[:, k] >= 0].tolist()
    assert [x for lane in seen for x in lane] == [x for lane in dealt for d in lane for x in range(offs[d], offs[d + 1])]
    assert sorted(starts) == offs[:-1].tolist() and width[0] == 16 and width[-1] == 1
    assert list(lm.windows(np.array([0]), [], 8)) == []


def test_groups_do_not_follow_file_splits(spark):
    rows = [(k % 300, f"a b{k % 7}") for k in range(900)] + [(1, "x")] * 50 + [(None, "a"), (3, None)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    deal = lambda df: sorted(map(str, lm._groups(df)[0].collect()))
    assert deal(train.repartition(2)) == deal(train.repartition(7, "text")) and len(deal(train)) == len(rows)


def test_score_follows_the_chain_rule(spark, monkeypatch):
    """The whole query against a plain pass over each text with the fitted network."""
    kept = []
    real = lm.fit
    monkeypatch.setattr(lm, "VOCABULARY", 12)
    monkeypatch.setattr(lm, "fit", lambda *a: kept.append(real(*a)) or kept[-1])
    docs = spark.createDataFrame([(k, k % 3 == 0, f"a b c{k % 5} d{k % 3} a x{k}") for k in range(60)] + [(70, True, "zz a q zz")], "doc_id long, held_out boolean, text string")
    train = docs.where("not held_out").select("doc_id", "text")
    got = {r.doc_id: r for r in lm.score(docs, train).collect()}
    (net, vocab), = kept
    c = Counter(t for r in train.collect() for t in _tokens(r.text))
    own = [w or None for w in vocab]
    rare_c, rare_v = sum(n for w, n in c.items() if w not in own), sum(w not in own for w in c)
    end = own.index(None)
    for r in docs.collect():
        h, total, before = np.zeros((1, lm.HIDDEN), np.float32), 0.0, end
        for w in _tokens(r.text):
            k = own.index(w) if w in own else len(own)
            h = net.step(np.array([before]), h)[0]
            total += float(net.log_probs(h, np.array([k]))[0]) / math.log(10)
            if k == len(own):
                total += math.log10((c[w] + 1) / (rare_c + rare_v + 1))
            before = k
        assert math.isclose(got[r.doc_id].score, total, rel_tol=1e-4)


def test_a_long_text_is_learned_to_its_end():
    net, order = lm.build(np.array([10.0, 10, 10, 10]), 1.0)
    start = np.full(8000, int(np.argsort(order)[0]))
    ids = np.concatenate([start, np.tile(np.argsort(order)[[1, 2]], 4000)])
    offs = np.array([0, len(ids)])
    after = lm.train_shard(net, 3, offs, ids)
    cut = lm.train_shard(net, 3, np.array([0, 6400]), ids[:6400])  # the first 400 windows of one lane
    end = np.tile(np.argsort(order)[[1, 2]], 50)
    assert lm.score_texts(after, 3, np.array([0, 100]), end)[0] > 0.5 * lm.score_texts(cut, 3, np.array([0, 100]), end)[0]


def test_a_group_is_cut_into_words_a_slice_at_a_time(monkeypatch):
    """The same network words as of the whole group; little memory besides them."""
    import tracemalloc
    rng = np.random.default_rng(5)
    texts = [" ".join(f"W{x}" for x in rng.integers(0, 60000, 400)) for _ in range(1500)] + [None, "", " "]
    vocab = [f"w{k}" for k in range(300)] + [lm.END]
    offs, codes, uniq = lm.tokens(pa.array(texts, pa.string()))
    want = lm.network_ids(uniq, vocab)[codes]
    column = pa.chunked_array([pa.array(texts[:700], pa.string()), pa.array(texts[700:], pa.string())])
    monkeypatch.setattr(lm, "TOKEN_BYTES", 1 << 18)
    used = pa.total_allocated_bytes()
    tracemalloc.start()
    got_offs, ids = lm.group_ids(column, vocab)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got_offs, offs) and np.array_equal(ids, want) and ids.itemsize == 4
    assert peak < 3 * ids.nbytes + (6 << 20) and pa.total_allocated_bytes() - used < 1 << 20
    none_offs, none = lm.group_ids(pa.chunked_array([], pa.string()), vocab)
    assert none_offs.tolist() == [0] and len(none) == 0


def _plain_log_probs(net, h, target):
    """Class and word within the class, each softmax in double precision."""
    h, out = h.astype(float), []
    for state, w in zip(h, target):
        c = net.cls[w]
        a, z = net.first[c], net.first[c + 1]
        outer, inner = state @ net.wc + net.bc, state @ net.ww[a:z].T + net.bw[a:z]
        out.append(outer[c] - np.logaddexp.reduce(outer) + inner[w - a] - np.logaddexp.reduce(inner))
    return np.array(out)


@pytest.mark.parametrize("scale", [1.0, 200.0])
def test_blocks_of_classes_give_every_row_its_probability(net, monkeypatch, scale):
    """Also with logits whose powers leave float32, and in blocks smaller than a class's rows."""
    monkeypatch.setattr(lm, "BLOCK", 7)
    rng = np.random.default_rng(6)
    wide = lm.Net(net.cls, net.first, *net.weights()[:3], net.wc * np.float32(scale), net.bc, net.ww * np.float32(scale), net.bw)
    h = rng.uniform(-1, 1, (300, lm.HIDDEN)).astype(np.float32)
    target = rng.integers(0, len(net.cls), 300)
    assert np.allclose(wide.log_probs(h, target), _plain_log_probs(wide, h, target), rtol=1e-4, atol=1e-3)


def test_no_step_is_taken_without_clipping_where_a_logit_could_pass_60(net):
    run = lm.Pass(net)
    run.find_room()
    room = run.room
    assert room > 0 and run.bound() + room * lm.RATE * (lm.HIDDEN + 1) < 60
    run.w[0, 0] = 3
    run.find_room()
    assert run.room == 0


def test_few_lanes_take_long_windows():
    """One long text among short ones: the tokens are all there, the windows few."""
    size = np.array([3] * 40 + [20000])
    offs = np.concatenate([[0], np.cumsum(size)])
    seen = [at for at, _ in lm.windows(offs, lm.lanes(offs, lm.LANES), 32, 32 * lm.LANES)]
    assert sorted(x for at in seen for x in at[at >= 0].tolist()) == list(range(offs[-1])) and len(seen) < 10


def test_training_windows_use_their_arrays_again(monkeypatch):
    """After the first windows a window leaves no more arrays behind, and asks for few new ones."""
    import tracemalloc
    counts = 1e6 / np.arange(10, 4010)
    net, _ = lm.build(counts, 5000.0)
    rng = np.random.default_rng(8)
    offs = np.arange(0, 16 * lm.TRAIN_LANES * 8 + 1, 128)
    ids = rng.choice(4000, offs[-1], p=counts / counts.sum())
    peaks = []
    real = lm.Pass.gradients

    def gradients(self, *a):
        tracemalloc.start()
        out = real(self, *a)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        return out
    monkeypatch.setattr(lm.Pass, "gradients", gradients)
    lm.train_shard(net, 0, offs, ids)
    assert len(peaks) == 8 and np.median(peaks) < 3 << 20 < peaks[0]


def test_words_are_cut_alike_with_and_without_codes():
    texts = pa.array(["A b\x0bB", None, " ", "\u00c9 a", "  x  y "], pa.string())
    from meterwise.llm import common
    offs, flat = common.split_words(texts)
    at, codes, words = common.words(texts)
    assert offs.tolist() == at.tolist() == [0, 3, 3, 3, 5, 7] and flat.to_pylist() == [words[c] for c in codes]
