"""Log-likelihood of texts under a gated recurrent language model in numpy.

Tokens are the words between ASCII white space, A-Z lowered, then one end per
text. All training texts are counted (Spark aggregation over every word); the
``VOCABULARY`` most frequent words and the end are the network's own words, all
others its one rare word. A gated recurrent unit predicts, from the whole text
so far, first the class of the next token, then the word within the class
(classes hold about equal probability mass, so frequent words share small
ones); a rare token is the rare class times its smoothed share of the rare
counts, unseen words being one type. The probabilities of all tokens thus sum
to one.

Training: truncated backpropagation over windows of ``WINDOW`` tokens, many texts
side by side in lanes, with the state carried from window to window (texts over
``SEGMENT`` tokens in pieces). Every training text belongs to one of the
``ROUNDS`` rounds and there to one Spark group of about ``GROUP_BYTES`` of text, so
their number follows the training rows; the groups' weights are averaged after
each round, task by task and then in a tree. Scoring carries the state through
whole texts: texts follow each other in lanes, all lanes advance together, and a
lane that has ended costs nothing.

Counts of up to ``HEAD`` most frequent words travel with the tasks; rarer words'
counts meet their texts in a join on the word, so no vocabulary is held whole
by a task. Null text counts as empty: one end token. With no training texts
every token has base probability 1 / 1 and the untrained network's score. Each
row has a key of its own, so repeated rows are scored each; extra columns are
ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.operators.joins import split_by_keys

from . import common

END = ""  # the end token among the counted words; no word is empty
HEAD = 100_000
VOCABULARY, CLASSES, HIDDEN = 8000, 96, 32
ROUNDS = 2
GROUP_BYTES = 8 << 20  # training text of a group in a round
TOKEN_BYTES = 1 << 20  # of it that is cut into words at once
WINDOW, TRAIN_LANES = 16, 256
SEGMENT = 2048  # tokens of a training text learned as one lane's piece
FAN_IN = 16  # weight rows averaged by a task of the tree; the driver gets one
RATE, SEED = 0.05, 6
LANES, SCORE_WINDOW = 256, 32  # texts scored side by side, by so many tokens at once
SCORE_BYTES = 16 << 20  # of texts dealt to these lanes at once: a long one goes on while others do
JOIN_WORDS = 1 << 18  # counted words, about, that a task of the join holds
BLOCK = 1024  # rows of output worked on at once, or half as many logits


def with_ends(offs: np.ndarray, codes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, codes) with the code ``end`` after every text."""
    at = offs + np.arange(len(offs))
    out = np.full(len(codes) + len(offs) - 1, end, codes.dtype)
    keep = np.ones(len(out), bool)
    keep[at[1:] - 1] = False
    out[keep] = codes
    return at, out


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, distinct words) with every text's end token."""
    offs, flat = common.split_words(texts)
    enc = flat.dictionary_encode()
    return *with_ends(offs, enc.indices.to_numpy(), len(enc.dictionary)), pa.concat_arrays([enc.dictionary, pa.array([END], pa.string())])


def word_counts(train: DataFrame) -> DataFrame:
    """``word, c`` over all texts of ``train``."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        _, flat = common.split_words(b.column("text"))
        got = flat.value_counts()
        return common.batch_of(word=pa.concat_arrays([got.field(0), pa.array([END], pa.string())]), n=pa.concat_arrays([got.field(1), pa.array([b.num_rows], pa.int64())]))
    part = common.map_text(train.select("text"), run, "word string, n long", SCORE_BYTES)
    return part.groupBy("word").agg(F.sum("n").alias("c"))


# -- network ---------------------------------------------------------------------


@dataclass
class Net:
    """Weights; words 0..n-1 by class, n is the rare word (its class the last)."""

    cls: np.ndarray  # class of each word, rare included
    first: np.ndarray  # first word of each class, then the number of words
    e: np.ndarray  # (words, HIDDEN) a word as input
    x: np.ndarray  # (HIDDEN, 3 * HIDDEN) from the input to the gates: update, reset, new
    u: np.ndarray  # (HIDDEN, 3 * HIDDEN) from the state to the gates
    wc: np.ndarray
    bc: np.ndarray
    ww: np.ndarray  # (words, HIDDEN)
    bw: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.e, self.x, self.u, self.wc, self.bc, self.ww, self.bw]

    def step(self, word: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        k = HIDDEN
        gx, gh = self.e[word] @ self.x, h @ self.u
        zr = 1 / (1 + np.exp(-(gx[:, :2 * k] + gh[:, :2 * k])))
        z, r = zr[:, :k], zr[:, k:]
        new = np.tanh(gx[:, 2 * k:] + r * gh[:, 2 * k:])
        return new + z * (h - new), z, r, new, gh[:, 2 * k:]

    def log_probs(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target after its state."""
        run, out = Pass(self), np.empty(len(h), h.dtype)
        order = np.argsort(run.key[target], kind="stable")
        state = np.column_stack([h, np.ones(len(h), h.dtype)])
        out[order] = run.log_probs(state[order], target[order])
        return out

    def gradients(self, words: np.ndarray, targets: np.ndarray, fresh: np.ndarray, mask: np.ndarray, h: np.ndarray) -> tuple[float, list[np.ndarray], np.ndarray]:
        """One window (steps, lanes): (loss, gradients, last state)."""
        shares, n, seen, (e, x, u, c, w), h = Pass(self).gradients(words, targets, fresh, mask, h)
        ge = np.zeros_like(self.e)
        ge[seen] = e
        return -np.log(np.concatenate(shares) + 1e-30).sum() / n, [g / n for g in (ge, x, u, c[:-1], c[-1], w[:, :-1], w[:, -1])], h


class Space:
    """Arrays used again from window to window, as fresh ones cost page faults: a name's
    array holds until the name is next asked for."""

    def __init__(self, dtype: np.dtype) -> None:
        self.dtype, self.kept = dtype, {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        n = math.prod(shape)
        if name not in self.kept or self.kept[name].size < n:
            self.kept[name] = np.empty(n, self.dtype)
        return self.kept[name][:n].reshape(shape)


class Pass:
    """A copy of a network's weights and what its windows are computed in. The output
    biases lie beside the weights, so a state's last component is 1. The recurrent part
    has lanes in the last axis, so that each gate is one block; the outputs of
    many classes lie in one flat array, so that only products go class by class, and
    what is worked on at once stays in a core's cache."""

    def __init__(self, net: Net) -> None:
        self.cls, self.first = net.cls, net.first.tolist()
        self.e, self.x, self.u = net.e.copy(), net.x.copy(), net.u.copy()
        self.c, self.w = np.vstack([net.wc, net.bc]), np.column_stack([net.ww, net.bw])
        # order of words that puts those alone in their class first; the others stay by class
        many = np.diff(net.first)[net.cls] > 1
        small = np.min_scalar_type(2 * len(many))  # sorts by radix
        self.word, self.key = np.arange(len(many)).astype(small), (np.arange(len(many)) + len(many) * many).astype(small)
        self.most, self.room = self.bound(), 0  # no logit is larger; steps of training for which none can pass 60
        self.space = Space(net.e.dtype)

    def net(self) -> Net:
        return Net(self.cls, np.array(self.first), self.e, self.x, self.u, self.c[:-1], self.c[-1], self.w[:, :-1], self.w[:, -1])

    def bound(self) -> float:
        """What no logit passes, as no state leaves -1 to 1."""
        return max(HIDDEN * float(np.abs(a).max(initial=0)) + float(np.abs(b).max(initial=0)) for a, b in ((self.c[:-1], self.c[-1]), (self.w[:, :-1], self.w[:, -1])))

    def find_room(self) -> None:
        """A step of training moves no weight by more than ``RATE``."""
        most = self.bound()
        self.room = max(0, int((59 - most) / (RATE * (HIDDEN + 1)))) if math.isfinite(most) else 0

    def forward(self, words: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """(inputs, states before, gates update and reset and the state's share of the new,
        new, states after), by step; ``h`` and states are (HIDDEN, lanes)."""
        k, (steps, n), space = HIDDEN, words.shape, self.space
        e = np.take(self.e, words, axis=0, out=space("e", steps, n, k), mode="clip")
        sign = np.repeat(np.array([-1, 1], e.dtype), [2 * k, k])[:, None]  # 1 / (1 + exp(-gate))
        into, u = self.x.T * sign, self.u.T * sign
        x = np.matmul(into, e.transpose(0, 2, 1), out=space("x", steps, 3 * k, n))
        before, gates, after = space("before", steps, k, n), space("gates", steps, 3 * k, n), space("after", steps, k, n)
        keep = (~fresh[:, None, :]).astype(e.dtype)
        side = space("side", k, n)
        for t in range(steps):
            np.multiply(h, keep[t], out=before[t])
            g = np.matmul(u, before[t], out=gates[t])
            zr, new = g[:2 * k], x[t, 2 * k:]
            zr += x[t, :2 * k]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            new += np.multiply(zr[k:], g[2 * k:], out=side)
            np.tanh(new, out=new)
            h = np.subtract(before[t], new, out=after[t])
            h *= zr[:k]
            h += new
        return e, before, gates, x[:, 2 * k:], after

    def states(self, after: np.ndarray, at: np.ndarray) -> np.ndarray:
        """States after the steps and lanes ``at``, one row each, and 1."""
        steps, k, n = after.shape
        flat = self.space("flat", steps, n, k + 1)
        flat[:, :, :k] = after.transpose(0, 2, 1)
        flat[:, :, k] = 1
        return np.take(flat.reshape(-1, k + 1), at, axis=0, out=self.space("state", len(at), k + 1), mode="clip")

    def outer(self, state: np.ndarray, of: np.ndarray) -> Iterator[tuple]:
        """Logits of the classes, ``BLOCK`` rows at a time: (rows, flat logits, each row's start, its class's place)."""
        wide = self.c.shape[1]
        for i in range(0, len(state), BLOCK):
            at = slice(i, min(i + BLOCK, len(state)))
            p = np.matmul(state[at], self.c, out=self.space("p", at.stop - i, wide)).reshape(-1)
            place = np.arange(at.stop - i) * wide
            yield at, p, place, place + of[at]

    def inner(self, state: np.ndarray, target: np.ndarray) -> Iterator[tuple]:
        """Logits within the classes of several words, some classes at a time, for rows in order of ``key`` of
        ``target``: (rows, flat logits, each row's start, its target's place, (rows of these, words, logits) of each class)."""
        cut = np.searchsorted(self.key[target], np.array(self.first) + len(self.key)).tolist()
        todo, total = [], 0
        for i, j, a, z in zip(cut, cut[1:], self.first, self.first[1:]):
            if j > i:
                todo.append((i, j, a, z))
                total += (j - i) * (z - a)
            if total and (total >= BLOCK * CLASSES // 2 or z == self.first[-1]):
                q, o, parts, at = self.space("p", total), 0, [], todo[0][0]
                for i, j, a, z in todo:
                    part = q[o:o + (j - i) * (z - a)].reshape(j - i, z - a)
                    parts.append((slice(i - at, j - at), slice(a, z), np.matmul(state[i:j], self.w[a:z].T, out=part)))
                    o += part.size
                i, j, a, z = (np.array(x) for x in zip(*todo))
                size = np.repeat(z - a, j - i)
                start = np.cumsum(size) - size
                yield slice(at, todo[-1][1]), q, start, start + target[at:todo[-1][1]] - np.repeat(a, j - i), parts
                todo, total = [], 0

    def log_probs(self, state: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target after its state; rows in order of ``key`` of ``target``."""
        out = np.empty(len(state), state.dtype)
        for at, logits, start, hit in self.outer(state, self.cls[target]):
            out[at] = log_shares(logits, start, hit, self.most)
        for rows, logits, start, hit, _ in self.inner(state, target):
            out[rows] += log_shares(logits, start, hit, self.most)
        return out

    def gradients(self, words: np.ndarray, targets: np.ndarray, fresh: np.ndarray, mask: np.ndarray, h: np.ndarray) -> tuple:
        """One window (steps, lanes): (probabilities of classes and of words in them, tokens, input words,
        gradients of these words' inputs and of the other weights, last state), gradients summed over tokens."""
        k, (steps, n), space = HIDDEN, words.shape, self.space
        e, before, gates, new, after = self.forward(words, fresh, h.T)
        # output, tokens ordered by class
        live = np.flatnonzero(mask.ravel())
        live = live[np.argsort(self.key[targets.ravel()[live]], kind="stable")]
        target, state = targets.ravel()[live], self.states(after, live)
        m, shares = len(live), [np.zeros(0)]
        gc, gs, gw = np.zeros_like(self.c), space("gs", m, k), space("gw", *self.w.shape)
        for at, p, start, hit in self.outer(state, self.cls[target]):
            share, inverse = less_hits(p, start, hit, self.room < 1)
            shares.append(share)
            p = p.reshape(len(start), -1)
            gc += np.multiply(state[at], inverse, out=space("weighed", len(start), k + 1)).T @ p
            np.matmul(p, self.c[:k].T, out=gs[at])
            gs[at] *= inverse
        gw[:] = 0
        for rows, q, start, hit, parts in self.inner(state, target):
            share, inverse = less_hits(q, start, hit, self.room < 1)
            shares.append(share)
            back = space("back", len(start), k)
            weighed = np.multiply(state[rows], inverse, out=space("weighed", len(start), k + 1))
            for at, own, part in parts:
                np.matmul(part.T, weighed[at], out=gw[own])
                np.matmul(part, self.w[own, :k], out=back[at])
            back *= inverse
            gs[rows] += back
        flat = space("gh", steps * n, k)
        if m < steps * n:
            flat[:] = 0
        flat[live] = gs
        gh = space("flat", steps, k, n)
        gh[:] = flat.reshape(steps, n, k).transpose(0, 2, 1)
        # back through the window: what of a step's gradient does not depend on later steps, then step by step
        z, r, hn = gates[:, :k], gates[:, k:2 * k], gates[:, 2 * k:]
        to_new, to_z, to_r, side = (space(name, steps, k, n) for name in ("to_new", "to_z", "to_r", "gh"))
        np.subtract(1, z, out=side)
        np.multiply(new, new, out=to_new)
        np.subtract(1, to_new, out=to_new)
        to_new *= side
        side *= z
        np.subtract(before, new, out=to_z)
        to_z *= side
        np.subtract(1, r, out=to_r)
        to_r *= r
        to_r *= hn
        d = space("d", steps, 4 * k, n)  # the state's new, update, reset, the input's new
        u = np.concatenate([self.u[:, 2 * k:], self.u[:, :2 * k]], axis=1)
        keep = (~fresh[:, None, :]).astype(e.dtype)
        carry = space("side", k, n)
        carry[:] = 0
        for t in range(steps - 1, -1, -1):
            g, dt = gh[t], d[t]
            g += carry
            dnew = np.multiply(g, to_new[t], out=dt[3 * k:])
            np.multiply(dnew, r[t], out=dt[:k])
            np.multiply(g, to_z[t], out=dt[k:2 * k])
            np.multiply(dnew, to_r[t], out=dt[2 * k:3 * k])
            np.matmul(u, dt[:3 * k], out=carry)
            g *= z[t]
            carry += g
            carry *= keep[t]
        gu = np.matmul(d[:, :3 * k], before.transpose(0, 2, 1)).sum(axis=0).T
        at_x = d[:, k:].transpose(0, 2, 1)
        gx = np.matmul(e.transpose(0, 2, 1), at_x).sum(axis=0)
        ge = np.matmul(at_x, self.x.T, out=space("gh", steps, n, k)).reshape(-1, k)
        order = np.argsort(self.word[words.ravel()], kind="stable")
        word = words.ravel()[order]
        start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        ge = np.take(ge, order, axis=0, out=space("flat", len(order), k), mode="clip").view(np.result_type(ge, np.complex64))
        ge = np.add.reduceat(ge, start, axis=0).view(e.dtype)  # as complex numbers, two sums at a time
        return shares, max(m, 1), word[start], [ge, gx, np.concatenate([gu[:, k:], gu[:, :k]], axis=1), gc, gw], after[-1].T


def segment_sums(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sum of each segment of a flat array."""
    if len(start) < 2 or len(x) == len(start) * start[1] and (np.diff(start) == start[1]).all():
        x = x.reshape(len(start), -1)
        return x @ np.ones(x.shape[1], x.dtype)
    return np.add.reduceat(x, start)


def log_shares(logits: np.ndarray, start: np.ndarray, hit: np.ndarray, most: float) -> np.ndarray:
    """Log of the share of ``hit`` in each segment of a flat array of at most ``most``, which is lost."""
    if not most <= 80:  # exp and sums would leave float32
        logits -= np.repeat(np.maximum.reduceat(logits, start), np.diff(start, append=len(logits)))
    out = logits[hit]
    np.exp(logits, out=logits)
    return out - np.log(segment_sums(logits, start))


def less_hits(logits: np.ndarray, start: np.ndarray, hit: np.ndarray, clip: bool) -> tuple[np.ndarray, np.ndarray]:
    """In place of a flat array of logits, their gradients times each segment's sum of powers:
    (shares of the hits, 1 / those sums as a column). Training only: logits beyond 60 count as 60, where ``clip``."""
    if clip:
        np.clip(logits, -60, 60, out=logits)
    np.exp(logits, out=logits)
    total = segment_sums(logits, start)
    own = logits[hit]
    logits[hit] = own - total
    inverse = 1 / total
    return own * inverse, inverse[:, None]


def build(counts: np.ndarray, rare: float) -> tuple[Net, np.ndarray]:
    """(untrained network whose outputs are the unigram shares, order of the
    words by class) for counts of the network's words and of the rare one."""
    order = np.argsort(-counts, kind="stable")
    share = (counts[order] + 1.0) / (counts.sum() + len(counts))
    cls = np.minimum((np.cumsum(share) - share / 2) * CLASSES, CLASSES - 1).astype(np.int64)
    _, cls = np.unique(cls, return_inverse=True)
    n = len(order)
    cls = np.append(cls, cls[-1] + 1 if n else 0)
    first = np.searchsorted(cls, np.arange(cls[-1] + 2))
    mass = np.append(counts[order] + 1.0, rare + 1.0)
    per = np.add.reduceat(mass, first[:-1])
    rng = np.random.default_rng(SEED)
    f = np.float32
    net = Net(cls, first, rng.normal(0, 0.3, (n + 1, HIDDEN)).astype(f), *(rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 3 * HIDDEN)).astype(f) for _ in range(2)),
              np.zeros((HIDDEN, len(per)), f), np.log(per / per.sum()).astype(f), np.zeros((n + 1, HIDDEN), f), np.log(mass).astype(f))
    return net, order


def lanes(offs: np.ndarray, n_lanes: int) -> list[list[int]]:
    """Texts dealt to lanes of about equal length; the longest lane first."""
    size = np.diff(offs)
    heap = [(0, k) for k in range(min(n_lanes, len(size)))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-size, kind="stable").tolist():
        total, k = heapq.heappop(heap)
        out[k].append(d)
        heapq.heappush(heap, (total + int(size[d]), k))
    return [out[k] for _, k in sorted(heap, reverse=True)]


def windows(offs: np.ndarray, dealt: list[list[int]], length: int, tokens: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each window of ``length`` steps, or more where few lanes go on, up to ``tokens``, (positions,
    whether a text starts there), both (steps, lanes) and of the lanes that still go on; position -1 beyond a lane's end."""
    size = np.diff(offs)
    order = np.array([d for lane in dealt for d in lane], np.int64)
    ends = np.cumsum(size[order])
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offs[:-1][order] - (ends - size[order]), size[order])
    total = np.array([int(size[lane].sum()) for lane in dealt], np.int64)
    begin = np.cumsum(total) - total
    starts = np.zeros(len(place), bool)
    starts[ends - size[order]] = True
    t, last = 0, int(total.max(initial=0))
    while t < last:
        n = int((total > t).sum())  # lanes lie by falling length
        step = np.arange(t, min(t + max(length, tokens // n), last))[:, None]
        t += len(step)
        if total[n - 1] >= t:  # no lane ends within
            at = begin[:n] + step
            yield place[at], starts[at]
            continue
        live = step < total[:n]
        at = np.where(live, begin[:n] + step, 0)
        yield np.where(live, place[at], -1), live & starts[at]


def words_before(end: int, offs: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The word before each; ``end`` where a text starts."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[offs[:-1]] = end
    return out


def train_shard(net: Net, end: int, offs: np.ndarray, ids: np.ndarray, most: int | None = None) -> Net:
    """Truncated backpropagation with Adagrad over all windows of a group's texts, or the
    first ``most``. Texts over ``SEGMENT`` tokens are learned in segments side by
    side, each with a state of its own, so that one long text does not leave the lanes empty."""
    size = np.diff(offs)
    parts = -(-size // SEGMENT)
    first = np.cumsum(parts) - parts
    cuts = np.append(np.repeat(offs[:-1], parts) + (np.arange(int(parts.sum())) - np.repeat(first, parts)) * SEGMENT, offs[-1])
    last = words_before(end, offs, ids)
    run = Pass(Net(net.cls, net.first, *(a.astype(np.float32) for a in net.weights())))
    w = [run.e, run.x, run.u, run.c, run.w]
    v = [np.full_like(a, 1e-8) for a in w]
    h = np.zeros((0, HIDDEN), np.float32)
    for done, (at, fresh) in enumerate(windows(cuts, lanes(cuts, TRAIN_LANES), WINDOW)):
        if done == most:
            break
        h = h[:at.shape[1]] if done else np.zeros((at.shape[1], HIDDEN), np.float32)
        before = last[at]
        if run.room < 1:
            run.find_room()
        _, n, touched, grads, h = run.gradients(before, ids[at], fresh, at >= 0, h)
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in grads)) / n
        scale = np.float32(min(1.0, 1.0 / (norm + 1e-9)) / n)
        for k, g in enumerate(grads):
            if k == 0:
                v_k, w_k = v[0][touched], w[0][touched]
                adagrad(w_k, v_k, g, scale)
                v[0][touched], w[0][touched] = v_k, w_k
            else:
                for i in range(0, len(g), BLOCK):
                    adagrad(w[k][i:i + BLOCK], v[k][i:i + BLOCK], g[i:i + BLOCK], scale)
        run.room -= 1
    return run.net()


def adagrad(w: np.ndarray, v: np.ndarray, g: np.ndarray, scale: np.float32) -> None:
    """One step of weights and their sums of squares, in place; ``g`` is lost."""
    g *= scale
    root = g * g
    v += root
    np.sqrt(v, out=root)
    g /= root
    g *= np.float32(RATE)
    w -= g


def score_texts(net: Net, end: int, offs: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Log10 probability of each text's network words, state carried throughout."""
    total = np.zeros(len(offs) - 1)
    if not len(ids):
        return total
    run, last = Pass(net), words_before(end, offs, ids)
    h = np.zeros((HIDDEN, LANES), np.float32)
    per_token = np.zeros(len(ids))
    for a, f in windows(offs, lanes(offs, LANES), SCORE_WINDOW, LANES * SCORE_WINDOW):
        *_, after = run.forward(last[a], f, h[:, :a.shape[1]])  # lanes lie by falling length
        h = after[-1]
        at = a.ravel()
        live = np.flatnonzero(at >= 0)
        live = live[np.argsort(run.key[ids[at[live]]], kind="stable")]
        at = at[live]
        per_token[at] = run.log_probs(run.states(after, live), ids[at])
    return common.segment_sum(per_token, offs) / np.log(10)


# -- whole operator --------------------------------------------------------------


def _groups(train: DataFrame) -> tuple[DataFrame, int]:
    """(every row of ``train`` as text, turn, shard; groups of a round). A row's group
    follows from its id, text and number among its copies, not from file splits."""
    size = train.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("n")).first()["n"] or 0
    n = max(1, -(-size // (ROUNDS * GROUP_BYTES)))
    keyed = train.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), F.xxhash64("text").alias("hash"))
    repeated = keyed.groupBy("key", "hash").count().where("count > 1")
    once, again = split_by_keys(keyed, repeated, ["key", "hash"])
    copies = again.groupBy("doc_id", "text").agg(F.count("*").alias("n"))
    rows = once.select("doc_id", "text", F.lit(1).cast("long").alias("copy")).union(
        copies.select("doc_id", "text", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")))
    return rows.select("text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)).alias("turn"),
                       F.pmod(F.xxhash64("copy", "doc_id", "text"), F.lit(n)).alias("shard")), n


def _shard_step(net: Net, vocab: list[str], end: int):
    """Trains ``net`` on a group; gives its tokens and weights times these."""
    def run(group: pa.Table) -> pa.Table:
        offs, ids = group_ids(group.sort_by("text").column("text"), vocab)
        common.give_back()
        got = train_shard(net, end, offs, ids)
        w = np.concatenate([a.ravel() for a in got.weights()]).astype("<f8") * len(ids)
        common.give_back()
        return pa.table({"n": pa.array([len(ids)], pa.int64()), "w": pa.array([w.tobytes()], pa.binary())})
    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of a task's rows (n, w), one row."""
    n, total = 0, None
    for b in batches:
        for k, w in zip(b.column("n").to_pylist(), b.column("w")):
            n += k
            w = np.frombuffer(w.as_buffer(), "<f8")
            total = w.copy() if total is None else total + w
    if total is not None:
        yield common.batch_of(n=pa.array([n], pa.int64()), w=pa.array([total.tobytes()], pa.binary()))


def _tree_sum(rows: DataFrame) -> tuple[int, np.ndarray | None]:
    """Sum of all ``rows`` (n, w); the driver gets one of them."""
    rows.sparkSession.conf.set(common.ARROW_BATCH_CONF, str(common.ARROW_BATCH_BYTES))
    rows = common.store(rows.mapInArrow(_sums, "n long, w binary"), "weights")
    while (n := rows.count()) > 1:
        rows = common.store(rows.repartition(-(-n // FAN_IN)).mapInArrow(_sums, "n long, w binary"), "weights")
    got = rows.first()
    return (got["n"], np.frombuffer(got["w"], "<f8")) if got else (0, None)


def fit(train: DataFrame, vocab: list[str], counts: np.ndarray, rare: float) -> tuple[Net, list[str]]:
    """(trained network, its words in order); ``vocab`` holds END."""
    net, order = build(counts, rare)
    vocab = [vocab[k] for k in order]
    end = vocab.index(END)
    rows, _ = _groups(train)
    for turn in range(ROUNDS):
        part = rows.where(F.col("turn") == turn).select("shard", "text").groupBy("shard").applyInArrow(_shard_step(net, vocab, end), "n long, w binary")
        total, mean = _tree_sum(part)
        if not total:
            continue
        mean = (mean / total).astype(np.float32)
        w, at = [], 0
        for a in net.weights():
            w.append(mean[at:at + a.size].reshape(a.shape))
            at += a.size
        net = Net(net.cls, net.first, *w)
    return net, vocab


def network_ids(words: pa.Array, vocab: list[str] | pa.Array) -> np.ndarray:
    """Place of each word in ``vocab``; ``len(vocab)``, the rare one, if it is not there."""
    return pc.fill_null(pc.index_in(words, value_set=pa.array(vocab, pa.string())), len(vocab)).to_numpy(zero_copy_only=False)


def group_ids(texts: pa.ChunkedArray, vocab: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, network words) of a group's texts, cut into words a slice at a time."""
    sizes, ids, known = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)], pa.array(vocab, pa.string())
    end = vocab.index(END)
    for chunk in texts.chunks:
        for part in common.slices(common.batch_of(text=chunk), TOKEN_BYTES):
            offs, flat = common.split_words(part.column("text"))
            offs, got = with_ends(offs, network_ids(flat, known), end)
            ids.append(got)
            sizes.append(np.diff(offs))
    return np.cumsum(np.concatenate(sizes)), np.concatenate(ids)


def score(docs: DataFrame, train: DataFrame) -> DataFrame:
    """``docs`` (doc_id, held_out, text) scored by what ``train`` (doc_id, text) teaches."""
    counts = common.store(word_counts(train), "counts")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = total["n"] or 0, total["v"]
    top = common.most_frequent(counts, "c", HEAD).toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    words, c = top["word"].to_pylist(), top["c"].to_numpy().astype(np.float64)
    own = [k for k, w in enumerate(words) if w != END][:VOCABULARY]
    c_end = float(c[words.index(END)]) if END in words else 0.0
    own_c = np.append(c[own], c_end)
    rare_c, rare_v = n_all - own_c.sum(), v_all - len(own) - (c_end > 0)
    net, vocab = fit(train, [*(words[k] for k in own), END], own_c, rare_c)
    end = vocab.index(END)
    base, rare = np.log10(n_all + v_all + 1), np.log10(rare_c + rare_v + 1)

    # by place among the head words, then for all others: network word, what the scores add
    head, n_head = pa.array(words, pa.string()), len(words)
    end_at = words.index(END) if END in words else n_head
    log_c = np.log10(c + 1)
    of_head = np.append(network_ids(head, vocab), len(vocab))
    base_of = np.append(log_c - base, 0.0)
    rare_of = np.append(np.where(of_head[:-1] == len(vocab), log_c - rare, 0.0), 0.0)

    def cut(b: pa.RecordBatch) -> tuple:
        """(offsets, network words, known head words, their base, rare head words' share, beyond the head: words and times) of texts."""
        offs, flat = common.split_words(b.column("text"))
        at = network_ids(flat, head)
        tail = at == n_head
        enc = flat.filter(pa.array(tail)).dictionary_encode()
        uniq = pa.concat_arrays([enc.dictionary, pa.array([END], pa.string())])
        code = np.full(len(at), -1, np.int64)
        code[tail] = enc.indices.to_numpy()
        _, code = with_ends(offs, code, len(uniq) - 1 if end_at == n_head else -1)
        offs, at = with_ends(offs, at, end_at)
        ids = of_head[at]
        ids[offs[1:] - 1] = end
        # words beyond the head, each once per text
        n = b.num_rows
        tail = code >= 0
        pair = pa.array(np.repeat(np.arange(n), np.diff(offs))[tail] * len(uniq) + code[tail]).value_counts()
        of, times = pair.field(0).to_numpy(), pair.field(1).to_numpy()
        order = np.argsort(of, kind="stable")
        d, w = of[order] // len(uniq), of[order] % len(uniq)
        lists = pa.array(np.searchsorted(d, np.arange(n + 1)), pa.int32())
        return (np.diff(offs), ids, common.segment_sum(~tail, offs).astype(np.int64), common.segment_sum(base_of[at], offs), common.segment_sum(rare_of[at], offs),
                pa.ListArray.from_arrays(lists, uniq.take(pa.array(w))), pa.ListArray.from_arrays(lists, pa.array(times[order], pa.int64())))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        common.give_back()
        *columns, word, times = zip(*map(cut, common.slices(b)))
        size, ids, known, head_base, rares = map(np.concatenate, columns)
        model = score_texts(net, end, np.append(0, np.cumsum(size)), ids) + rares
        return common.batch_of(
            row=b.column("row"), doc_id=b.column("doc_id"), held_out=b.column("held_out"), n_tokens=pa.array(size, pa.int64()),
            known=pa.array(known), base=pa.array(head_base), model=pa.array(model), word=pa.concat_arrays(word), times=pa.concat_arrays(times))
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    part = common.store(common.map_text(keyed, run, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, word array<string>, times array<long>", SCORE_BYTES), "scores")
    tail = part.select("row", F.explode(F.arrays_zip("word", "times")).alias("t")).select("row", F.col("t.word").alias("word"), F.col("t.times").alias("times"))
    # at least so many parts that a part's counted words are few enough to be looked up in memory, with nothing sorted
    parts = max(1, -(-v_all // JOIN_WORDS))
    met = tail.repartition(parts, "word").join(counts.repartition(parts, "word").hint("shuffle_hash"), "word", "left")
    log_c = F.log10(F.coalesce("c", F.lit(0)) + 1)
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * (log_c - float(base))).alias("tail_base"), F.sum(F.col("times") * (log_c - float(rare))).alias("tail_model"))
    return (part.drop("word", "times").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.coalesce("tail_model", F.lit(0.0))).alias("score")))
