"""Quality classifier learned from positive and unlabelled text.

Trusted positives are training documents labelled 1; unlabelled web text are
training documents without a label. Labels 0 are not used. Each text becomes a
few dense measures (shape, symbols, case, repetition). The share of positives
in the unlabelled text (class prior) is estimated from a first classifier of
positives against unlabelled text: over its score thresholds, the least ratio
of unlabelled to positive tail mass, with a confidence margin. Then a small
network minimises the non-negative unbiased risk
    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)).

The fit uses about ``SAMPLE`` positives and ``SAMPLE`` unlabelled documents (the
bound documented in README), chosen by a hash of their id, one text (the least)
per id; every row of the corpus is scored, whole. Null and empty texts are scored as a text
of no words. With no positives or no unlabelled text every score is 0.5.
Several labels of one id count as their largest; a null label is none. Each row
is scored on its own; repeated rows and extra columns change nothing.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, common

SAMPLE = 20_000  # rows of each kind that the classifier is fitted on
HIDDEN, STEPS, RATE, SEED, DECAY = 16, 400, 0.02, 9, 1e-4
THRESHOLD = 0.3
MARKS = "!|$&%*#<>{}[]@/\\=_~^"  # fixed value: each is one measure
N_MEASURES = 19 + len(MARKS)


LOWER, UPPER, DIGIT, BLANK, STOP, REST, N_KINDS = 0, 1, 2, 3, 4, 5, 6 + len(MARKS)


@functools.cache
def kinds() -> np.ndarray:
    """Kind of every code point: one of the above, then one for each of MARKS."""
    cls = bpe.char_classes()
    out = np.select([cls == bpe.LETTER, cls == bpe.NUMBER, cls == bpe.SPACE], [LOWER, DIGIT, BLANK], REST).astype(np.int64)
    out[[c for c in range(0x250) if chr(c).isupper() and cls[c] == bpe.LETTER]] = UPPER
    out[[ord("."), ord(",")]] = STOP
    out[[ord(m) for m in MARKS]] = np.arange(6, N_KINDS)
    return out


def _repeats(offs: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct items, count of the most frequent item) of each segment."""
    n = len(offs) - 1
    doc = np.repeat(np.arange(n), np.diff(offs))
    wide = int(codes.max()) + 1 if len(codes) else 1
    seen = pa.array(doc * wide + codes).value_counts()
    of, count = seen.field(0).to_numpy() // wide, seen.field(1).to_numpy()
    most = np.zeros(n)
    np.maximum.at(most, of, count)
    return np.bincount(of, minlength=n).astype(np.float64), most


def measures(texts: pa.Array) -> np.ndarray:
    """(texts, N_MEASURES) of numbers of about unit scale."""
    t = pa.concat_arrays([common.text_bytes(texts)])
    n = len(t)
    joined = "".join(t.to_pylist())
    cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    size_of = pc.utf8_length(t).to_numpy(zero_copy_only=False).astype(np.int64)
    kind = kinds()[cp]
    doc = np.repeat(np.arange(n, dtype=np.int64) * N_KINDS, size_of)
    count = np.bincount(doc + kind, minlength=n * N_KINDS).reshape(n, N_KINDS).astype(np.float64)
    twice = np.flatnonzero((cp[1:] == cp[:-1]) & (kind[1:] != BLANK)) + 1
    same = np.bincount(doc[twice] // N_KINDS, minlength=n).astype(np.float64)
    chars = size_of.astype(np.float64)
    per = np.maximum(chars, 1)
    upper = count[:, UPPER]
    letters = upper + count[:, LOWER]
    marks = count[:, N_KINDS - len(MARKS):]
    other = count[:, REST] + count[:, STOP] + marks.sum(axis=1)
    woffs, codes, uniq = common.words(t, "utf8")
    nwords = np.diff(woffs).astype(np.float64)
    wper = np.maximum(nwords, 1)
    wsize = np.array([len(w) for w in uniq], np.float64)
    plain = np.array([w.strip(".,;:!?\"'()").isalpha() for w in uniq], np.float64)
    wl, wp = (wsize[codes], plain[codes]) if len(uniq) else (np.zeros(0), np.zeros(0))
    distinct, top = _repeats(woffs, codes)
    lines = pc.split_pattern(t, "\n")
    loffs = np.concatenate([[0], np.cumsum(pc.list_value_length(lines).to_numpy())]).astype(np.int64)
    lcodes = lines.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    nlines = np.maximum(np.diff(loffs).astype(np.float64), 1)
    ldist, ltop = _repeats(loffs, lcodes)
    cols = [
        np.log1p(chars) / 5, np.log1p(nwords) / 4, letters / per, upper / np.maximum(letters, 1),
        count[:, DIGIT] / per, other / per, count[:, BLANK] / per,
        common.segment_sum(wl, woffs) / wper / 10, common.segment_sum((wl <= 3) * 1.0, woffs) / wper,
        common.segment_sum((wl >= 20) * 1.0, woffs) / wper, common.segment_sum(wp, woffs) / wper,
        distinct / wper, top / wper, np.log1p(nlines) / 4, 1 - ldist / nlines, ltop / nlines,
        same / per, count[:, STOP] / wper, (nwords < 20) * 1.0,
    ]
    return np.concatenate([np.stack(cols, axis=1), np.sqrt(marks / wper[:, None])], axis=1).astype(np.float32)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.mean) / self.scale).clip(-8, 8) @ self.w1 + self.b1)
        return 1 / (1 + np.exp(-(h @ self.w2 + self.b2).astype(np.float64)))


def _train(p: np.ndarray, u: np.ndarray, prior: float | None) -> tuple:
    """Weights of a one-hidden-layer network. ``prior`` None: ordinary logistic
    loss of p against u; else the non-negative unbiased risk."""
    rng = np.random.default_rng(SEED)
    d = p.shape[1]
    params = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params]
    x = np.concatenate([p, u]).astype(np.float64)
    np_, nu = len(p), len(u)
    for step in range(1, STEPS + 1):
        h = np.tanh(x @ params[0] + params[1])
        f = np.clip(h @ params[2] + params[3], -30, 30)
        s = 1 / (1 + np.exp(-f))
        g = np.zeros_like(f)  # gradient of the risk by f; loss+ = log(1+e^-f), loss- = log(1+e^f)
        if prior is None:
            g[:np_], g[np_:] = (s[:np_] - 1) / np_ / 2, s[np_:] / nu / 2
        else:
            minus = np.logaddexp(0, f)
            rest = minus[np_:].mean() - prior * minus[:np_].mean()
            sign = 1.0 if rest >= 0 else -1.0  # a negative rest is over-fitting: climb back
            g[:np_] = (prior * (s[:np_] - 1) if sign > 0 else 0) / np_ - sign * prior * s[:np_] / np_
            g[np_:] = sign * s[np_:] / nu
        dh = g[:, None] * params[2] * (1 - h * h)
        grads = [x.T @ dh + DECAY * params[0], dh.sum(0), h.T @ g + DECAY * params[2], np.array([g.sum()])]
        for k, gr in enumerate(grads):
            m[k] += 0.1 * (gr - m[k])
            v[k] += 0.001 * (gr * gr - v[k])
            params[k] = params[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return params


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives in u: least ratio of upper tails of the scores."""
    cuts = np.quantile(p, np.linspace(0.02, 0.9, 89))
    tail_p = np.maximum((p[:, None] >= cuts).mean(0), 1e-9)
    tail_u = (u[:, None] >= cuts).mean(0)
    margin = np.sqrt(np.log(4 / 0.1) / 2) * (len(p) ** -0.5 + len(u) ** -0.5)
    best = np.argmin((tail_u + margin) / tail_p)
    return float(np.clip(tail_u[best] / tail_p[best], 0.05, 0.98))


def fit(p: np.ndarray, u: np.ndarray) -> Model | None:
    if not len(p) or not len(u):
        return None
    both = np.concatenate([p, u])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    zp, zu = ((p - mean) / scale).clip(-8, 8), ((u - mean) / scale).clip(-8, 8)
    fold = [np.arange(len(z)) % 2 == 0 for z in (zp, zu)]
    shares = []
    for side in (True, False):  # each half is judged by what the other half taught
        (ap, bp), (au, bu) = ((z[f == side], z[f != side]) for z, f in zip((zp, zu), fold))
        if min(len(ap), len(bp), len(au), len(bu)):
            first = _train(ap, au, None)
            f = lambda z, w=first: np.tanh(z @ w[0] + w[1]) @ w[2] + w[3]
            shares.append(estimate_prior(f(bp), f(bu)))
    prior = float(np.mean(shares)) if shares else 0.5
    w1, b1, w2, b2 = _train(zp, zu, prior)
    return Model(mean, scale, w1.astype(np.float32), b1.astype(np.float32), w2.astype(np.float32), float(b2[0]), prior)


def _sample(docs: DataFrame, ids: DataFrame, bound: int) -> np.ndarray:
    """Measures of about ``bound`` of the documents whose id is among ``ids``."""
    few = common.store(common.hash_sample(ids, bound, 9), "sample")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        x = measures(b.column("text"))
        return common.batch_of(doc_id=b.column("doc_id"), x=pa.array(list(x), pa.list_(pa.float32())))
    one = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    got = sorted(common.map_text(one, run, "doc_id long, x array<float>").collect())
    return np.array([r["x"] for r in got], np.float32).reshape(len(got), N_MEASURES)


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model | None:
    """Fit on ``docs`` (doc_id, text; training rows only) and ``labels`` (doc_id, label)."""
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull())
    known = labels.where(F.col("label").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    pos = ids.join(known.where("label = 1"), "doc_id", "left_semi")
    unl = ids.join(known, "doc_id", "left_anti")
    return fit(_sample(docs, pos, bound), _sample(docs, unl, bound))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (doc_id, held_out, text) with score and predicted."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        s = model.score(measures(b.column("text"))) if model else np.full(b.num_rows, 0.5)
        return common.batch_of(doc_id=b.column("doc_id"), held_out=b.column("held_out"), score=pa.array(s, pa.float64()),
                               predicted=pa.array((s >= THRESHOLD).astype(np.int32), pa.int32()))
    return common.map_text(docs, run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, all columns, that score ``threshold`` or more."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        s = model.score(measures(b.column("text"))) if model else np.full(b.num_rows, 0.5)
        return b.filter(pa.array(s >= threshold))
    return common.map_text(docs, run, docs.schema)
