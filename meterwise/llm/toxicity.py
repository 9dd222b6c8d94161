"""Toxicity scores of text restored through a noisy channel.

A word is disguised if it holds a stand-in for a letter, a letter three times in a row, marks between its letters, or if it is spelled out
as three or more one-character words. Such a word spans a character lattice:
each character may be kept, stand for other letters, be one repetition too many
or be a mere mark, and between spelled-out letters a word may end. A Viterbi
search under a character trigram model of the corpus, plus the channel's costs,
picks the reading. A word without letters may also be read as itself, at a cost. A
word without any of these has a single reading, itself.

The classifier is fitted on about ``SAMPLE`` labelled training documents (the
bound documented in README), chosen by a hash of their id, one text (the least)
per id. It counts, for every restored word and its beginnings of 4 to 6 letters,
the documents of each label; a word's evidence is a lower bound of its log odds.
A logistic layer over a document's strongest evidence gives the score; it learns
from evidence that was counted on the other half of the sample. The character
model counts the words of the whole corpus.

Null and empty texts are scored as texts without words. With no labelled
training rows every score is 0. Several labels of one id count as their
largest; a null label is none. Texts are read whole; rows are scored on their
own, so repeated rows and extra columns change nothing.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

THRESHOLD = 0.3
SAMPLE = 20_000  # labelled documents that the classifier is fitted on
MOST_TRIGRAMS = 100_000  # most frequent character trigrams that are kept
MOST_FEATURES = 100_000  # strongest words and beginnings that are kept
STARTS = (4, 5, 6)  # lengths of beginnings
BEAM = 24
N_INPUTS = 6

# Letters that a character may stand for.
STANDS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
KEEP, STAND, REPEAT, MARK, BREAK = 0.0, 1.2, 0.4, 0.7, 0.5  # costs of the channel
NUMBER = 3.0  # cost a character of reading a word without letters as itself
EDGES = ".,;:?\"'`()[]{}<>…“”‘’«»¿-_*#%&=~^/\\"  # fixed value: never a letter at a word's ends
TRAIL = re.compile(r"(.)\1\1+$")  # marks after a word
MAYBE = "!|+"  # marks or letters at a word's end: the lattice tells
THRICE = re.compile(r"([^\W\d_])\1\1")
WORD_END = "\n"


def bare(word: str) -> str:
    """A lower-cased word without the marks around it."""
    w = word.strip(EDGES)
    while (m := TRAIL.search(w)) and not m[0][0].isalpha() and not m[0][0].isdigit() and m[0][0] not in STANDS:
        w = w[:m.start()].rstrip(EDGES)
    return w if w.strip(MAYBE) else ""


def disguised(word: str) -> bool:
    """Has the bare word more than one reading?"""
    if word.isalpha():
        return THRICE.search(word) is not None
    return sum(map(str.isalpha, word)) >= 2 or any(c in STANDS for c in word)


class CharModel:
    """Interpolated character trigram model over words."""

    def __init__(self, counts: dict[str, int]):
        tri, bi, uni = defaultdict(int), defaultdict(int), defaultdict(int)
        for t, n in counts.items():
            tri[t[:2]] += n
            bi[t[1:]] += n
            uni[t[2]] += n
        one = defaultdict(int)
        for t, n in bi.items():
            one[t[0]] += n
        total = sum(uni.values()) + 1
        self.floor = math.log(1e-6)
        self.uni = {c: 0.05 * n / total for c, n in uni.items()}
        self.bi = {t: 0.25 * n / one[t[0]] for t, n in bi.items()}
        self.tri = {t: 0.7 * n / tri[t[:2]] for t, n in counts.items()}
        self.memo: dict[str, float] = {}

    def log(self, t: str) -> float:
        got = self.memo.get(t)
        if got is None:
            p = self.tri.get(t, 0.0) + self.bi.get(t[1:], 0.0) + self.uni.get(t[2], 0.0)
            if len(self.memo) > 200_000:
                self.memo.clear()
            got = self.memo[t] = math.log(p) if p > 0 else self.floor
        return got

    def decode(self, chars: str, spelled: bool = False) -> str:
        """Most likely reading of a lattice; words of a spelled-out run are
        separated by spaces."""
        log = self.log
        beam: dict[str, tuple[float, tuple | None]] = {WORD_END * 2: (0.0, None)}
        last = ""
        for c in chars:
            ways: list[tuple[str, float]] = []
            if c.isalpha():
                ways.append((c, KEEP))
                if c == last:
                    ways.append(("", REPEAT))
            else:
                ways += [(x, STAND) for x in STANDS.get(c, "")]
                ways.append(("", MARK if not c.isdigit() else 4 * MARK))
                if c == last:
                    ways.append(("", REPEAT))
            last = c
            new: dict[str, tuple[float, tuple | None]] = {}
            for state, (cost, path) in beam.items():
                for x, price in ways:
                    if not x:
                        steps = [(state, cost + price, path)]
                    else:
                        steps = [(state[1] + x, cost + price - log(state + x), (x, path))]
                        if spelled and state[1] != WORD_END:
                            end = cost + BREAK - log(state + WORD_END) - log(WORD_END * 2 + x)
                            steps.append((WORD_END + x, end + price, (x, (" ", path))))
                    for s, total, way in steps:
                        if s not in new or total < new[s][0]:
                            new[s] = (total, way)
            beam = dict(sorted(new.items(), key=lambda kv: kv[1][0])[:BEAM])
        state, (cost, best) = min(beam.items(), key=lambda kv: kv[1][0] - log(kv[0] + WORD_END))
        if not spelled and cost - log(state + WORD_END) > NUMBER * len(chars) and not any(map(str.isalpha, chars)):
            return chars
        out = []
        while best:
            out.append(best[0])
            best = best[1]
        return "".join(reversed(out))


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """(offsets, codes, words, spelled): bare words per text; spelled-out runs are
    one word each and marked so."""
    offs, codes, uniq = common.words(texts, "utf8")
    clean: dict[str, int] = {}
    of = np.empty(len(uniq), np.int64)
    single = np.zeros(len(uniq), bool)
    for i, w in enumerate(uniq):
        b = bare(w) or (w if len(w) == 1 else "")
        single[i] = len(b) == 1 or len(w) == 1
        of[i] = clean.setdefault(b, len(clean))
    names = list(clean)
    n_docs = len(offs) - 1
    if not len(codes):
        return offs, codes, names, np.zeros(len(names), bool)
    flag = single[codes]
    out = of[codes]
    starts = np.zeros(len(codes) + 1, bool)
    starts[offs[:-1]] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.astype(np.int8), [0]])) != 0)
    runs: dict[str, int] = {}
    drop = np.zeros(len(codes), bool)
    for a, z in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if z - a < 3:
            continue
        inner = [a, *(np.flatnonzero(starts[a + 1:z]) + a + 1).tolist(), z]
        for x, y in zip(inner[:-1], inner[1:]):
            text = "".join(uniq[c] for c in codes[x:y])
            if y - x >= 3 and sum(map(str.isalpha, text)) + sum(c in STANDS for c in text) >= 3:
                out[x] = len(names) + runs.setdefault(text, len(runs))
                drop[x + 1:y] = True
    if drop.any():
        keep = ~drop
        offs = np.concatenate([[0], np.cumsum(keep)])[offs]
        out = out[keep]
    assert len(offs) == n_docs + 1
    return offs, out, names + list(runs), np.concatenate([np.zeros(len(names), bool), np.ones(len(runs), bool)])


def restore(names: list[str], spelled: np.ndarray, model: CharModel) -> list[str]:
    """The reading of each word; runs may read as several words."""
    return [model.decode(w, bool(s)) if s or disguised(w) else w for w, s in zip(names, spelled)]


def restore_text(text: str, model: CharModel) -> str:
    """A text with every word replaced by its reading."""
    _, codes, names, spelled = split(pa.array([text], pa.string()))
    read = restore(names, spelled, model)
    return " ".join(read[c] for c in codes.tolist() if read[c])


def features(word: str) -> list[str]:
    """A restored word and its beginnings; of several words all of theirs."""
    out = []
    for w in word.split(" "):
        if len(w) > 1:
            out.append(w)
            out += [w[:k] + "*" for k in STARTS if len(w) > k]
    return out


# -- training ------------------------------------------------------------------


def char_model(docs: DataFrame) -> CharModel:
    """Trigram counts of all plain words of ``docs`` (text)."""
    docs.sparkSession.conf.set(common.ARROW_BATCH_CONF, str(common.ARROW_BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in common.slices(batch):
                _, codes, names, spelled = split(b.column("text"))
                count = np.bincount(codes, minlength=len(names)).tolist()
                total: dict[str, int] = defaultdict(int)
                for w, n, s in zip(names, count, spelled):
                    w = w.rstrip(MAYBE)
                    if n and not s and w.isalpha() and not THRICE.search(w):
                        w = f"{WORD_END}{WORD_END}{w}{WORD_END}"
                        for i in range(len(w) - 2):
                            total[w[i:i + 3]] += n
                yield common.batch_of(t=pa.array(list(total), pa.string()), n=pa.array(list(total.values()), pa.int64()))
    rows = docs.select("text").mapInArrow(run, "t string, n long").groupBy("t").agg(F.sum("n").alias("n"))
    counts = common.store(rows, "trigrams")
    return CharModel({r["t"]: r["n"] for r in sorted(common.most_frequent(counts, "n", MOST_TRIGRAMS).collect())})


def evidence(train: DataFrame, chars: CharModel) -> tuple[dict, dict, dict]:
    """Evidence of words and beginnings from ``train`` (text, label, half):
    (all rows, rows of half 0, rows of half 1)."""
    train.sparkSession.conf.set(common.ARROW_BATCH_CONF, str(common.ARROW_BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in common.slices(batch):
                offs, codes, names, spelled = split(b.column("text"))
                group = b.column("half").to_numpy().astype(np.int64) * 2 + b.column("label").to_numpy()
                doc = np.repeat(np.arange(b.num_rows), np.diff(offs))
                # a word once per document
                pair = pa.array(doc * max(len(names), 1) + codes).unique().to_numpy()
                d, w = pair // max(len(names), 1), pair % max(len(names), 1)
                table = np.bincount(w * 4 + group[d], minlength=4 * len(names)).reshape(-1, 4)
                total: dict[str, np.ndarray] = {"": np.bincount(group, minlength=4)}  # documents
                for word, n in zip(restore(names, spelled, chars), table):
                    for f in features(word):
                        total[f] = total[f] + n if f in total else n
                m = np.array(list(total.values())).reshape(-1, 4)
                yield common.batch_of(f=pa.array(list(total), pa.string()), **{f"n{k}": pa.array(m[:, k], pa.int64()) for k in range(4)})
    rows = (train.select("text", "label", "half").mapInArrow(run, "f string, n0 long, n1 long, n2 long, n3 long")
            .groupBy("f").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in range(4))))
    rows = common.store(rows, "evidence")
    docs = rows.where("f = ''").collect()
    if not docs:
        return {}, {}, {}
    d = [docs[0][f"n{k}"] for k in range(4)]
    out = []
    for clean, toxic, nc, nt in (("n0 + n2", "n1 + n3", d[0] + d[2], d[1] + d[3]), ("n0", "n1", d[0], d[1]), ("n2", "n3", d[2], d[3])):
        t, c = F.expr(toxic) + 0.5, F.expr(clean) + 0.5
        bound = F.log(t / (nt + 1)) - F.log(c / (nc + 1)) - F.sqrt(1 / t + 1 / c)
        few = rows.where((F.col("f") != "") & (F.expr(toxic) >= 2)).select("f", bound.alias("v")).where("v > 0")
        out.append({r["f"]: r["v"] for r in few.orderBy(F.desc("v"), "f").limit(MOST_FEATURES).collect()})
    return tuple(out)


@dataclass
class Model:
    chars: CharModel
    words: dict[str, float]
    weights: np.ndarray  # of the logistic layer
    halves: tuple[dict[str, float], dict[str, float]] = field(default_factory=lambda: ({}, {}))

    def inputs(self, texts: pa.Array, words: dict[str, float]) -> np.ndarray:
        """A document's strongest evidence, its amount and the number of words."""
        offs, codes, names, spelled = split(texts)
        get = words.get
        value = np.array([max([get(f, 0.0) for f in features(w)], default=0.0) for w in restore(names, spelled, self.chars)])
        n = len(offs) - 1
        out = np.zeros((n, N_INPUTS))
        out[:, 0] = 1
        out[:, 1] = np.log1p(np.diff(offs)) / 5
        if len(codes):
            v = value[codes]
            doc = np.repeat(np.arange(n), np.diff(offs))
            some = np.flatnonzero(v > 0)
            order = some[np.lexsort((-v[some], doc[some]))]
            dd, vv = doc[order], v[order]
            first = np.searchsorted(dd, np.arange(n))
            for k in range(3):
                at = first + k
                has = (at < len(dd)) & (dd[np.minimum(at, max(len(dd) - 1, 0))] == np.arange(n)) if len(dd) else np.zeros(n, bool)
                out[has, 2 + k] = vv[at[has]]
            out[:, 5] = np.log1p(np.bincount(dd, weights=vv, minlength=n))
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        z = self.inputs(texts, self.words) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, corpus: DataFrame, bound: int = SAMPLE) -> Model | None:
    """``docs``: doc_id, text of training rows; ``labels``: doc_id, label;
    ``corpus``: text of all rows, for the character model."""
    chars = char_model(corpus)
    known = labels.where(F.col("label").isNotNull()).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    few = common.store(common.hash_sample(docs.select("doc_id").join(known, "doc_id", "left_semi"), bound, 8), "sample")
    labelled = common.store(known.join(F.broadcast(few), "doc_id"), "labelled")  # about `bound` rows
    one = docs.join(F.broadcast(labelled), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    train = common.store(one.select("doc_id", "text", "label", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")), "train")
    if train.isEmpty():
        return None
    words, half0, half1 = evidence(train, chars)
    model = Model(chars, words, np.zeros(N_INPUTS))
    halves = (half0, half1)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        half = b.column("half").to_numpy()
        x = np.zeros((b.num_rows, N_INPUTS))
        for k in (0, 1):  # evidence from the other half
            at = np.flatnonzero(half == k)
            if len(at):
                x[at] = model.inputs(b.column("text").take(pa.array(at)), halves[1 - k])
        return common.batch_of(doc_id=b.column("doc_id"), label=b.column("label"), x=pa.array(list(x), pa.list_(pa.float64())))
    rows = common.map_text(train.select("doc_id", "label", "half", "text"), run, "doc_id long, label int, x array<double>")
    got = sorted(rows.collect())
    model.weights = _logistic(np.array([r["x"] for r in got]), np.array([r["label"] for r in got], float))
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (doc_id, held_out, text) with score and predicted."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        s = model.score(b.column("text")) if model else np.zeros(b.num_rows)
        return common.batch_of(doc_id=b.column("doc_id"), held_out=b.column("held_out"), score=pa.array(s, pa.float64()),
                               predicted=pa.array((s >= THRESHOLD).astype(np.int32), pa.int32()))
    return common.map_text(docs, run, "doc_id long, held_out boolean, score double, predicted int")
