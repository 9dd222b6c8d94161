"""Language identification with hyperdimensional n-gram profiles.

Every letter has a random bipolar vector of ``DIM`` components. A letter trigram
is bound as the product of its letters' vectors, rotated twice, once and not at
all, so that order counts; a document is the bundle (sum) of its trigrams, and a
language's prototype the bundle of its unit-length training documents. A
document's language is that of the prototype with the largest cosine.

Trigrams never cross a non-letter; word ends count as one more letter. Training
is one pass whose tasks emit one partial bundle per language and slice, summed
as integers, so results do not depend on the order. The prototypes (languages x
DIM numbers) are the only thing that reaches the driver.

Null texts and texts without a letter get ``und`` and score 0, as does every
text if there is nothing to learn from. Ties go to the language first by name.
Each row is predicted on its own and whole; repeated rows and extra columns
change nothing.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, common

DIM = 512
SEED = 5
SLOTS, OWN = 4096, 3072  # letter vectors; code points below OWN have their own
EDGE = 0  # slot of a word's end
SCALE = 1 << 20  # prototypes are summed in units of 1 / SCALE
UNKNOWN = "und"
ROWS = 256  # documents bundled by one matrix product


@functools.cache
def letter_vectors(dim: int = DIM) -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SLOTS, dim))


def trigram_vectors(slots: tuple, dim: int = DIM) -> np.ndarray:
    """Bound vectors of trigrams given by their letters' slots."""
    v = letter_vectors(dim)
    a, b, c = slots
    return (np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]).astype(np.float32)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, the three slots) of every trigram of a slice, documents ascending."""
    t = pc.utf8_lower(common.text_bytes(texts))
    joined = "\n".join(t.to_pylist()) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    doc = np.repeat(np.arange(len(t), dtype=np.int32), pc.utf8_length(t).to_numpy(zero_copy_only=False) + 1)
    slot = slot_table()[cp]
    letter = slot != EDGE
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    slot, doc = slot[keep], doc[keep]
    slot = np.concatenate([np.array([EDGE], slot.dtype), slot])  # the first document's own edge
    mid = np.flatnonzero(slot[1:-1] != EDGE)
    return doc[mid], (slot[:-2][mid], slot[1:-1][mid], slot[2:][mid])


@functools.cache
def slot_table() -> np.ndarray:
    """Slot of every code point; EDGE for what is no letter."""
    cp = np.arange(0x110000)
    return np.where(bpe.char_classes() == bpe.LETTER, np.where(cp < OWN, cp, OWN + cp % (SLOTS - OWN)), EDGE).astype(np.int16)


def _distinct(slots: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[tuple, np.ndarray]:
    """(slots of the distinct trigrams, which of them each trigram is); by table
    where the letters are few."""
    used = sum(np.bincount(s, minlength=SLOTS) for s in slots) > 0
    alphabet = np.flatnonzero(used)
    size = len(alphabet)
    at = (np.cumsum(used) - 1).astype(np.int64)
    a, b, c = slots
    code = at[a]
    for s in (b, c):
        code *= size
        code += at[s]
    if size ** 3 > 8 * len(code) + (1 << 20):
        uniq, inv = np.unique(code, return_inverse=True)
    else:
        there = np.bincount(code, minlength=size ** 3) > 0
        uniq = np.flatnonzero(there)
        inv = (np.cumsum(there) - 1)[code]
    return (alphabet[uniq // size ** 2], alphabet[uniq // size % size], alphabet[uniq % size]), inv


def bundles(texts: pa.Array, dim: int = DIM) -> np.ndarray:
    """Unit-length bundle of each text; zeros where there is no letter."""
    doc, slots = trigrams(texts)
    n = len(texts)
    out = np.zeros((n, dim), np.float32)
    if not len(doc):
        return out
    uniq, inv = _distinct(slots)
    vectors = trigram_vectors(uniq, dim)
    cut = np.searchsorted(doc, np.arange(0, n + ROWS, ROWS))
    for k in range(len(cut) - 1):
        lo, hi = cut[k], cut[k + 1]
        if lo == hi:
            continue
        there = np.bincount(inv[lo:hi], minlength=len(vectors)) > 0
        mine = np.flatnonzero(there)
        col = (np.cumsum(there) - 1)[inv[lo:hi]]
        rows = min(ROWS, n - k * ROWS)
        count = np.bincount((doc[lo:hi] - k * ROWS) * len(mine) + col, minlength=rows * len(mine))
        out[k * ROWS:k * ROWS + rows] = count.reshape(rows, -1).astype(np.float32) @ vectors[mine]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def prototypes(train: DataFrame, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Unit-length language prototypes of ``train`` (text, lang), by language name."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        vec = bundles(b.column("text"), dim)
        enc = b.column("lang").dictionary_encode()
        code = enc.indices.to_numpy()
        sums = [np.rint(vec[code == k].sum(axis=0, dtype=np.float64) * SCALE).astype(np.int64) for k in range(len(enc.dictionary))]
        return common.batch_of(lang=enc.dictionary, bundle=pa.array(sums, pa.list_(pa.int64())))
    part = common.map_text(train.where(F.col("lang").isNotNull()).select("text", "lang"), run, "lang string, bundle array<long>")
    rows = (part.select("lang", F.posexplode("bundle").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).orderBy("lang").collect())
    if not rows:
        return [], np.zeros((0, dim), np.float32)
    p = np.array([[x["x"] for x in r["v"]] for r in rows], np.float64)
    norm = np.linalg.norm(p, axis=1, keepdims=True)
    return [r["lang"] for r in rows], (p / np.where(norm > 0, norm, 1)).astype(np.float32)


def assign(texts: pa.Array, langs: list[str], protos: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, cosine within 0 to 1) of each text."""
    vec = bundles(texts, protos.shape[1])
    some = vec.any(axis=1)
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    cos = vec @ protos.T
    best = cos.argmax(axis=1)
    score = np.clip(cos[np.arange(len(best)), best].astype(np.float64), 0, 1)
    return [langs[k] if s else UNKNOWN for k, s in zip(best.tolist(), some.tolist())], np.where(some, score, 0.0)


def identify(docs: DataFrame, train: DataFrame, dim: int = DIM) -> DataFrame:
    """``doc_id, lang_pred, score`` and the columns of ``docs`` before text, learned
    from ``train`` (text, lang). ``docs``: doc_id, held_out, text."""
    langs, protos = prototypes(train, dim)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        name, score = assign(b.column("text"), langs, protos)
        return common.batch_of(doc_id=b.column("doc_id"), held_out=b.column("held_out"),
                               lang_pred=pa.array(name, pa.string()), score=pa.array(score, pa.float64()))
    return common.map_text(docs, run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, langs: list[str], protos: np.ndarray, least: float) -> DataFrame:
    """Rows of ``docs``, all columns, whose language is known with cosine ``least`` or
    more; where no language was learned, all rows whose text holds a letter."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        if not langs:
            return b.filter(pa.array(bundles(b.column("text"), protos.shape[1]).any(axis=1), pa.bool_()))
        name, score = assign(b.column("text"), langs, protos)
        keep = [n != UNKNOWN and s >= least for n, s in zip(name, score.tolist())]
        return b.filter(pa.array(keep, pa.bool_()))
    return common.map_text(docs, run, docs.schema)
