"""Byte-level BPE by token ranks: encoding and decoding with a segment tree over bytes.

A rank file lists tokens (bytes) with their rank, which is also their id. A text is
cut by the public pattern; a piece that is a token itself is that token, any other
is merged: the leaves of a segment tree are the piece's byte positions, a leaf holds
the rank that joining the live token at this position with the next one would have,
and the root is the least rank, leftmost first. A merge joins the two live
neighbours, then updates three leaves (the joined token's, its left neighbour's, the
one that died) along their paths, until no pair is left. Two tokens may join whenever
their joined bytes are a token, however that token came to be.

Trees of one size advance together as rows of numpy arrays; very long pieces, of which
there are few, advance alone in plain lists. Both give the same ids.

Null text counts as empty: no ids, no bytes. Texts are encoded whole, however long.
Repeated rows and extra columns change nothing, each row stands for itself; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .bpe import LETTER, OTHER, SPACE, char_classes, spans

CONTRACTION = re.compile(r"'(?:s|t|re|ve|m|ll|d)")  # fixed value: the pattern's first alternatives
# Letters and numbers that Unicode 16.0 has beyond 15.1 (first, last). The
# rank files' public encoder knows Unicode 16.0; installed tables may be older or newer.
UNICODE_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0),
    (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C),
    (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA)]
LEAVES = 1 << 19  # of the trees that advance together
ALONE = 1 << 12  # bytes from which a piece advances alone
DEAD = np.int64(1) << 40  # above every rank and position


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point; those unassigned up to Unicode 16.0 are neither
    letters nor numbers."""
    assigned = np.fromiter((unicodedata.category(chr(c)) != "Cn" for c in range(0x110000)), bool, 0x110000)
    for a, b in UNICODE_16:
        assigned[a:b + 1] = True
    return np.where(assigned, char_classes(), np.uint8(OTHER))


def cut(text: str, begins: np.ndarray) -> np.ndarray:
    """Characters of ``text`` at which a piece begins; ``begins``: those at which a
    document begins, which no piece crosses."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    point = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = classes()[point]
    first = np.zeros(n + 1, bool)
    first[begins] = True
    first[n] = True
    before = np.concatenate([kind[:1], kind[:-1]])
    after_blank = np.concatenate([[False], point[:-1] == 0x20])
    gap = kind == SPACE
    # white space: the run begins, or this is its last character and a word follows in the same text
    word_follows = np.concatenate([~gap[1:], [False]]) & ~first[1:]
    start = np.where(gap, (before != SPACE) | word_follows, (kind != before) & ~after_blank) | first[:n]
    quote = np.flatnonzero(start & (point == 0x27))
    for q in quote.tolist():
        if m := CONTRACTION.match(text, q):
            end = m.end()
            if not first[q + 1:end].any():
                start[q + 1] = False
                if end < n and kind[end] == LETTER:
                    start[end] = True
    return np.flatnonzero(start)


class Ranks:
    """Tokens of a rank file, and the rank of every pair of tokens that may join."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.of = {base64.b64decode(t): int(r) for t, r in pairs}
        self.tokens = pa.array(list(self.of), pa.binary())
        self.ids = np.fromiter(self.of.values(), np.int64)
        self.size = int(self.ids.max()) + 1
        table = [b""] * self.size
        for t, r in self.of.items():
            table[r] = t
        self.length = np.array([len(t) for t in table], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.of_byte = np.array([self.of[bytes([b])] for b in range(256)], np.int32)
        key = [(self.of[t[:k]] * self.size + self.of[t[k:]], r) for t, r in self.of.items()
               for k in range(1, len(t)) if t[:k] in self.of and t[k:] in self.of]
        key.sort()
        self.pair = np.array([k for k, _ in key], np.int64)
        self.pair_rank = np.array([r for _, r in key], np.int64)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of a and b joined, DEAD where that is no token or one of them is missing (-1)."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (a >= 0) & (b >= 0), self.pair_rank[at], DEAD)

    # -- merging ----------------------------------------------------------------

    def merge_rows(self, tok: np.ndarray, width: int) -> np.ndarray:
        """Merge the rows of ``tok`` (pieces, width + 1; token of each byte, -1 after
        the end) in place; what stays >= 0 are the ids. ``width``: a power of two."""
        n, shift = len(tok), width.bit_length() - 1
        row = np.arange(n)
        size = (tok >= 0).sum(axis=1)
        after = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))  # next live position, width at the end
        after[row, size - 1] = width
        prior = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))  # live position before, -1 at the start
        leaf = self.join(tok[:, :width].ravel(), tok[:, 1:].ravel()).reshape(n, width)
        tree = np.empty((n, 2 * width), np.int64)  # rank, then position: the least is the leftmost least rank
        tree[:, width:] = leaf << shift | np.arange(width)
        level = width >> 1
        while level:
            kids = tree[:, 2 * level:4 * level]
            tree[:, level:2 * level] = np.minimum(kids[:, ::2], kids[:, 1::2])
            level >>= 1
        end = DEAD << shift
        live = np.flatnonzero(tree[:, 1] < end)
        while len(live):
            top = tree[live, 1]
            i = top & (width - 1)
            j = after[live, i]
            k = after[live, j]
            h = prior[live, i]
            joined = (top >> shift).astype(np.int32)
            tok[live, i], tok[live, j] = joined, -1
            after[live, i], prior[live, k] = k, i
            has = h >= 0
            h0 = np.where(has, h, i)
            right = self.join(joined, np.where(k < width, tok[live, k], -1))
            left = np.where(has, self.join(tok[live, h0], joined), right)
            for leaf_at, rank in ((j, DEAD), (i, right), (h0, left)):
                tree[live, width + leaf_at] = rank << shift | leaf_at
            for leaf_at in (j, i, h0):
                node = (width + leaf_at) >> 1
                for _ in range(shift):
                    tree[live, node] = np.minimum(tree[live, 2 * node], tree[live, 2 * node + 1])
                    node >>= 1
            live = live[tree[live, 1] < end]
        return tok

    def merge_alone(self, piece: bytes) -> list[int]:
        """Ids of one long piece."""
        n, get = len(piece), self.of.get
        width = 1 << (n - 1).bit_length()
        none = 1 << 62
        tree = [none] * (2 * width)
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            if (r := get(piece[i:i + 2])) is not None:
                tree[width + i] = r * width + i
        for x in range(width - 1, 0, -1):
            tree[x] = min(tree[2 * x], tree[2 * x + 1])

        def put(i: int) -> None:
            j = after[i]
            r = get(piece[i:after[j]]) if j < n else None
            x, tree[width + i] = (width + i) >> 1, none if r is None else r * width + i
            while x:
                a, b = tree[2 * x], tree[2 * x + 1]
                tree[x] = a if a < b else b
                x >>= 1

        while tree[1] != none:
            i = tree[1] % width
            j = after[i]
            k = after[i] = after[j]
            if k < n:
                prior[k] = i
            after[j] = n  # dead: joins nothing
            put(j)
            put(i)
            if prior[i] >= 0:
                put(prior[i])
        ids, i = [], 0
        while i < n:
            ids.append(self.of[piece[i:after[i]]])
            i = after[i]
        return ids

    # -- texts ------------------------------------------------------------------

    def encode_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct pieces in a row, number of ids of each)."""
        whole = pc.index_in(pieces, value_set=self.tokens)
        token = self.ids[pc.fill_null(whole, 0).to_numpy(zero_copy_only=False)]
        size = pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        blob = np.frombuffer(pieces.buffers()[2], np.uint8)
        begin = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset:pieces.offset + len(pieces)].astype(np.int64)
        count = np.ones(len(size), np.int64)
        known = pc.is_valid(whole).to_numpy(zero_copy_only=False)
        todo = np.flatnonzero(~known)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        width = 1 << np.ceil(np.log2(np.maximum(size[todo], 1))).astype(np.int64)
        for w in np.unique(width).tolist():
            of_width = todo[width == w]
            if w > ALONE:
                for p in of_width.tolist():
                    ids = np.array(self.merge_alone(pieces[p].as_py()), np.int64)
                    count[p] = len(ids)
                    done.append((np.array([p]), ids))
                continue
            step = max(1, LEAVES // w)
            for a in range(0, len(of_width), step):
                g = of_width[a:a + step]
                col = np.arange(w + 1)
                at = np.minimum(begin[g][:, None] + col, len(blob) - 1)
                tok = np.where(col < size[g][:, None], self.of_byte[blob[at]], np.int32(-1))
                tok = self.merge_rows(tok, w)
                keep = tok >= 0
                count[g] = keep.sum(axis=1)
                done.append((g, tok[keep]))
        ends = np.cumsum(count)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        out[ends[known] - 1] = token[known]
        for g, ids in done:
            out[spans(ends[g] - count[g], count[g])] = ids
        return out, count

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of each text's ids)."""
        strings = [b.decode("utf-8", "replace") for b in common.text_bytes(texts).cast(pa.binary()).to_pylist()]
        length = np.array([len(s) for s in strings], np.int64)
        joined = "".join(strings)
        if not joined:
            return np.zeros(0, np.int64), np.zeros(len(strings) + 1, np.int64)
        edge = np.concatenate([[0], np.cumsum(length)])
        at = cut(joined, edge[:-1][length > 0])
        point = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        byte = np.concatenate([[0], np.cumsum(1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000), dtype=np.int64)])
        offsets = byte[np.concatenate([at, [len(joined)]])].astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode("utf-8", "surrogatepass"))])
        enc = pieces.dictionary_encode()
        ids, count = self.encode_pieces(enc.dictionary)
        code = enc.indices.to_numpy()
        n = count[code]
        begin = (np.cumsum(count) - count)[code]
        total = np.concatenate([[0], np.cumsum(n)])
        return ids[spans(begin, n)], total[np.searchsorted(at, edge)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, where the bytes of each id end)."""
        n = self.length[ids]
        return self.bytes[spans(self.begin[ids], n)], np.cumsum(n)


@functools.lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode and decode ``docs`` (doc_id, text) by the ranks at ``path`` (default: the
    installed public file; readable on every executor): number of ids, hash of the ids,
    hash of the decoded bytes."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        r = ranks(path or default_path())
        ids, offs = r.encode(b.column("text"))
        raw, ends = r.decode(ids)
        byte_at = np.concatenate([[0], ends])[offs].tolist()
        le, data, at = memoryview(ids.astype("<u4").tobytes()), memoryview(raw.tobytes()), offs.tolist()
        rows = range(b.num_rows)
        return common.batch_of(
            doc_id=b.column("doc_id"), n_tokens=pa.array(np.diff(offs), pa.int64()),
            ids_sha256=pa.array([hashlib.sha256(le[4 * at[i]:4 * at[i + 1]]).hexdigest() for i in rows], pa.string()),
            decoded_sha256=pa.array([hashlib.sha256(data[byte_at[i]:byte_at[i + 1]]).hexdigest() for i in rows], pa.string()))
    return common.map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)
