"""Byte-level BPE encoding and decoding with segment trees.

A text is cut into pretokens by the vocabulary's public pattern; every distinct
pretoken of a batch is encoded once. A pretoken's bytes are the leaves of a
segment tree; a leaf holds (rank of the pair starting there, position) and the
root is the smallest, i.e. the leftmost merge of lowest rank. Each merge changes
at most three leaves, whose paths are updated in logarithmic time, until the
root is empty. The trees of all pretokens of one size class are rows of one
numpy array and advance together, so that the cost is per merge, not per call.

Null text counts as empty: no ids, the empty decoded text. Texts of any length
are encoded whole (a tree's size follows its pretoken). Repeated rows and extra
columns change nothing: each row is encoded on its own.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
CONTRACTION = re.compile(rb"'(?:s|t|re|ve|m|ll|d)")  # fixed value: the pattern's first alternatives
CHUNK = 1 << 19  # leaves of the trees that advance together
NONE32, NONE64 = np.iinfo(np.int32).max, np.iinfo(np.int64).max


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    cls = np.full(0x110000, OTHER, np.uint8)
    chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for name, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(name, chars):
            a, b = ord(m[0][0]), ord(m[0][-1])
            if b - a + 1 == len(m[0]):
                cls[a:b + 1] = value
            else:  # the run crosses the surrogates
                cls[[ord(c) for c in m[0]]] = value
    return cls


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [letter[b] for b in range(256)]


class Vocabulary:
    """Ids, merges and token bytes of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        vocab = spec["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.byte_id = np.array([vocab[c] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.pair_key, self.pair_rank = key[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        table = [b""] * self.size
        for token, i in vocab.items():
            table[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            table[i] = token
        self.token_len = np.array([len(t) for t in table], np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_len)[:-1]])
        self.token_blob = np.frombuffer(b"".join(table), np.uint8)

    def rank(self, a: np.ndarray, b: np.ndarray, none: int) -> np.ndarray:
        """Rank of the pair (a, b); ``none`` if it never merges or b is missing (-1)."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((self.pair_key[at] == key) & (b >= 0) & (a >= 0), self.pair_rank[at], none)

    # -- pretokens ------------------------------------------------------------

    def split(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Positions in ``data`` (utf-8) at which a pretoken starts; ``starts``:
        those at which a text starts."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64)
        ascii_cls = char_classes()[:256].copy()
        cls = ascii_cls[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            b0, last = data[lead].astype(np.int64), n - 1
            b1, b2, b3 = (data[np.minimum(lead + k, last)].astype(np.int64) & 0x3F for k in (1, 2, 3))
            two, three = b0 < 0xE0, b0 < 0xF0
            cp = np.where(two, (b0 & 0x1F) << 6 | b1, np.where(three, (b0 & 0xF) << 12 | b1 << 6 | b2, (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3))
            of = char_classes()[np.minimum(cp, 0x10FFFF)]
            cls[lead] = of
            for k, has in ((1, slice(None)), (2, ~two), (3, ~three)):
                cls[np.minimum(lead[has] + k, last)] = of[has]
        begin = np.zeros(n + 1, bool)  # a text or special token starts here
        begin[starts] = True
        begin[n] = True
        inner = []
        raw = data.tobytes()
        for token in self.special:
            for m in re.finditer(re.escape(token), raw):
                begin[[m.start(), m.end()]] = True
                inner.append((m.start(), m.end()))
        first = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each character
        c = cls[first]
        here = begin[first]
        prev = np.concatenate([[255], c[:-1]])
        prev_blank = np.concatenate([[False], data[first[:-1]] == 0x20])
        follow = np.concatenate([c[1:], [SPACE]])
        last_of_text = np.concatenate([here[1:], [True]])
        is_space = c == SPACE
        at = here | np.where(is_space, (prev != SPACE) | ((follow != SPACE) & ~last_of_text), (prev != c) & ~prev_blank)
        mark = np.zeros(n + 1, bool)
        mark[first[at]] = True
        quotes = first[at & (data[first] == 0x27)]
        for q in quotes.tolist():
            if m := CONTRACTION.match(raw, q):
                e = m.end()
                if not begin[q + 1:e].any():
                    mark[q + 1:e] = False
                    mark[e] = True
        for a, b in inner:
            mark[a + 1:b] = False
        return np.flatnonzero(mark[:n])

    # -- merges ---------------------------------------------------------------

    def _merge(self, sym: np.ndarray, m: int) -> np.ndarray:
        """Merge rows of ``sym`` (n, m + 1; -1 after the end) in place, m a power of two."""
        n, shift = len(sym), m.bit_length() - 1
        small = m <= 1 << 14
        kind, none = (np.int32, NONE32) if small else (np.int64, NONE64)
        pos = np.arange(m)
        nxt = np.tile(np.arange(1, m + 2), (n, 1))
        length = (sym >= 0).sum(axis=1)
        nxt[np.arange(n), length - 1] = m
        prv = np.tile(np.concatenate([[m], np.arange(m)]), (n, 1))
        rank = self.rank(sym[:, :m].ravel(), sym[:, 1:].ravel(), -1).reshape(n, m)
        tree = np.full((n, 2 * m), none, kind)
        tree[:, m:] = np.where(rank >= 0, (rank << shift) | pos, none)
        s = m >> 1
        while s:
            tree[:, s:2 * s] = np.minimum(tree[:, 2 * s:4 * s:2], tree[:, 2 * s + 1:4 * s:2])
            s >>= 1
        flat, fsym, fnxt, fprv = tree.ravel(), sym.ravel(), nxt.ravel(), prv.ravel()
        rows = np.flatnonzero(tree[:, 1] != none)
        while len(rows):
            tb, sb = rows * (2 * m), rows * (m + 1)
            root = flat[tb + 1].astype(np.int64)
            i = root & (m - 1)
            new = self.merged[root >> shift]
            j = fnxt[sb + i]
            k = fnxt[sb + np.minimum(j, m - 1)]
            p = fprv[sb + i]
            fsym[sb + i] = new
            fsym[sb + j] = -1
            fnxt[sb + i] = k
            fprv[sb + k] = i
            right = self.rank(new, np.where(k < m, fsym[sb + k], -1), -1)
            left = self.rank(np.where(p < m, fsym[sb + p], -1), new, -1)
            flat[tb + m + j] = none
            flat[tb + m + i] = np.where(right >= 0, (right << shift) | i, none)
            pe = np.where(p < m, p, i)
            has = p < m
            flat[(tb + m + pe)[has]] = np.where(left >= 0, (left << shift) | pe, none)[has]
            nodes = [m + j, m + i, m + pe]
            for _ in range(shift):
                for x in range(3):
                    nodes[x] = nodes[x] >> 1
                    at = tb + 2 * nodes[x]
                    flat[at - nodes[x]] = np.minimum(flat[at], flat[at + 1])
            rows = rows[flat[tb + 1] != none]
        return sym

    def encode_distinct(self, blob: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pretokens blob[start : start + size]: (all ids, ids per pretoken)."""
        count = np.ones(len(size), np.int64)
        out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        cls = np.maximum(1, 2 ** np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
        for m in np.unique(cls).tolist():
            group = np.flatnonzero(cls == m)
            step = max(1, CHUNK // m)
            for a in range(0, len(group), step):
                g = group[a:a + step]
                at = start[g][:, None] + np.arange(m + 1)
                valid = np.arange(m + 1) < size[g][:, None]
                sym = np.where(valid, self.byte_id[blob[np.minimum(at, len(blob) - 1)]], -1)
                if m > 1:
                    sym = self._merge(sym, m)
                keep = sym >= 0
                count[g] = keep.sum(axis=1)
                out[len(out)] = (g, sym[keep])
        ends = np.cumsum(count)
        ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
        for g, flat in out.values():
            ids[spans(ends[g] - count[g], count[g])] = flat
        return ids, count

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of each text's ids)."""
        t = common.text_bytes(texts)
        joined = pa.concat_arrays([t])  # offsets from 0
        size = pc.binary_length(joined).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        if not total:
            return np.zeros(0, np.uint32), np.zeros(len(size) + 1, np.int64)
        lo = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset]
        data = np.frombuffer(joined.buffers()[2], np.uint8)[lo:lo + total]
        begin = ends - size
        cut = self.split(data, begin[size > 0])
        edges = np.concatenate([cut, [total]]).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
        enc = pieces.dictionary_encode()
        codes, uniq = enc.indices.to_numpy(), enc.dictionary
        usize = pc.binary_length(uniq).to_numpy(zero_copy_only=False).astype(np.int64)
        blob = np.frombuffer(uniq.buffers()[2], np.uint8)
        ustart = np.cumsum(usize) - usize
        special = {}
        for token, i in self.special.items():
            at = pc.index(uniq, pa.scalar(token, pa.binary())).as_py()
            if at >= 0:
                special[at] = i
        if special:  # encoded as one id whatever their bytes are
            usize[list(special)] = 1
        uids, ucount = self.encode_distinct(blob, ustart, usize)
        uend = np.cumsum(ucount)
        for at, i in special.items():
            uids[uend[at] - 1] = i
        count = ucount[codes]
        ids = uids[spans((uend - ucount)[codes], count)]
        tok_end = np.concatenate([[0], np.cumsum(count)])
        return ids, tok_end[np.searchsorted(cut, np.concatenate([begin, [total]]))]

    def decode_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, end of each id's bytes)."""
        n = self.token_len[ids]
        return self.token_blob[spans(self.token_start[ids], n)], np.cumsum(n)


def spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (count[0] of them), start[1], ..."""
    count = np.asarray(count, np.int64)
    total = int(count.sum())
    shift = np.repeat(start - (np.cumsum(count) - count), count)
    return shift + np.arange(total)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode and decode ``docs`` (doc_id, text): token count, hash of the ids and
    hash of the decoded text per row. The vocabulary file must be readable at
    ``path`` (default: the installed public one) on every executor."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(path or default_path())
        ids, offs = v.encode(b.column("text"))
        raw, ends = v.decode_bytes(ids)
        byte_at = np.concatenate([[0], ends])[offs]
        le, data = ids.astype("<u4").tobytes(), raw.tobytes()
        sha, dec = [], []
        for a, z, x, y in zip(offs[:-1].tolist(), offs[1:].tolist(), byte_at[:-1].tolist(), byte_at[1:].tolist()):
            sha.append(hashlib.sha256(le[4 * a:4 * z]).hexdigest())
            dec.append(hashlib.sha256(data[x:y].decode("utf-8", "replace").encode()).hexdigest())
        return common.batch_of(doc_id=b.column("doc_id"), n_tokens=pa.array(np.diff(offs), pa.int64()),
                               ids_sha256=pa.array(sha, pa.string()), decoded_sha256=pa.array(dec, pa.string()))
    return common.map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)
