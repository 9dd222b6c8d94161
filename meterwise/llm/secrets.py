"""Secret scans with a trigram inverted index.

Each rule's regular expression yields a Boolean query over lower-cased byte
trigrams: a literal needs all of its trigrams, alternatives are joined by OR, a
sequence by AND. For every bounded block of documents an inverted index holds,
for the trigrams that some rule asks for, the posting list of the block's
documents as a bit set; a rule's query intersects and unites postings, and only
the documents that remain are verified with the regular expression. A rule
whose expression has no mandatory trigram (the hexadecimal one) scans every
document. Blocks are independent, so nothing is shuffled and nothing is shared.

Positions are code points, the end exclusive; matches of a rule are leftmost
and do not overlap. Null text counts as empty and has no spans. Each row is
scanned on its own, whole; repeated rows and extra columns change nothing.
"""

from __future__ import annotations

import hashlib
import re
import re._constants as rc
import re._parser as rp
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0  # code points that `group` must have
    group: int = 0
    flags: int = re.ASCII
    compiled: re.Pattern = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "compiled", re.compile(self.pattern, self.flags))

    def __reduce__(self):
        return Rule, (self.kind, self.pattern, self.least, self.group, self.flags)

    def spans(self, text: str) -> list[tuple[int, int]]:
        g, least = self.group, self.least
        return [m.span() for m in self.compiled.finditer(text) if len(m[g]) >= least]


# The base kinds, in their order, then the kinds this scan adds.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),  # of a run the longest, so no other match than with +
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)

# -- trigram queries -----------------------------------------------------------
# A query is True (no condition), a trigram (bytes), ("and", ...) or ("or", ...).


def _all(parts: list) -> object:
    flat = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not flat else flat[0] if len(flat) == 1 else ("and", *flat)


def _any(parts: list) -> object:
    if any(p is True for p in parts):
        return True
    flat = list(dict.fromkeys(parts))
    return flat[0] if len(flat) == 1 else ("or", *flat)


def _literal(words: set[str]) -> object:
    """The text holds one of ``words``."""
    def one(w: str) -> object:
        raw = w.lower().encode()
        return _all([raw[i:i + 3] for i in range(len(raw) - 2)])
    return _any([one(w) for w in sorted(words)]) if words else True


MOST_WORDS = 64  # alternatives of an exact part that are kept apart


def _walk(tree) -> tuple[set[str] | None, object]:
    """(every text that the part matches, or None; the query it implies)."""
    exact: set[str] | None = {""}
    queries = []

    def flush():
        nonlocal exact
        if exact is not None:
            queries.append(_literal(exact))
        exact = {""}

    for op, arg in tree:
        part, query = None, True
        if op is rc.LITERAL:
            part = {chr(arg)}
        elif op is rc.SUBPATTERN:
            part, query = _walk(arg[-1])
        elif op is rc.BRANCH:
            each = [_walk(x) for x in arg[1]]
            if all(e is not None for e, _ in each):
                part = set().union(*(e for e, _ in each))
            query = _any([_literal(e) if e is not None else q for e, q in each])
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            least, most, inner = arg
            e, q = _walk(inner)
            if (least, most) == (0, 1) and e is not None:
                part = e | {""}
            elif least and e is not None and least == most and len(e) == 1 and least <= 8:
                part = {next(iter(e)) * least}
            elif least:
                query = _literal(e) if e is not None else q
        elif op is rc.IN and all(x[0] is rc.LITERAL for x in arg) and len(arg) <= 8:
            part = {chr(x[1]) for x in arg}
        if part is not None and exact is not None and len(part) * len(exact) <= MOST_WORDS:
            exact = {a + b for a in exact for b in part}
        else:
            flush()
            queries.append(query if part is None else _literal(part))
            exact = {""}
    if not queries:
        return exact, _literal(exact)
    flush()
    return None, _all(queries)


def trigram_query(pattern: str) -> object:
    """What every match of ``pattern`` implies about its lower-cased trigrams."""
    exact, query = _walk(rp.parse(pattern))
    return query if exact is None else _literal(exact)


def trigrams_of(query: object) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(trigrams_of(q) for q in query[1:]))


def evaluate(query: object, postings: dict[bytes, np.ndarray], everything: np.ndarray) -> np.ndarray:
    if query is True:
        return everything
    if isinstance(query, bytes):
        return postings[query]
    parts = [evaluate(q, postings, everything) for q in query[1:]]
    return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)


def index(texts: pa.Array, wanted: list[bytes]) -> dict[bytes, np.ndarray]:
    """Inverted index of a block: for each wanted trigram, which documents hold it."""
    t = pa.concat_arrays([pc.ascii_lower(texts)])
    n = len(t)
    ends = np.cumsum(pc.binary_length(t).to_numpy(zero_copy_only=False).astype(np.int64))
    postings = {w: np.zeros(n, bool) for w in wanted}
    if not n or not ends[-1] or not wanted:
        return postings
    offs = np.frombuffer(t.buffers()[1], np.int32)
    lo = int(offs[t.offset])
    data = np.frombuffer(t.buffers()[2], np.uint8)[lo:lo + int(ends[-1])]
    # trigrams whose first two bytes match some wanted one, then the whole trigram
    pair = np.zeros(1 << 16, bool)
    for w in wanted:
        pair[w[0] << 8 | w[1]] = True
    two = data[:-1].astype(np.uint16) << 8 | data[1:]
    at = np.flatnonzero(pair[two[:-1]])
    code = two[at].astype(np.int64) << 8 | data[at + 2]
    doc = np.searchsorted(ends, at, "right")
    inside = at + 3 <= ends[doc]
    code, doc = code[inside], doc[inside]
    for w in wanted:
        postings[w][doc[code == int.from_bytes(w, "big")]] = True
    return postings


def scan_block(texts: pa.Array, rules: tuple[Rule, ...]) -> list[dict[str, list[tuple[int, int]]]]:
    """Spans of each rule in each text of a block."""
    t = common.text_bytes(texts)
    queries = [trigram_query(r.pattern) for r in rules]
    postings = index(t, sorted(set().union(*(trigrams_of(q) for q in queries))))
    found: list[dict[str, list[tuple[int, int]]]] = [{} for _ in range(len(t))]
    everything = np.ones(len(t), bool)
    hits = [evaluate(q, postings, everything) for q in queries]
    for k in np.flatnonzero(np.logical_or.reduce(hits)).tolist() if hits else []:
        text = t[k].as_py()
        for rule, hit in zip(rules, hits):
            if hit[k] and (s := rule.spans(text)):
                found[k][rule.kind] = s
    return found


def digest(found: dict[str, list[tuple[int, int]]], kinds: list[str]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    rows = sorted((a, i, z) for i, k in enumerate(kinds) for a, z in found.get(k, ()))
    return ",".join(f"{kinds[i]}:{a}:{z}" for a, i, z in rows)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """Spans of all ``rules`` in ``docs`` (doc_id, text); see the query's columns."""
    kinds, base = [r.kind for r in rules], [r.kind for r in BASE]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = scan_block(b.column("text"), rules)
        counts = [pa.array([len(f.get(k, ())) for f in found], pa.int64()) for k in base]
        sha = [hashlib.sha256(digest(f, base).encode()).hexdigest() for f in found]
        return common.batch_of(doc_id=b.column("doc_id"), n_assign=counts[0], n_access=counts[1], n_hex=counts[2],
                               base_sha256=pa.array(sha, pa.string()), spans=pa.array([digest(f, kinds) for f in found], pa.string()))
    return common.map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)


MASK = "[secret]"


def mask_text(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """``text`` with every span, overlapping ones joined, replaced by ``MASK``."""
    out, at = [], 0
    merged: list[list[int]] = []
    for a, z in sorted(s for spans in found.values() for s in spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], z)
        else:
            merged.append([a, z])
    for a, z in merged:
        out += [text[at:a], MASK]
        at = z
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``docs`` with the same rows and columns, secrets in ``text`` masked and
    ``n_chars`` (where there is one) counting the new text. Null text stays null."""
    names, types = docs.columns, docs.schema

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        col = b.column("text")
        texts = common.text_bytes(col)
        found = scan_block(texts, rules)
        changed = [k for k, f in enumerate(found) if f]
        if not changed:
            return b
        values = col.to_pylist()
        sizes = b.column("n_chars").to_pylist() if "n_chars" in names else None
        for k in changed:
            values[k] = mask_text(values[k], found[k])
            if sizes is not None:
                sizes[k] = len(values[k])
        new = {"text": pa.array(values, col.type)}
        if sizes is not None:
            new["n_chars"] = pa.array(sizes, b.column("n_chars").type)
        return pa.RecordBatch.from_arrays([new.get(c, b.column(c)) for c in names], names=names)
    return common.map_text(docs, run, types)
