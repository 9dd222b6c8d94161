"""BPE encoding and packing against the tokenizers library."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer

from meterwise.llm import bpe, packing

ODD = ["", None, " ", "a", "don't can't 'll'sx I'VE 's's  'd", "x<|endoftext|>y  <|endoftext|> z<|endoftext|>", "  \n\n x\t\ty \n",
       "aaaaaaaa" * 100, "½²³¹ ab１２ 漢字 😀😀 é̀   x　y ", "!!!'s ''s '' 'll", "\x00\x01 a\x85b", "=" * 5000 + " " * 3000 + "a",
       "<|endoftext|> <|endoftext|><|endoftext|>'s", "'", "\n's", "ſ K İ", "der Löwe und 12,5 €\r\n", "ab" * 20000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def test_ids_equal_the_librarys(library):
    ids, offs = bpe.vocabulary(bpe.default_path()).encode(pa.array(ODD, pa.string()))
    for k, text in enumerate(ODD):
        assert ids[offs[k]:offs[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_round_trip_digests(spark, library):
    rows = [(k, t, "x") for k, t in enumerate(ODD)] + [(0, "twice", "y"), (0, "twice", "y"), (None, "no id", None)]
    got = bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")).collect()
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert Counter(map(tuple, got)) == Counter(want)
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_on_documents(spark, library):
    from meterwise.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op10_bpe_round_trip"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 60, 2000, 50000])
def test_plan_places_every_length_once(n):
    sizes = np.clip(np.random.default_rng(n).lognormal(6, 1.3, n).astype(int), 1, 2048)
    counts = Counter(sizes.tolist())
    used: Counter = Counter()
    groups = packing.plan(counts)
    for lengths, times in groups:
        assert sum(lengths) <= 2048 and times > 0
        for x in lengths:
            used[x] += times
    assert used == counts
    assert sum(t for _, t in groups) <= int(sizes.sum() / 2048 * 1.02) + 2


def test_exact_complements_are_found():
    index = packing._Complements(np.array([0, 0, 0, 1, 0, 2, 0, 0, 1, 0, 0, 0, 0, 0]))  # lengths 3, 5, 5, 8
    assert index.find(8) == (8,) and sorted(index.find(10)) == [5, 5] and sorted(index.find(11)) == [3, 8]
    assert sorted(index.find(13)) in ([3, 5, 5], [5, 8]) and index.find(12) is None and index.find(0) is None


def _check_packing(rows, docs, library):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for i, texts in docs.items():
        ids = sorted(library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts)
        assert sum(r.length for r in pieces[i]) == sum(map(len, ids))
        if len(texts) == 1:
            mine = sorted(pieces[i], key=lambda r: r.piece)
            assert [r.piece for r in mine] == list(range(len(mine)))
            at = 0
            for r in mine:
                assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[0][at:at + r.length], "<u4").tobytes())
                at += r.length
            assert all(r.length == 2048 for r in mine[1:])
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences)


def test_pack(spark, library):
    rows = [(1, "short"), (2, None), (3, ""), (4, "word " * 5000), (5, "same"), (5, "same"), (None, "no id"), (6, "x" * 9)]
    df = spark.createDataFrame([(a, b, "q") for a, b in rows], "doc_id long, text string, offset string")
    docs = defaultdict(list)
    for i, t in rows:
        docs[i].append(t)
    _check_packing(packing.pack(df).collect(), docs, library)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_packing_query(spark, library):
    from meterwise.llm.queries import QUERIES
    docs = {r.doc_id: [r.text] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op3_best_fit_packing"](spark, SF_SMALL).collect()
    n = _check_packing(rows, docs, library)
    assert n <= -(-sum(r.length for r in rows) // 2048) + 1


def test_numbers_are_dense_within_each_key(spark):
    df = spark.createDataFrame([(k, 7 if k % 3 else k) for k in range(500)], "a long, len long")
    got = packing.number(df, "len", ["a"], bucket_rows=20).collect()
    by = defaultdict(list)
    for r in got:
        by[r["len"]].append(r["number"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and sum(map(len, by.values())) == 500
