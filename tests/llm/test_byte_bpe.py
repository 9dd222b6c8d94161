"""Byte-level BPE by ranks against the tiktoken library."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import SF_SMALL

from meterwise.llm import byte_bpe

ODD = ["", None, " ", "a", "don't can't 'll'sx I'VE 's's  'd ''s", "x<|endoftext|>y", "  \n\n x\t\ty \n", "aaaaaaaa" * 100,
       "½²³¹ ab１２ 漢字 😀😀 é̀   x　y ", "!!!'s ''s '' 'll", "\x00\x01 a\x85b\x1c\x1d", "=" * 5000 + " " * 3000 + "a", "'", "\n's",
       "ſ K İ", "12,5 €\r\n", "ab" * 6000, "q" * (byte_bpe.ALONE + 1), "日本語" * 3000, "'t", "x's", "a ", " a", "   b"]


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _same(texts, library):
    r = byte_bpe.ranks(byte_bpe.default_path())
    ids, offs = r.encode(pa.array(texts, pa.string()))
    raw, ends = r.decode(ids)
    at = np.concatenate([[0], ends])[offs]
    for k, text in enumerate(texts):
        assert ids[offs[k]:offs[k + 1]].tolist() == library.encode_ordinary(text or ""), text
        assert raw[at[k]:at[k + 1]].tobytes() == (text or "").encode()


def test_ids_equal_the_librarys(library):
    _same(ODD, library)
    for text in ODD:  # alone, not beside others
        _same([text], library)


def test_random_texts(library):
    rng = random.Random(3)
    planes = [(32, 127), (0x80, 0x250), (0x250, 0x3000), (0x3000, 0xD800), (0xE000, 0x110000)]
    texts = ["".join(chr(rng.randrange(*rng.choice(planes))) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["".join(rng.choice("ab 's'tre ll\n\t1é.,!  ") for _ in range(rng.randrange(40))) for _ in range(1500)]
    _same(texts, library)


def test_a_piece_alone_merges_like_a_row(library):
    rng = random.Random(5)
    r = byte_bpe.ranks(byte_bpe.default_path())
    for n in (2, 3, 60, 700, 4000):
        piece = "".join(rng.choice("abcdeinst") for _ in range(n))
        if piece.encode() not in r.of:
            assert r.merge_alone(piece.encode()) == library.encode_ordinary(piece)


def test_digests_of_awkward_rows(spark, library):
    rows = [(k, t, "x") for k, t in enumerate(ODD)] + [(0, "twice", "y"), (0, "twice", "y"), (None, "no id", None)]
    got = byte_bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")).collect()
    want = []
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert Counter(map(tuple, got)) == Counter(want)
    assert byte_bpe.round_trip(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_on_documents(spark, library):
    from meterwise.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op11_byte_bpe_segment_tree"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
