"""Secret scans against the plain regular expressions."""

import hashlib
import re

import pyarrow as pa

from meterwise.llm import secrets as S

SF = "/root/testdata/sf0.01"

PLAIN = {  # the base kinds as stated: (pattern, group, least length)
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
TEXTS = [
    None, "", "nothing here", "password = hunter22", "PassWord:'abcdef' token= x ; apikey=\"qwerty/+=\" API_KEY = 12345",
    "token=abc token=abcdef", "é😀 secret: zzzzzz é passwd=1234567", "AKIA" + "Z" * 16, "AKIA" + "Z" * 15, "AKIAAKIA" + "A" * 12,
    "0" * 24, "0" * 23, "g" + "ab12" * 10 + "G" + "f" * 30, "secret=" + "deadbeef" * 5, "toKen = paſsword=aaaaaaa",
    "password=password=abcdefg", "x" * 100000 + " token: abcdefgh", "ghp_" + "a1B2" * 9, "xoxb-1234567890-abc",
    "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "-----BEGIN RSA PRIVATE KEY-----", "AIza" + "x" * 35, "api_key=AKIA" + "Q" * 16,
]


def plain(text):
    return {k: s for k, (p, g, n) in PLAIN.items() if (s := [m.span() for m in p.finditer(text or "") if len(m[g]) >= n])}


def digest(found):
    rows = sorted((a, list(PLAIN).index(k), z, k) for k, spans in found.items() for a, z in spans)
    return ",".join(f"{k}:{a}:{z}" for a, _, z, k in rows)


def test_queries_hold_mandatory_trigrams():
    q = {r.kind: S.trigram_query(r.pattern) for r in S.BASE + S.MORE}
    assert q["hex"] is True  # scanned fully
    assert q["access"] == ("and", b"aki", b"kia")
    assert {b"api", b"pas", b"sec", b"tok"} <= S.trigrams_of(q["assign"])
    assert S.trigram_query("ab") is True and S.trigram_query("(abc)?") is True
    assert S.trigram_query("a{3}b") == ("and", b"aaa", b"aab")
    assert S.trigram_query("x*abcd|zzz") == ("or", ("and", b"abc", b"bcd"), b"zzz")


def test_block_scan_equals_full_scan():
    rules = S.BASE + S.MORE
    found = S.scan_block(pa.array(TEXTS, pa.string()), rules)
    for t, f in zip(TEXTS, found):
        assert f == {r.kind: s for r in rules if (s := r.spans(t or ""))}
        assert {k: v for k, v in f.items() if k in PLAIN} == plain(t)
    assert [k for f in found for k in f if k not in PLAIN] == ["github", "slack", "jwt", "pem", "google"]


def test_query_equals_plain_expressions(spark):
    from meterwise.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op2_secret_scan"](spark, SF).collect()
    assert len(got) == len(docs) and any(r.n_assign for r in got)
    for r in got:
        want = plain(docs[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(len(want.get(k, ())) for k in PLAIN)
        assert r.base_sha256 == hashlib.sha256(digest(want).encode()).hexdigest()
        assert set(filter(None, digest(want).split(","))) <= set(r.spans.split(","))


def test_scan_and_redact_edges(spark):
    df = spark.createDataFrame([(k, t, "c") for k, t in enumerate(TEXTS)] + [(None, "token=abcdef", None)] * 2, "doc_id long, text string, spans string")
    assert S.scan(df).count() == len(TEXTS) + 2
    assert S.scan(df.where("false")).count() == 0
    wide = df.selectExpr("doc_id", "text", "'en' AS lang", "length(text) AS n_chars", "spans")
    out = S.redact(wide)
    assert out.schema.names == wide.schema.names and out.count() == wide.count()
    for r in out.where("doc_id is not null").collect():
        before = TEXTS[r.doc_id]
        if before is None:
            assert r.text is None
            continue
        assert r.n_chars == len(r.text)
        if not plain(before) and S.MASK not in r.text:
            assert r.text == before
        assert not [x for x in S.BASE[:2] if x.spans(r.text)]
    assert S.mask_text("a token=abcdef b", {"assign": [(2, 14)], "hex": [(8, 14)]}) == f"a {S.MASK} b"
