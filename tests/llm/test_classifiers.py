"""Language, quality and toxicity: held-out accuracy and edge cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from meterwise.llm import langid, quality, toxicity

SF = "/root/testdata/sf0.01"
EDGES = [(1, None, "x"), (2, "", "x"), (3, "12 34 !!", "x"), (4, "漢字かな " * 3, "x"), (5, "the of and " * 40000, "x"), (6, "a", "x"), (6, "a", "x"), (None, "no id", "x")]


def _held(i, m, rest):
    return zlib.crc32(str(i).encode()) % m == rest


@pytest.fixture(scope="module")
def tables(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return docs, labels


def _edges(spark):
    return spark.createDataFrame([(i, False, t) for i, t, _ in EDGES], "doc_id long, held_out boolean, text string")


# -- language --------------------------------------------------------------------


def test_language_query(spark, tables):
    from meterwise.llm.queries import QUERIES
    docs, _ = tables
    got = QUERIES["op5_language_id"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    assert all(r.held_out == _held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97


def test_bundles_are_sums_of_bound_trigrams():
    texts = ["Ab c", "", "été ab"]
    got = langid.bundles(pa.array(texts), 64)
    v = langid.letter_vectors(64).astype(int)
    for row, text in zip(got, texts):
        want = np.zeros(64)
        for w in text.lower().split():
            s = [langid.EDGE, *map(ord, w), langid.EDGE]
            for a, b, c in zip(s, s[1:], s[2:]):
                want += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
        norm = np.linalg.norm(want)
        assert np.allclose(row, want / norm if norm else want, atol=1e-5)


def test_language_edges(spark):
    train = spark.createDataFrame([("the and of that with", "en"), ("der die und das mit", "de"), ("no language", None)], "text string, lang string")
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in langid.identify(_edges(spark), train).collect()}
    assert {(1, "und", False), (2, "und", False), (3, "und", False)} <= got and (5, "en", True) in got
    assert langid.identify(_edges(spark), train).count() == len(EDGES)
    nothing = langid.identify(_edges(spark), train.where("false")).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert langid.identify(_edges(spark).where("false"), train).count() == 0


# -- quality ---------------------------------------------------------------------


def _accuracy(got, labels, field):
    rows = [(r, getattr(labels[r.doc_id], field)) for r in got if r.held_out and r.doc_id in labels]
    return np.mean([r.predicted == y for r, y in rows]), rows


def test_quality_query(spark, tables):
    from meterwise.llm.queries import QUERIES
    docs, labels = tables
    got = QUERIES["op9_quality_classifier"](spark, SF).collect()
    assert len(got) == len(docs) and all(r.held_out == _held(r.doc_id, 5, 0) and r.predicted == (r.score >= 0.3) for r in got)
    accuracy, rows = _accuracy(got, labels, "quality")
    assert accuracy > 0.93 and np.mean([r.predicted for r, y in rows if y == 1]) > 0.97


def test_prior_and_risk_on_a_known_mixture():
    rng = np.random.default_rng(0)
    p = rng.normal(1.5, 1, (3000, quality.N_MEASURES)).astype(np.float32)
    mixed = rng.random(3000) < 0.7
    u = np.where(mixed[:, None], rng.normal(1.5, 1, (3000, quality.N_MEASURES)), rng.normal(-1.5, 1, (3000, quality.N_MEASURES))).astype(np.float32)
    model = quality.fit(p, u)
    assert abs(model.prior - 0.7) < 0.06
    assert np.mean((model.score(u) >= 0.5) == mixed) > 0.98
    assert quality.fit(p[:0], u) is None


def test_quality_edges(spark):
    from pyspark.sql import functions as F
    docs = _edges(spark).select("doc_id", "text")
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, None), (9, 1), (None, 1)], "doc_id long, label int")
    model = quality.learn(docs, labels)
    assert model is not None
    got = quality.score(_edges(spark), model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert quality.learn(docs, labels.where("false")) is None
    assert {r.score for r in quality.score(_edges(spark), None).collect()} == {0.5}
    wide = docs.withColumn("score", F.lit("clash"))
    assert quality.keep_good(wide, None).columns == wide.columns and quality.keep_good(wide, None).count() == len(EDGES)


# -- toxicity --------------------------------------------------------------------


@pytest.fixture(scope="module")
def chars(spark):
    words = ["you are an idiot and a stupid moron", "the clown is pathetic", "this trash is worthless", "the other idiot saw it here",
             "hello there good people", "class small butter letter see too"] * 5
    return toxicity.char_model(spark.createDataFrame([(w,) for w in words], "text string"))


@pytest.mark.parametrize("given, want", [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("idiooooot", "idiot"), ("i.d.i.o.t", "idiot"), ("p@th3tic!!!", "pathetic"),
    ("i d i o t", "idiot"), ("you 1d1ot", "you idiot"), ("letter", "letter"), ("small", "small"), ("m-o-r-o-n", "moron"), ("cl0wn,", "clown"),
    ("t r a s h here", "trash here"), ("yooou", "you")])
def test_restored_text(chars, given, want):
    assert toxicity.restore_text(given, chars) == want


def test_spelled_out_words_are_told_apart(chars):
    assert toxicity.restore_text("y o u i d i o t", chars) == "you idiot"
    assert toxicity.restore_text("", chars) == "" and toxicity.restore_text("!!! ???", chars) == ""


def test_viterbi_is_the_best_path(chars):
    """Against every reading of a short lattice."""
    import itertools
    import math

    def cost(c, x, last):
        if x == "":
            options = ([toxicity.REPEAT] if c == last else []) + ([] if c.isalpha() else [toxicity.MARK * (4 if c.isdigit() else 1)])
            return min(options, default=math.inf)
        if c.isalpha():
            return toxicity.KEEP if x == c else math.inf
        return toxicity.STAND if x in toxicity.STANDS.get(c, "") else math.inf
    for word in ("1d10t", "lll3t", "c!@s"):
        best = (math.inf, "")
        sets = [([c] if c.isalpha() else list(toxicity.STANDS.get(c, ""))) + [""] for c in word]
        for path in itertools.product(*sets):
            price = sum(cost(c, x, last) for c, x, last in zip(word, path, " " + word))
            s = toxicity.WORD_END * 2 + "".join(path) + toxicity.WORD_END
            price -= sum(chars.log(s[i:i + 3]) for i in range(len(s) - 2))
            best = min(best, (price, "".join(path)))
        assert chars.decode(word) == best[1]


def test_toxicity_query(spark, tables):
    from meterwise.llm.queries import QUERIES
    docs, labels = tables
    got = QUERIES["op8_toxicity"](spark, SF).collect()
    assert len(got) == len(docs) and all(r.held_out == _held(r.doc_id, 4, 2) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    accuracy, rows = _accuracy(got, labels, "toxic")
    assert accuracy > 0.93
    assert np.mean([r.predicted for r, y in rows if y == 0]) < 0.03


def test_disguised_words_are_scored_like_plain_ones(spark):
    toxic = [(i, f"the good people {w} are here and there", 1) for i, w in enumerate(["idiot", "moron"] * 20)]
    clean = [(100 + i, f"the good people {w} are here and there", 0) for i, w in enumerate(["today", "never"] * 20)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in toxic + clean], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in toxic + clean], "doc_id long, label int")
    model = toxicity.learn(docs, labels, docs.select("text"))
    texts = ["people idiot here", "people 1d10t here", "people m o r o n here", "people mooooron here", "people today here", "", "good people"]
    s = model.score(pa.array(texts))
    assert (s[:4] >= 0.3).all() and (s[4:] < 0.3).all()
    got = toxicity.score(_edges(spark), model).collect()
    assert len(got) == len(EDGES)
    assert toxicity.learn(docs, labels.where("false"), docs.select("text")) is None
    assert {r.score for r in toxicity.score(_edges(spark), None).collect()} == {0.0}


def test_strongly_substituted_words_are_restored(spark):
    words = ["you are an idiot and a loser", "kill the pathetic loser idiot", "the other people saw it there"] * 5
    model = toxicity.char_model(spark.createDataFrame([(w,) for w in words], "text string"))
    for given, want in (("1d107", "idiot"), ("1053r", "loser"), ("ki||", "kill"), ("idiot!", "idiot"), ("people!!!", "people"), ("2262", "2262"), ("!! |||", "")):
        assert toxicity.restore_text(given, model) == want, given


def test_texts_with_letters_stay_where_no_language_was_learned(spark):
    from meterwise.llm import langid
    docs = spark.createDataFrame([(1, "some words of a text", None), (2, "12 34", None), (3, None, None), (4, "слово", None)], "doc_id long, text string, lang string")
    langs, protos = langid.prototypes(docs.select("text", "lang"))
    assert langs == []
    kept = langid.keep_known(docs, langs, protos, 0.1)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4]
