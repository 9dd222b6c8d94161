"""The pipeline's stages on the given tables and on awkward rows."""

import corpus_pipeline as P
from meterwise.llm import bpe, neardup, secrets

SF = "/root/testdata/sf0.001"


def _write_and_read(spark, df, workdir, name):
    df.write.parquet(f"{workdir}/{name}")
    return spark.read.parquet(f"{workdir}/{name}")


def test_stages_in_order(spark, workdir):
    assert [n for n, _ in P.STAGES] == ["quality", "language", "near_dedup", "secrets", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    kept = {}
    for name, stage in P.STAGES:
        docs = _write_and_read(spark, stage(spark, docs, SF), workdir, name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns and docs.count() <= before
            before = docs.count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {r.doc_id for r in kept["quality"].collect()}
    assert sum(i in good for i, q in labels.items() if q == 1) >= 0.97 * sum(q == 1 for q in labels.values())
    assert kept["language"].count() == kept["quality"].count()  # all are prose of a known language
    classes = neardup.classes(kept["language"]).collect()
    assert kept["near_dedup"].count() == len({r.class_id for r in classes})
    assert kept["secrets"].count() == kept["near_dedup"].count()
    for r in kept["secrets"].collect():
        assert not [x for x in secrets.BASE[:2] if x.spans(r.text)] and r.n_chars == len(r.text)
    texts = [r.text for r in kept["secrets"].collect()]
    import pyarrow as pa
    ids, _ = bpe.vocabulary(bpe.default_path()).encode(pa.array(texts))
    rows = kept["packing"].collect()
    assert sum(r.length for r in rows) == len(ids) + len(texts)
    whole = P.run(spark, SF)
    assert whole.count() == len(rows)


def test_awkward_rows(spark, workdir):
    rows = [(None, "the of and is " * 30, "en", None, None, 1), (1, None, None, "s", 0, 1), (2, "", "en", "s", 0, 1), (3, "the of and in that " * 20, "en", "s", 3, 1),
            (3, "the of and in that " * 20, "en", "s", 3, 1), (4, "der die und " * 20 + "token = abcdef0123456789", "de", "s", 9, 2)]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    for n, df in enumerate((base, base.where("false"))):
        docs = _write_and_read(spark, df, workdir, f"in{n}")
        for k, (name, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == docs.columns
            docs = _write_and_read(spark, out, workdir, f"{n}-{k}")
    # stage by stage on the same rows
    docs = spark.read.parquet(f"{workdir}/in0")
    assert P.near_dedup_stage(spark, docs, SF).where("doc_id = 3").count() == 1
    assert P.secrets_stage(spark, docs, SF).where("doc_id = 4").first().text.endswith(secrets.MASK)
    assert P.language_stage(spark, docs, SF).where("text is null or text = ''").count() == 0
