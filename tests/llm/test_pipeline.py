"""The pipeline against brute force, stage by stage."""

import zlib

import corpus_pipeline
from claimcheck.llm import mixing, queries, spm
from tests.llm import test_pii
from tests.llm.test_setsketch import brute as dedup_brute


def test_stages_against_brute_force(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(test_pii, "KEY", queries.DEMO_KEY)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = []
    now = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, sf_dir).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert now.columns == docs.columns
        steps.append(now)
    start = {r.doc_id: r for r in docs.collect()}
    clean = {r.doc_id: r for r in steps[0].collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(clean[i] == start[i] for i in clean)
    wrong = [i for i, y in labels.items() if (i in clean) == bool(y) and zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(wrong) <= 0.05 * len(labels) / 5
    want = {i for i, (_, c) in dedup_brute([(i, r.text) for i, r in clean.items()], 5).items() if i == c}
    single = {r.doc_id: r for r in steps[1].collect()}
    assert set(single) == want
    hidden = {r.doc_id: r.text for r in steps[2].collect()}
    assert hidden == {i: test_pii.brute(r.text) for i, r in single.items()}
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/2/*.parquet')")
    mixed = con.sql(f"SELECT doc_id, count(*) FROM ({mixing.oracle_sql()}) GROUP BY 1").fetchall()
    got = {r.doc_id: r["count"] for r in steps[3].groupBy("doc_id").count().collect()}
    assert got == dict(mixed)
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=spm.MODEL)
    last = steps[4].collect()
    assert len(last) == sum(got.values()) and all(r.round_trip for r in last)
    assert [r.ids for r in last[:100]] == lib.encode([hidden[r.doc_id] for r in last[:100]])


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir.replace("sf0.01", "sf0.001"))
    assert out.count() > 0 and "ids" in out.columns


def test_odd_and_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, None, "en", None, None), (3, "x " * 200000, "en", "a", 400000), (3, "x " * 200000, "en", "a", 400000)]
    for now in (docs.limit(0), spark.createDataFrame(odd, docs.schema)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            now = stage(spark, now, sf_dir)
            assert k == 4 or now.columns == docs.columns
        rows = now.collect()
        assert all(r.round_trip for r in rows)


def test_near_copies_go_by_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    a, b, c = "a b c d e f g", "h i j k l m n", "o p q r s t u v w x"
    texts = [(1, a), (3, a), (3, b), (4, c), (4, c), (5, c), (None, a), (None, "only here is it"), (None, "only here is it"), (6, ""), (6, ""), (7, None), (7, None)]
    rows = [(i, t, "en", f"s{n}", n) for n, (i, t) in enumerate(texts)]
    out = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, docs.schema), sf_dir)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = [(1, a), (3, b), (4, c), (None, "only here is it"), (6, ""), (6, ""), (7, None), (7, None)]
    assert got == sorted(want, key=str)
