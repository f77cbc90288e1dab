"""Poisson replication: the law, the targets and the SQL oracle."""

import math

from pyspark.sql import functions as F

from claimcheck.llm import mixing


def test_counts_follow_the_law(spark):
    df = spark.range(20000)
    for mean in (0.3, 2.5, 90.0):
        k = mixing.copies(F.lit(mean), "t", F.col("id").cast("string")).alias("k")
        r = df.select(k).agg(F.avg("k"), F.var_samp("k")).first()
        assert abs(r[0] - mean) < 5 * math.sqrt(mean / 20000)
        assert abs(r[1] / mean - 1) < 0.06


def test_inversion_is_exact(spark):
    def brute(mean, u):
        k, p = 0, math.exp(-mean)
        c = p
        while c < u:
            k += 1
            p *= mean / k
            c += p
        return k

    us = [0.001, 0.2, 0.5, 0.75, 0.9, 0.999, 0.9999999]
    df = spark.createDataFrame([(m, u) for m in (0.01, 1.0, 7.3, 31.0) for u in us], "m double, u double")
    for r in df.withColumn("k", mixing.inverse_poisson(F.col("m"), F.col("u"))).collect():
        assert r.k == brute(r.m, r.u)


def test_targets_and_null_source(spark):
    rows = [(i, "big") for i in range(6000)] + [(i, "small") for i in range(6000, 6500)] + [(i, None) for i in range(6500, 7000)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = {r.source: r["count"] for r in mixing.mix(df, weights={"big": 1, "small": 1, None: 2}, rows=8000).groupBy("source").count().collect()}
    for s, n in {"big": 2000, "small": 2000, None: 4000}.items():
        assert abs(got[s] - n) < 6 * math.sqrt(n)


def test_edges(spark):
    df = spark.createDataFrame([(1, "a", 9), (None, None, 8), (1, "a", 9)], "doc_id long, source string, copy int")
    out = mixing.mix(df, rows=30).collect()
    assert {(r.doc_id, r.source) for r in out} <= {(1, "a"), (None, None)}
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df, weights={"zzz": 1}).count() == 0


def test_oracle(spark, sf_dir):
    import duckdb

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted((r.doc_id, r.copy) for r in mixing.mix(docs).select("doc_id", "copy").collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    want = sorted(con.sql(f"SELECT doc_id, copy FROM ({mixing.oracle_sql()})").fetchall())
    assert got == want and len(got) > 500
