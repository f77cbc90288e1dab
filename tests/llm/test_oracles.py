"""The queries against their DuckDB SQL, and the shape that the contract fixes for all of them."""

import zlib

import duckdb
import pytest

from claimcheck.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_rows_equal_the_oracle(spark, duck, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    want = duck.sql(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    key = lambda r: [str(x) for x in r]
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=key) == sorted(want.fetchall(), key=key)


def test_toxicity_columns(spark, sf_dir):
    df = queries.QUERIES["op9_toxicity"](spark, sf_dir)
    assert dict(df.dtypes) | {"held_out": "boolean", "score": "double", "predicted": "int"} == dict(df.dtypes)
    for r in df.collect():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_neighbour_columns(spark, sf_dir):
    df = queries.QUERIES["op10_nn_descent"](spark, sf_dir)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    assert {r.query_id for r in df.collect()} == {i for i in range(0, 500, 100)}


def test_native_plan_has_no_python(spark, sf_dir):
    plan = queries.QUERIES["op3_pii_pseudonyms"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Exchange" not in plan
