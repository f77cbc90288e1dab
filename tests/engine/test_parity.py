"""Every query of the engine against its DuckDB oracle, and plan shapes."""

import duckdb
import pytest

from claimcheck.plans import oracle, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(x):
    return f"{x:.9f}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_rows_equal_the_oracle(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    want = duck.sql(oracle.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(c) for c in cols]
    assert sorted([plain(r[c]) for c in cols] for r in df.collect()) == sorted([plain(r[i]) for i in at] for r in want.fetchall())


@pytest.mark.parametrize("name", ["link_interval_candidates", "actual_outcomes", "group_metrics"])
def test_plans_have_no_product_and_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan
