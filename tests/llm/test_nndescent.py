"""Graph search against brute force."""

import numpy as np

from claimcheck.llm import nndescent


def brute(rows, queries, top=10):
    ok = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, x = np.array([i for i, _ in ok]), np.stack([v for _, v in ok])
    at = dict(ok)
    out = {}
    for q in queries:
        if q not in at:
            continue
        d = np.sqrt(((x - at[q]) ** 2).sum(axis=1))
        o = [j for j in np.lexsort((ids, d)) if ids[j] != q][:top]
        out[q] = [(int(ids[j]), float(d[j])) for j in o]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / max(1, sum(map(len, want.values())))


def test_table_recall_and_scores(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, [i for i, _ in rows if i % 100 == 0])
    got = found(nndescent.nearest(df, df.where("vec_id % 100 = 0")))
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    assert recall(got, want) >= 0.98
    at = {i: np.array(v, float) for i, v in rows}
    for q, w in got.items():
        assert [s for _, s in w] == sorted(s for _, s in w)
        for i, s in w:
            assert abs(s - np.sqrt(((at[q] - at[i]) ** 2).sum())) < 1e-12


def test_larger_cloud_and_foreign_queries(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.normal(size=(2500, 16)), rng.normal(size=16) + 0.01 * rng.normal(size=(500, 16))))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, range(0, 3000, 100))
    index = nndescent.Index(df)
    assert recall(found(index.search(df.where("vec_id % 100 = 0"))), want) >= 0.95
    foreign = [(10_000 + i, [float(c) for c in rng.normal(size=16)]) for i in range(20)]
    far = brute(rows + foreign, [i for i, _ in foreign])
    for q in far:
        far[q] = [w for w in far[q] if w[0] < 10_000]
    got = found(index.search(spark.createDataFrame(foreign, "vec_id long, embedding array<double>")))
    assert recall(got, far) >= 0.9


def test_copies_ties_and_odd_vectors(spark):
    nan = float("nan")
    rows = [(i, [1.0, 2.0]) for i in range(30)] + [(100, [1.0, 3.0]), (101, None), (102, [0.0, 0.0]), (103, [nan, 1.0]), (104, [1.0, None]), (105, [1.0]), (200, [1.0, 2.5])]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "vec_id long, embedding array<double>, score double")
    want = brute([r for r in rows if r[0] != 105], [0, 5, 100, 101, 200])
    got = found(nndescent.nearest(df, df.where("vec_id in (0, 5, 100, 101, 105, 200)")))
    assert got == want
    assert nndescent.nearest(df.limit(0), df).count() == 0
    assert nndescent.nearest(df, df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, [1.0, 1.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert found(nndescent.nearest(one, one)) == {1: [(2, 1.0)], 2: [(1, 1.0)]}


def test_shards_lose_nothing_and_keep_rounds_out_of_shuffles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 16))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(nndescent, "SHARD", 700)
    index = nndescent.Index(df)
    got = index.graph.groupBy("shard").count().collect()
    assert index.shards == len(got) == 6 and sum(r["count"] for r in got) == 4000
    asked = index.search(df.where("vec_id % 100 = 0"))
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") <= 2  # the whole search, and how queries are packed
    assert recall(found(asked), brute(rows, range(0, 4000, 100))) >= 0.98


def test_greedy_walk_on_the_graph_of_a_shard():
    x = np.random.default_rng(6).normal(size=(3000, 24)).astype(np.float32)
    near = nndescent.descend(x, 16, 5)
    d = nndescent.distances(x, x)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1)[:, :10]
    assert np.mean([len(set(a[:16]) & set(b)) / 10 for a, b in zip(near, want)]) >= 0.85
    assert all(i not in set(a) for i, a in enumerate(near))
    got = nndescent.walk(x, near, x[:200], np.arange(200), 100, 8)
    assert (got[:, 0] == np.arange(200)).all()
    assert np.mean([len(set(a[1:11]) & set(b)) / 10 for a, b in zip(got, want[:200])]) >= 0.95


def test_vectors_are_packed_exactly():
    x = np.array([[1.0, 0.5], [0.1, 2.0], [1e300, -1e-300]])
    raw = nndescent.pack(x)
    assert [len(r) for r in raw] == [8, 16, 16]
    assert (nndescent.unpack(raw, 2) == x).all() and (nndescent.unpack(raw[:1], 2) == x[:1]).all()
