"""Embedding near-duplicates against all pairs in double precision."""

import numpy as np
import pytest

from claimcheck.llm import rpforest


def brute(rows, threshold=0.93):
    ok = [(i, np.array(v, float), lab) for i, v, lab in rows if v is not None and lab is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, *_ in rows}
    for n, (i, a, p) in enumerate(ok):
        for j, b, q in ok[n + 1 :]:
            if p == q and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i].add(j)
                links[j].add(i)
    comp = {}
    for i in sorted(links):
        if i in comp:
            continue
        todo, comp[i] = [i], i
        while todo:
            for j in links[todo.pop()]:
                if j not in comp:
                    comp[j] = i
                    todo.append(j)
    return {i: (len(links[i]), comp[i]) for i in links}


def cloud(n, seed=0, dim=32):
    rng = np.random.default_rng(seed)
    rows = []
    base = rng.normal(size=(n // 6, dim))
    for i in range(n):
        b = base[rng.integers(len(base))] if i % 3 else rng.normal(size=dim)
        rows.append((i, [float(x) for x in b + rng.normal(size=dim) * rng.choice([0, 0.1, 0.25, 0.4])], int(i % 2)))
    return rows


@pytest.mark.parametrize("part", [rpforest.PART, 150])
def test_matches_brute_force(spark, part):
    rows = cloud(1500)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = rpforest.near_duplicates(df, part=part, leaf=64).collect()
    want = brute(rows)
    assert len(got) == len(rows) and all(r.kept == (r.id == r.component_id) for r in got)
    found, all_links = sum(r.n_links for r in got), sum(n for n, _ in want.values())
    assert all(r.n_links <= want[r.id][0] for r in got)
    assert found >= 0.99 * all_links > 1000
    assert sum((r.n_links, r.component_id) == want[r.id] for r in got) >= 0.98 * len(rows)


def test_table_matches_brute_force(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert {r.id: (r.n_links, r.component_id) for r in rpforest.near_duplicates(df).collect()} == brute(rows)


def test_dense_group_keeps_all_its_links():
    rng = np.random.default_rng(2)
    x = np.concatenate((rng.normal(size=16) + 0.05 * rng.normal(size=(900, 16)), rng.normal(size=(3000, 16))))
    counts, name = rpforest.links_within(x, np.ones(len(x), int), 0.93, range(rpforest.TREES))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.93).sum(axis=1) - 1
    assert (counts <= want).all() and counts.sum() >= 0.999 * want.sum()
    assert (name[:900][want[:900] > 0] == 0).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
        (7, [inf, 1.0], 1), (8, [1.0, None], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, -0.0], 1), (12, [1.0, 0.0], 2),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, n_links string")
    assert {r.id: (r.n_links, r.component_id) for r in rpforest.near_duplicates(df).collect()} == brute(rows)
    assert rpforest.near_duplicates(df.limit(0)).count() == 0


def near(rng, n, dim, mean_cosine):
    base = rng.normal(size=dim)
    spread = (1 / mean_cosine - 1) ** 0.5 / dim**0.5
    return base / np.linalg.norm(base) + spread * rng.normal(size=(n, dim))


@pytest.mark.parametrize("diffuse", [0, 2400])
def test_dense_group_larger_than_a_part(spark, diffuse):
    rng = np.random.default_rng(4)
    x = np.concatenate((near(rng, 900, 32, 0.97), rng.normal(size=(diffuse, 32))))
    x[5] = x[6]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.id: (r.n_links, r.component_id) for r in rpforest.near_duplicates(df, part=300, leaf=64).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= 0.93).sum(axis=1) - 1
    assert {i: n for i, (n, _) in got.items()} == dict(enumerate(links.tolist()))
    assert all(c == 0 for i, (_, c) in got.items() if i < 900 and links[i])


@pytest.mark.parametrize("dim, mean_cosine", [(64, 0.9), (32, 0.88)])
def test_diffuse_group_keeps_its_links(dim, mean_cosine):
    x = near(np.random.default_rng(6), 4000, dim, mean_cosine)
    counts, _ = rpforest.links_within(x, np.ones(len(x), int), 0.93, range(rpforest.TREES))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.93).sum(axis=1) - 1
    assert (counts <= want).all() and counts.sum() >= 0.999 * want.sum() > 1000


def test_a_dense_label_of_twelve_parts_equals_brute_force(spark):
    x = near(np.random.default_rng(8), 3600, 24, 0.94)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.id: r.n_links for r in rpforest.near_duplicates(df, part=300, leaf=64).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= 0.93).sum(axis=1) - 1
    assert 0.2 < links.mean() / 3600 < 0.95
    assert got == dict(enumerate(links.tolist()))


def test_dense_groups_inside_parts_count_once(spark):
    rng = np.random.default_rng(10)
    x = np.concatenate([near(rng, int(n), 32, 0.965) for n in rng.integers(90, 260, 14)] + [rng.normal(size=(700, 32))])
    x = x[rng.permutation(len(x))]
    x[1] = x[0]
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.id: r.n_links for r in rpforest.near_duplicates(df, part=600, leaf=48).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= 0.93).sum(axis=1) - 1
    assert all(got[i] <= n for i, n in enumerate(links.tolist()))
    assert sum(got.values()) >= 0.999 * links.sum() > 100_000


def test_rows_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0], 1), (5, [1.0, 0.01], 1), (5, [0.0, 1.0], 1), (6, [0.01, 1.0], 1), (6, [0.01, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in rpforest.near_duplicates(df).collect())
    assert got == [(1, 1, 1, True), (5, 1, 1, False), (5, 2, 5, True), (6, 2, 5, False), (6, 2, 5, False)]
