"""SetSketch near-duplicates against brute force over all pairs."""

import random
import re
from math import lgamma

import numpy as np
import pytest

from claimcheck.llm import _util, _words, setsketch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(zip(*(w[i:] for i in range(k)), strict=False))


def brute(rows, k):
    """{id: (set size, component)} by all pairs."""
    sets = {}
    for i, t in rows:
        sets[i] = shingles(t, k)
    ids = sorted(sets)
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if not a or not b or min(len(a), len(b)) * 100 < 80 * max(len(a), len(b)):
                continue
            both = len(a & b)
            if 100 * both >= 80 * (len(a) + len(b) - both):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(spark, rows, k):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = setsketch.near_duplicates(df, shingle_words=k).collect()
    want = brute(rows, k)
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(rows)
    assert all(r.kept == (r.id == r.component_id) for r in got)


@pytest.mark.parametrize("k", [2, 5])
def test_documents_match_brute_force(spark, sf_dir, k):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows, k)


def test_group_of_near_copies_with_stragglers(spark):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rnd.randrange(0, 22)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    check(spark, rows, 2)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE  two\n"), (8, "é " * 30000), (9, "é é"), (10, "É")]
    check(spark, rows, 2)
    check(spark, rows, 5)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert setsketch.near_duplicates(empty).count() == 0
    df = spark.createDataFrame([(1, "a b c", 7, "x"), (2, "a b c", 8, "y"), (None, "a", 1, "z")], "doc_id long, text string, component_id int, kept string")
    got = {r.id: (r.component_id, r.kept) for r in setsketch.near_duplicates(df).collect()}
    assert got == {1: (1, True), 2: (1, False), None: (None, True)}


def test_rows_that_share_ids(spark):
    rows = [(1, "a b c d e f"), (3, "a b c d e f"), (3, "g h i j k l"), (3, "g h i j k l"), (None, "a b c d e f"), (None, "m n o p q"), (None, "m n o p q"), (4, "g h i j k l"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.id or 0, r.n_shingles, r.component_id, r.kept) for r in setsketch.near_duplicates(df).collect()), key=str)
    want = [(1, 2, 1, True), (3, 2, 1, False), (3, 2, 3, True), (3, 2, 3, True), (0, 2, 1, False), (0, 1, None, True), (0, 1, None, True), (4, 2, 3, False), (0, 0, None, True)]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("broadcast", [True, False])
def test_blocks_of_what_is_left_apart(spark, monkeypatch, broadcast):
    """A group whose members share bands but are mostly below the threshold, in small blocks, also where nothing is small enough to broadcast."""
    if not broadcast:
        monkeypatch.setattr(setsketch, "BROADCAST_KEYS", -1)
        monkeypatch.setattr(setsketch, "BROADCAST_GROUPS", -1)
    monkeypatch.setattr(setsketch, "BLOCK", 16)
    monkeypatch.setattr(setsketch, "COARSE", 3)
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(260):
        w = list(base)
        for _ in range(rnd.choice([3, 4, 9, 10, 11, 12, 14])):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    check(spark, rows, 2)


def test_sketch_merges_and_estimates():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**63, 900, dtype=np.uint64)
    a = np.concatenate((common, rng.integers(0, 2**63, 60, dtype=np.uint64)))
    b = np.concatenate((common, rng.integers(0, 2**63, 90, dtype=np.uint64)))
    union = np.unique(np.concatenate((a, b)))
    s = setsketch.sketches(np.concatenate((a, b, union)), np.cumsum([0, len(a), len(b), len(union)]))
    assert (np.maximum(s[0], s[1]) == s[2]).all()
    j = setsketch.estimate(s[:1], s[1:2], np.array([len(a)]), np.array([len(b)]))[0]
    assert abs(j - 900 / len(union)) < 0.1


def test_estimate_drops_fewer_pairs_at_the_threshold_than_the_bands():
    m, j = setsketch.M, 0.8
    p = -np.log1p(-(0.5 - 0.5 * j) * (setsketch.B - 1) / setsketch.B) / np.log(setsketch.B)
    up, down = (x.ravel() for x in np.meshgrid(range(m + 1), range(m + 1)))
    up, down = up[up + down <= m], down[up + down <= m]
    lf = np.array([lgamma(i + 1) for i in range(m + 1)])
    chance = np.exp(lf[m] - lf[up] - lf[down] - lf[m - up - down] + (up + down) * np.log(p) + (m - up - down) * np.log(1 - 2 * p))
    up, down, chance = (x[chance > 1e-14] for x in (up, down, chance))
    i = np.arange(m)
    a = np.where(i < up[:, None], 2, np.where(i < (up + down)[:, None], 0, 1)).astype(np.uint8)
    size = np.full(len(a), 500.0)
    dropped = chance[setsketch.estimate(a, np.ones_like(a), size, size) < setsketch.floor_of_estimate(j)].sum()
    assert 0 < dropped < (1 - j**setsketch.ROWS) ** setsketch.BANDS


@pytest.mark.parametrize("k", [1, 2, 5])
def test_long_texts_in_pieces_have_the_same_sets(monkeypatch, k):
    rnd = random.Random(k)
    for text in (" ".join("w" * rnd.randrange(1, 40) + str(i) for i in range(300)), "x" * 1000, " \n " * 400, "ab " + "y" * 700 + " cd  " + "z" * 64, ""):
        data = np.frombuffer(text.encode(), np.uint8)
        off = np.array([0, len(data)])
        monkeypatch.setattr(_words, "SLICE_BYTES", 1 << 20)
        whole = _words.shingle_sets(data, off, k)
        monkeypatch.setattr(_words, "SLICE_BYTES", 64)
        pieces = _words.shingle_sets(data, off, k)
        assert whole[0].tolist() == pieces[0].tolist() and whole[1].tolist() == pieces[1].tolist()


def test_few_links_are_settled_in_one_job_as_many_are_in_rounds(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(5000, 5060)] + [(90 - i, 91 - i) for i in range(40)] + [(7, 7), (-3, 7)]
    edges += [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    while any(label[a] != label[b] for a, b in edges if a != b):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    few = _util.components(df, small=len(edges))
    assert {r.node: r.component for r in few.collect()} == label == {r.node: r.component for r in _util.components(df, small=10).collect()}
    assert few.rdd.getNumPartitions() == 1
    assert _util.components(df.where("a = b"), small=9).collect() == []
