"""The random field against enumeration, and its accuracy on held-out labels."""

import itertools
import zlib

import numpy as np
import pyarrow as pa

from claimcheck.llm import _words, queries, toxicity


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    old, toxicity.CHUNK = toxicity.CHUNK, 3
    try:
        sizes = [1, 0, 3, 4, 8, 10]
        doc = np.repeat(np.arange(len(sizes)), sizes)
        e, trans, start = rng.normal(size=len(doc)) * 2, rng.normal(size=(2, 2)), 0.7
        got, pairs = toxicity.Chains(doc, len(sizes)).run(e, trans, start)
        want_pairs = np.zeros((2, 2))
        for d in range(len(sizes)):
            x = e[doc == d]
            total, one = 0.0, np.zeros(len(x))
            pair = np.zeros((2, 2))
            for s in itertools.product((0, 1), repeat=len(x)):
                if not s:
                    continue
                w = np.exp(s[0] * start + sum(x[i] * s[i] for i in range(len(x))) + sum(trans[s[i], s[i + 1]] for i in range(len(x) - 1)))
                total += w
                one += w * np.array(s)
                for i in range(len(x) - 1):
                    pair[s[i], s[i + 1]] += w
            if len(x):
                np.testing.assert_allclose(got[doc == d], one / total, rtol=1e-9)
                want_pairs += pair / total
        np.testing.assert_allclose(pairs, want_pairs, rtol=1e-9)
    finally:
        toxicity.CHUNK = old


def test_held_out_accuracy(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.id: r for r in toxicity.detect(docs, labels).collect()}
    held = [(r.toxic, got[r.doc_id]) for r in labels.collect() if r.doc_id in got and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(got) == docs.count()
    wrong = sum((g.score >= 0.5) != bool(y) for y, g in held)
    assert wrong <= 0.05 * len(held), (wrong, len(held))


def test_spans_point_at_the_tokens(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(200):
        t = list(rng.choice(words, 60))
        if i % 2:
            t[int(rng.integers(60))] = "éidioten"
        texts.append(" ".join(t))
        labels.append(i % 2)
    model = toxicity.fit(texts, labels)
    df = spark.createDataFrame([(1, "Ñ w1 w2, éidioten! w3"), (2, "w1 w2"), (3, ""), (4, None), (None, "w1")], "doc_id long, text string")
    got = {r.id: r for r in toxicity.score(df, model).collect()}
    (s,) = got[1].spans
    assert "Ñ w1 w2, éidioten! w3"[s.start : s.end] == "éidioten" and got[1].predicted == 1
    assert all(got[i].predicted == 0 and got[i].spans == [] for i in (2, 3, 4, None))


def test_no_labels_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a", 0.5)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    (r,) = toxicity.detect(df, none).collect()
    assert r.predicted == 0 and 0 <= r.score <= 1
    assert toxicity.detect(df.limit(0), none).count() == 0


def test_long_texts_in_pieces_score_alike(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join([*rng.choice(words, 60), *(["éidioten"] if i % 2 else [])]) for i in range(200)]
    model = toxicity.fit(texts, [i % 2 for i in range(200)])
    long = [" ".join(rng.choice([*words, "éidioten", "x" * 300], 2000)), "Ñ w1, " * 900 + "éidioten! w3", "w1" * 2000, ";" * 3000, "éidioten " * 400]
    whole = [next(iter(toxicity._scored(pa.array([t]), model, model.dense()))) for t in long]
    monkeypatch.setattr(_words, "SLICE_BYTES", 700)
    monkeypatch.setattr(toxicity, "PIECE", 150)
    for t, (_, _, score, spans) in zip(long, whole, strict=True):
        _, _, again, pieces = next(iter(toxicity._scored(pa.array([t]), model, model.dense())))
        np.testing.assert_allclose(again, score, rtol=1e-9)
        assert [(s["start"], s["end"]) for s in pieces[0]] == [(s["start"], s["end"]) for s in spans[0]]


def test_repeated_ids_and_rows(spark):
    rows = [(i, f"common words {i} and {'éidioten' if i % 2 else 'friends'} here {i * 7}") for i in range(60)]
    df = spark.createDataFrame([*rows, rows[1], rows[1], (2, "another text with éidioten"), (None, rows[3][1])], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, i % 2) for i in range(60)), (4, None), (8, 7), (None, 1), (900, 1), (1, 0)], "doc_id long, toxic int")
    got = toxicity.detect(df, labels).collect()
    assert len(got) == 64
    assert sorted(r.predicted for r in got if r.id == 2) == [0, 1]
    assert len({r.score for r in got if r.id == 1}) == 1 and [r.predicted for r in got if r.id is None] == [1]


def test_query_equals_a_plain_scorer(spark, sf_dir):
    """The whole query against the same model with the recursions written token by token."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fitted(docs, labels)
    w = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    a = np.exp(model.trans)
    got = {r.doc_id: r for r in queries.QUERIES["op9_toxicity"](spark, sf_dir).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows[::3]:
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        _, _, _, feats = toxicity.tokens(data, np.array([0, len(data)]))
        y = [np.exp(np.clip(sum(w.get(b, 0.0) for b in f) + model.bias, -30, 30)) for f in feats.T.tolist()]
        fwd, back, now = [], [], np.array([1.0, np.exp(model.start)])
        for i, f in enumerate(y):
            now = (now if i == 0 else now @ a) * np.array([1.0, f])
            now = now / now.sum()
            fwd.append(now)
        now = np.ones(2)
        for f in reversed(y):
            back.append(now)
            now = a @ (now * np.array([1.0, f]))
            now = now / now.sum()
        p = np.array([(f * b)[1] / (f * b).sum() for f, b in zip(fwd, reversed(back), strict=True)])
        z = np.array([1.0, p.max(initial=0.0), np.log1p(p[p > 0.05].sum())])
        want = 1 / (1 + np.exp(-z @ model.logit))
        assert abs(got[r.doc_id].score - want) < 1e-5, r.doc_id
