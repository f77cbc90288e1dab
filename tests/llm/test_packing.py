"""Packing: exact round trip, best fit against a plain search, bounds."""

import random
from collections import defaultdict

import numpy as np

from claimcheck.llm import packing


def test_best_fit_equals_a_plain_search():
    rnd = random.Random(2)
    for _ in range(60):
        context = rnd.choice([7, 16, 100])
        lengths = np.array([rnd.randint(1, context) for _ in range(rnd.randrange(80))], int)
        got = packing.best_fit_decreasing(lengths, context)
        free: list[int] = []
        for s in np.argsort(-lengths, kind="stable"):
            fit = [r for r in free if r >= lengths[s]]
            if fit:
                free.remove(min(fit))
                free.append(min(fit) - lengths[s])
            else:
                free.append(context - lengths[s])
        room = [context - sum(lengths[s] for s in row) for row in got]
        assert sorted(room) == sorted(free) and min(room, default=0) >= 0
        assert sorted(s for row in got for s in row) == list(range(len(lengths)))


def test_documents_come_back(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = packing.pack(docs).cache()
    parts = defaultdict(dict)
    for r in packing.unpack(packed).collect():
        parts[r.doc_id][r.piece_no] = r.ids
    enc = packing.tokenizer(packing.VOCAB)
    for r in docs.collect():
        ids = [x for k in sorted(parts[r.doc_id]) for x in parts[r.doc_id][k]]
        assert ids[-1] == packing.END and enc.decode(ids[:-1]) == r.text
    for r in packed.collect():
        pos = np.frombuffer(r.position_ids, "<u2")
        assert len(pos) == packing.CONTEXT and r.cu_seqlens[-1] == r.n_tokens
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]):
            assert pos[a:b].tolist() == list(range(b - a))
        assert (np.frombuffer(r.input_ids, "<u2")[r.n_tokens :] == packing.PAD).all()
    packed.unpersist()


def test_edges(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 3), (1, "", 4), (None, "word " * 5000, 5)], "doc_id long, text string, n_tokens int")
    packed = packing.pack(df)
    packing.write_packed(packed, str(tmp_path / "p"))
    got = packing.unpack(spark.read.parquet(str(tmp_path / "p"))).collect()
    assert sum(r.doc_id == 1 for r in got) == 2
    assert packing.pack(df.limit(0)).count() == 0


def plain(rows, context, block):
    """(doc, piece) pairs of the packed rows by a plain search, block by block; of rows with equal room the one that got it last."""
    enc = packing.tokenizer(packing.VOCAB)
    out, held, total = [], [], 0

    def place():
        made, free = [], []  # free: (room, row) in order of time
        for n, name in sorted(held, key=lambda x: -x[0]):
            fit = [f for f in free if f[0] >= n]
            if fit:
                least = min(f[0] for f in fit)
                room, row = next(f for f in reversed(fit) if f[0] == least)
                free.remove((room, row))
            else:
                room, row = context, len(made)
                made.append([])
            made[row].append(name)
            if room > n:
                free.append((room - n, row))
        out.extend(made)

    for d, text in rows:
        n = len(enc.encode_ordinary(text or "")) + 1
        held += [(min(context, n - k), (d, k // context)) for k in range(0, n, context)]
        total += n
        if total >= block:
            place()
            held, total = [], 0
    place()
    return out


def test_rows_of_a_partition_equal_a_plain_search(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 40_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").coalesce(1)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    packed = packing.pack(docs, context=256).collect()
    got = [list(zip(r.doc_ids, r.piece_nos, strict=True)) for r in packed]
    assert got == plain(rows, 256, 40_000)
    assert [r.pack_id for r in packed] == [f"{g[0][0]}:{g[0][1]}" for g in got] and len({r.pack_id for r in packed}) == len(packed)
