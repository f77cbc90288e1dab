"""Streaming Viterbi against the public library, and exact round trips."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimcheck.llm import spm


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=spm.MODEL)


def test_ids_equal_the_library_on_documents(spark, sf_dir, library):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = spm.decode(spm.encode(rows), text_col="back").select("text", "ids", "back").collect()
    for r in out:
        assert r.back == r.text
    sample = out[::5]
    assert [r.ids for r in sample] == library.encode([r.text for r in sample], num_threads=4)


def test_random_strings_equal_the_library(library):
    rnd = random.Random(3)
    c = spm.Codec(spm.MODEL)
    alphabets = [" ab", "the ing\n", "é ü€😀x", "  \t\nqz", "0123456789.-", "aaaaab", "日本語 ab", "Hello, World! don't", "▁ a"]
    for n in range(1500):
        t = "".join(rnd.choice(alphabets[n % len(alphabets)]) for _ in range(rnd.randrange(60)))
        assert c.encode(t).tolist() == library.encode(t), repr(t)
        if "▁" not in t:
            assert c.decode(c.encode(t)) == t


def test_stream_holds_a_short_window_and_commits_the_same_ids(library):
    text = "".join(random.Random(4).choice("etaoinshrdlu") for _ in range(20000))
    s = spm.StreamingViterbi(spm.codec(spm.MODEL).v)
    got = b"".join(s.push(text[i : i + 7]) for i in range(0, len(text), 7)) + s.push("", last=True)
    assert s.most < 10 * s.v.longest
    whole = spm.StreamingViterbi(s.v)
    assert np.frombuffer(got, np.int32).tolist() == np.frombuffer(whole.push(text, last=True), np.int32).tolist()
    assert spm.codec(spm.MODEL).encode(text).tolist() == library.encode(text)


@pytest.mark.parametrize("size", [20, 50, 128])
def test_slices_give_the_same_ids(monkeypatch, library, size):
    monkeypatch.setattr(spm, "SLICE", size)
    rnd = random.Random(size)
    c = spm.Codec(spm.MODEL)
    alphabets = [" ab", "the ing\n", "é ü€😀x", "  \t\nqz", "0123456789.-", "aaaaab", "日本語 ab", "Hello, World! don't", "▁ a", "    \n"]
    for n in range(600):
        t = "".join(rnd.choice(alphabets[n % len(alphabets)]) for _ in range(rnd.randrange(300)))
        ids = c.encode(t)
        assert ids.tolist() == library.encode(t), repr(t)
        assert c.decodes_to(ids, t) == (c.decode(ids) == t) == ("▁" not in t)
        assert not c.decodes_to(ids, t + "x") and not (t and c.decodes_to(ids, t[:-1]))


def test_a_text_of_fifty_megabytes_takes_little_besides_itself_and_its_ids(library):
    import tracemalloc

    rnd = random.Random(6)
    words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(1, 12))) for _ in range(3000)]
    text = " ".join(rnd.choice(words) for _ in range(100_000))
    text = text * (50_000_000 // len(text)) + " " + "ab" * 300_000  # and one word longer than many slices
    c = spm.Codec(spm.MODEL)
    tracemalloc.start()
    ids = c.encode(text)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 2.5 * ids.nbytes + 16_000_000
    assert c.decodes_to(ids, text)
    assert ids.tolist() == library.encode(text)


def test_long_and_repeated_rows_and_the_sign_of_a_space(spark):
    long = "some words " * 900_000
    df = spark.createDataFrame([(1, long), (2, "a"), (2, "a"), (3, "x\u2581y"), (4, long)], "doc_id long, text string")
    out = spm.decode(spm.encode(df, check_col="ok"), text_col="back").select("doc_id", "ok", F.col("back") == F.col("text"), F.size("ids").alias("n"), F.substring("back", 1, 5)).collect()
    got = sorted(tuple(r) for r in out)
    n = spm.codec(spm.MODEL).encode(long).size
    assert got == [(1, True, True, n, "some "), (2, True, True, 1, "a"), (2, True, True, 1, "a"), (3, False, False, got[3][3], "x y"), (4, True, True, n, "some ")]


def test_unigram_scores_equal_the_library(tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=spm.MODEL).serialized_model_proto())
    m.trainer_spec.model_type = spm.UNIGRAM
    rnd = random.Random(8)
    for p in m.pieces:
        if p.type == 1:
            p.score = -rnd.random() * 10 - 1
    path = str(tmp_path / "u.model")
    with open(path, "wb") as f:
        f.write(m.SerializeToString())
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), spm.Codec(path)
    for t in ["the quick brown fox", "  two  spaces here", "naïve café", "a" * 50, "Thé les éaux\nune ligne"]:
        assert own.encode(t).tolist() == lib.encode(t)


def test_nulls_empty_table_and_clashes(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "a b", "z")], "doc_id long, text string, ids string")
    assert all(r.ok for r in spm.encode(df, check_col="ok").collect())
    got = {r.doc_id: r.ids for r in spm.encode(df).collect()}
    assert got[1] == [] and got[2] == [] and len(got[3]) == 2
    assert spm.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0
