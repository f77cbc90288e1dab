"""WARC archives: exact read-back, revisits and look-ups."""

import base64
import gzip
import hashlib

from claimcheck.llm import warc


def want(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(i, first.get(h or "", i))
    out = {}
    for i, _, h in rows:
        if i is None:
            continue
        p = (h or "").encode()
        ref = first.get(h or "", i)
        out[i] = (len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if ref == i else "revisit", None if ref == i else ref)
    return out


def read(df):
    rows = df.collect()
    out = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows}
    assert len(out) == len(rows)
    return out


def got(a):
    return read(a.read_all())


def test_pages_come_back(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in df.collect()]
    a = warc.archive(df)
    assert got(a) == read(a.lookup(df)) == want(rows)
    some = df.where("page_id % 25 = 3")
    found = {r.page_id: r for r in a.lookup(some, payloads=True).collect()}
    for r in some.collect():
        assert found[r.page_id].payload is None and found[r.page_id].refers_to is not None or found[r.page_id].payload.decode() == r.html
    keys = {warc.surt(r.url) for r in some.collect()}
    assert set(found) == {i for i, u, _ in rows if warc.surt(u) in keys}
    assert a.lookup(spark.createDataFrame([("http://nowhere.test/",)], "url string")).count() == 0


def test_revisits_and_odd_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    monkeypatch.setattr(warc, "SHARD_CAPTURES", 10)
    rows = [(i, f"http://h{i % 4}.example.org/p", "same" if i % 3 else f"own {i} é\r\n\r\nWARC/1.1") for i in range(40)]
    rows += [(50, None, None), (51, "", ""), (52, "x\ny", "z" * 300000), (None, "u", "same")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, path string")
    a = warc.archive(df)
    assert got(a) == read(a.lookup(df)) == want(rows)
    assert a.shards.count() > 2 and a.top
    urls = lambda *u: spark.createDataFrame([(x,) for x in u], "link string")
    assert set(read(a.lookup(urls("https://h1.example.org/p"), "link"))) == set(range(1, 40, 4))
    assert set(read(a.lookup(urls("https://h1.example.org/p", None, "http://h1.example.org/p", "zz", "a", "http://h2.example.org/q"), "link"))) == {*range(1, 40, 4), 50, 51}
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    assert got(warc.archive(df)) == want(rows)
    monkeypatch.undo()
    assert got(warc.archive(df, min_revisit_bytes=5)) == want(rows, 5)


def test_files_are_gzip_members_of_valid_records(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a.b/", "x")], "page_id long, url string, html string")
    warc.archive(df, "file://" + str(tmp_path / "w"))
    (f,) = (tmp_path / "w").glob("*.warc.gz")
    text = gzip.decompress(f.read_bytes()).decode()
    assert text.count("WARC/1.1\r\n") == 2 and text.endswith("\r\n\r\nx\r\n\r\n")


def test_surt():
    assert warc.surt("https://User@Blog.Example.com:443/A?b=1#c") == "com,example,blog)/A?b=1"
    assert warc.surt("http://a.org:8080") == "org,a:8080)/"


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive(df).read_all().count() == 0
    assert warc.archive(df).lookup(df, payloads=True).count() == 0


def test_repeated_rows(spark):
    rows = [(1, "http://a.b/", "x"), (1, "http://a.b/", "x"), (2, "http://a.b/", "x"), (2, "http://c.d/", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = sorted((r.page_id, r.record_type, r.refers_to or 0, r.url) for r in warc.archive(df).lookup(df).collect())
    assert out == [(1, "response", 0, "http://a.b/")] * 2 + [(2, "response", 0, "http://c.d/"), (2, "revisit", 1, "http://a.b/")]


def test_look_up_finds_keys_at_all_edges(tmp_path):
    from pyarrow import fs

    keys = ["b"] * 5 + ["c"] + ["d"] * 9 + ["f", "g"] + ["h"] * 3
    top = warc._IndexFile(fs.LocalFileSystem(), str(tmp_path / "top"), 2)
    cuts = [0, 2, 4, 11, 12, 18, len(keys)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        shard = warc._IndexFile(fs.LocalFileSystem(), str(tmp_path / str(k)), 2)
        for i in range(a, b):
            shard.add(keys[i], [keys[i], i, "f", 0, 0])
        shard.close()
        top.add(keys[a], [keys[a], keys[b - 1], str(tmp_path / str(k))])
    top.close()
    files = warc._Files("file://" + str(tmp_path))
    for key in "abcdefghi":
        hits = list(files.holding(str(tmp_path / "top"), key))
        assert len(hits) == len(set(hits))
        assert sorted(c[1] for h in hits for c in files.block(*h) if c[0] == key) == [i for i, k in enumerate(keys) if k == key]
        assert all(any(c[0] == key for c in files.block(*h)) for h in hits)
