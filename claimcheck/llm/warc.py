"""WARC archives with a two-level capture index (operator 8).

Archives: one gzip member for each record, so a record can be read by its
offset and length alone.  Of pages with one payload the smallest id becomes a
response and the others revisits that name it.

Index: captures sorted by reversed-host URL key go, over the cluster, into
shard files.  A shard holds compressed blocks of captures, then its sparse
directory (first key, offset and length of each block) and a footer of fixed
size.  A file of the same form lists the shards.  Look-ups run on the executors:
keys in order go through the list of shards, the directory of a shard and a
block, each found by bisection and read by range, to the blocks that hold them;
the blocks, dealt anew so that a key of very many captures is many tasks' work,
lead to the records, which are range-read one by one.

Files are written through Arrow's file systems into one folder that all
executors share.  Each attempt of a task writes files of its own name, and only
those of the attempt that succeeded are named in its rows, which are cut off
in the shared folder at once, so a lost executor leaves stray files at most.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimcheck.llm._util import cut, new_folder, prepare

BLOCK_LINES = 256
SHARD_CAPTURES = 20_000  # captures of an index shard, about
ROLL_BYTES = 1 << 30  # an archive file is closed beyond this size
BROADCAST_DIGESTS = 200_000
LEVEL = 4
WHEN = "2024-01-01T00:00:00Z"
_FOOTER = "<8sQQ"
_MAGIC = b"CAPIDX01"


def surt(url: str | None) -> str:
    """Reversed-host key of a URL: com,example,www)/path?query, host in lower case, no scheme or fragment."""
    if not url:
        return ")/"
    try:
        u = urlsplit(url if "://" in url else "//" + url)
        host, port = (u.hostname or ""), u.port
    except ValueError:
        return ")/" + url
    port = f":{port}" if port and port not in (80, 443) else ""
    return ",".join(reversed(host.lower().split("."))) + port + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def _open_folder(uri: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    return system, path


def _line(url: str | None) -> str:
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    """An uncompressed WARC record and its bare base32 SHA-1."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{page_id}>",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Date: {WHEN}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:x-page:{refers_to}>",
            "WARC-Truncated: length",
        ]
        payload = b""
    head.append(f"Content-Length: {len(http) + len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n", digest


def parse(raw: bytes) -> dict:
    """Headers and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"fields": fields, "payload": payload, "payload_bytes": size}


def _gz(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


MANIFEST = "page_id long, key string, path string, offset long, length long"


def write_archive(pages: DataFrame, folder: str, id_col="page_id", url_col="url", html_col="html", min_revisit_bytes: int = 0) -> DataFrame:
    """Writes all pages with an id; returns where each record lies (MANIFEST)."""
    prepare(pages.sparkSession)
    base = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    ).where("page_id is not null")
    base = base.withColumn("sha", F.sha1("html"))
    same = (
        base.where(F.octet_length("html") >= min_revisit_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .where("first <> last")
        .select("sha", "first")
    )
    same = cut(same)
    on = ["sha"]
    if same.count() <= BROADCAST_DIGESTS:
        same = F.broadcast(same)
    else:  # digests meet without the payloads, which are then dealt by page, as one digest may be that of many pages
        same, on = base.select("page_id", "sha").join(same, "sha").distinct(), ["page_id", "sha"]
    refers = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    rows = base.join(same, on, "left").select("page_id", "url", "html", refers.alias("refers_to"))

    def run(batches):
        system, path = _open_folder(folder)
        name, out, at = "", None, 0
        try:
            for t in batches:
                found = []
                for page, url, html, ref in zip(*(t.column(i).to_pylist() for i in range(4)), strict=True):
                    if out is None or at > ROLL_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{path}/{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(name, compression=None)
                        at += out.write(_gz(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {WHEN}\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode()))
                    raw, _ = record(page, url, html.encode(), ref)
                    body = _gz(raw)
                    out.write(body)
                    found.append((page, surt(url), name, at, len(body)))
                    at += len(body)
                if found:
                    cols = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=[x.split()[0] for x in MANIFEST.split(", ")])
        finally:
            if out is not None:
                out.close()

    return cut(rows.mapInArrow(run, MANIFEST))


SHARDS = "path string, first_key string, last_key string, blocks long, captures long"


class _IndexFile:
    """Writes blocks of sorted lines, then the sparse directory and the footer."""

    def __init__(self, system, path: str, block_lines: int):
        self.out, self.at, self.block_lines = system.open_output_stream(path, compression=None), 0, block_lines
        self.lines: list[str] = []
        self.first, self.directory = "", []

    def add(self, key: str, line: list) -> None:
        if not self.lines:
            self.first = key
        self.lines.append(json.dumps(line, ensure_ascii=True))
        if len(self.lines) == self.block_lines:
            self._flush()

    def _flush(self) -> None:
        body = zlib.compress("\n".join(self.lines).encode(), 6)
        self.directory.append((self.first, self.at, len(body)))
        self.at += self.out.write(body)
        self.lines.clear()

    def close(self) -> None:
        if self.lines:
            self._flush()
        sparse = zlib.compress(json.dumps(self.directory).encode(), 6)
        self.out.write(sparse)
        self.out.write(struct.pack(_FOOTER, _MAGIC, self.at, len(sparse)))
        self.out.close()


def write_index(manifest: DataFrame, folder: str) -> DataFrame:
    """Sorts captures by key over the cluster into shard files; returns a row for each shard (SHARDS)."""
    captures = manifest.count()
    shards = max(1, -(-captures // SHARD_CAPTURES))

    def run(batches):
        system, path = _open_folder(folder)
        name, out = f"{path}/{uuid.uuid4().hex}.cdx", None
        first, last, total = "", "", 0
        for t in batches:
            for page, key, file, offset, length in zip(*(t.column(i).to_pylist() for i in range(5)), strict=True):
                if out is None:
                    out, first = _IndexFile(system, name, BLOCK_LINES), key
                out.add(key, [key, page, file, offset, length])
                last, total = key, total + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "first_key": [first], "last_key": [last], "blocks": [len(out.directory)], "captures": [total]})

    ordered = manifest.repartitionByRange(shards, "key", "page_id").sortWithinPartitions("key", "page_id")
    return cut(ordered.select("page_id", "key", "path", "offset", "length").mapInArrow(run, SHARDS))


def write_shard_list(shards: DataFrame, folder: str) -> str | None:
    """Writes the shards in order of their keys as an index file of its own, in one task (a line for about SHARD_CAPTURES captures)."""

    def run(batches):
        system, path = _open_folder(folder)
        name, out = f"{path}/{uuid.uuid4().hex}.top", None
        for t in batches:
            for row in zip(*(t.column(i).to_pylist() for i in range(3)), strict=True):
                out = out or _IndexFile(system, name, BLOCK_LINES)
                out.add(row[0], list(row))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name]})

    ordered = shards.select("first_key", "last_key", "path").repartition(1).sortWithinPartitions("first_key", "last_key")
    row = cut(ordered.mapInArrow(run, "path string")).first()
    return row.path if row else None


def _may_hold(directory: list[list], key: str) -> range:
    """Numbers of the blocks that may hold the key: from the last that begins before it to the last that begins with it."""
    return range(max(0, bisect_left(directory, key, key=lambda b: b[0]) - 1), bisect_right(directory, key, key=lambda b: b[0]))


class _Files:
    """Range reads, with the files that are in use kept open and what was read last kept."""

    def __init__(self, folder: str):
        self.system, _ = _open_folder(folder)
        self.open: dict[str, pa.NativeFile] = {}
        self.kept: OrderedDict = OrderedDict()

    def read(self, path: str, offset: int, length: int) -> bytes:
        f = self.open.get(path)
        if f is None:
            if len(self.open) >= 64:
                self.open.pop(next(iter(self.open))).close()
            f = self.open[path] = self.system.open_input_file(path)
        return f.read_at(length, offset)

    def _keep(self, key, make):
        if key in self.kept:
            self.kept.move_to_end(key)
        else:
            if len(self.kept) >= 16:
                self.kept.popitem(last=False)
            self.kept[key] = make()
        return self.kept[key]

    def directory(self, path: str) -> list[list]:
        """(first key, offset, length) of an index file's blocks, from its end."""

        def make():
            size = self.system.get_file_info(path).size
            magic, at, n = struct.unpack(_FOOTER, self.read(path, size - struct.calcsize(_FOOTER), struct.calcsize(_FOOTER)))
            if magic != _MAGIC:
                raise ValueError(f"{path} is not an index file")
            return json.loads(zlib.decompress(self.read(path, at, n)))

        return self._keep(path, make)

    def block(self, path: str, offset: int, length: int) -> list[list]:
        """The lines of a block: (key, page, file, offset, length) of captures, (first key, last key, path) of shards."""
        return self._keep((path, offset), lambda: [json.loads(x) for x in zlib.decompress(self.read(path, offset, length)).decode().split("\n")])

    def holding(self, top: str, key: str):
        """(shard, offset, length) of the blocks that hold captures of a key, by two bisections."""
        tops = self.directory(top)
        for i in _may_hold(tops, key):
            for first, last, shard in self.block(top, *tops[i][1:]):
                if not first <= key <= last:
                    continue
                sparse = self.directory(shard)
                for j in _may_hold(sparse, key):
                    begins, offset, length = sparse[j]
                    lines = None if begins == key else self.block(shard, offset, length)
                    if lines is None or lines[min(bisect_left(lines, key, key=lambda x: x[0]), len(lines) - 1)][0] == key:
                        yield shard, offset, length

    def record(self, path: str, offset: int, length: int) -> dict:
        return parse(zlib.decompress(self.read(path, offset, length), 31))


def _read_back(files: _Files, captures: list[list], payloads: bool = False) -> pa.RecordBatch:
    """READ rows of captures, each record range-read and held against its headers; with the payloads if asked."""
    rows = []
    for _, page, path, at, n in sorted(captures, key=lambda c: (c[2], c[3])):
        r = files.record(path, at, n)
        kind, digest = r["fields"]["WARC-Type"], r["fields"]["WARC-Payload-Digest"].removeprefix("sha1:")
        if r["fields"]["WARC-Record-ID"] != f"<urn:x-page:{page}>":
            raise ValueError(f"{path}@{at} is not page {page}")
        ref = None
        if kind == "response":
            if base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode() != digest or len(r["payload"]) != r["payload_bytes"]:
                raise ValueError(f"{path}@{at} is damaged")
        else:
            ref = int(r["fields"]["WARC-Refers-To"][len("<urn:x-page:") : -1])
        rows.append((page, r["payload_bytes"], digest, kind, ref, r["fields"]["WARC-Target-URI"], r["payload"] if payloads and kind == "response" else None))
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in f"{READ}, payload".split(", ")])
    return out if payloads else out.select(range(len(kinds) - 1))


HITS = "path string, offset long, length long, key string"


@dataclass
class Archive:
    """Written archives and their index."""

    spark: SparkSession
    folder: str
    shards: DataFrame
    top: str | None

    def lookup(self, urls: DataFrame, url_col: str = "url", payloads: bool = False) -> DataFrame:
        """A row (READ) for each capture whose key is that of one of the URLs; a URL without captures gives none.

        ``payloads`` adds the responses' bytes as a column, null for revisits.
        Repeated URLs and URLs of one key count once; a null or empty one has
        the key ")/".
        """
        schema = f"{READ}, payload binary" if payloads else READ
        if self.top is None:
            return self.spark.createDataFrame([], schema)
        folder, top = self.folder, self.top

        def keys(batches):
            for t in batches:
                yield pa.RecordBatch.from_pydict({"key": pa.array([surt(u) for u in t.column(0).to_pylist()], pa.string())})

        def blocks(batches):
            files = _Files(folder)
            for t in batches:
                found = [(*hit, key) for key in t.column(0).to_pylist() for hit in files.holding(top, key)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["path", "offset", "length", "key"])

        def records(batches):
            files, now, wanted = _Files(folder), None, set()

            def of():
                captures = [c for c in files.block(*now) if c[0] in wanted]
                return [_read_back(files, captures, payloads)] if captures else []

            for t in batches:
                for *block, key in zip(*(t.column(i).to_pylist() for i in range(4)), strict=True):
                    if block != now:
                        if now:
                            yield from of()
                        now, wanted = block, set()
                    wanted.add(key)
            if now:
                yield from of()

        asked = urls.select(F.col(f"`{url_col}`").cast("string")).distinct().mapInArrow(keys, "key string").distinct()
        hits = cut(asked.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(blocks, HITS))
        tasks = max(1, -(-hits.select("path", "offset").distinct().count() // 8))
        return hits.repartition(tasks, "path", "offset").sortWithinPartitions("path", "offset").mapInArrow(records, schema)

    def read_all(self) -> DataFrame:
        """A row (READ) for each record, by way of all index blocks."""
        folder = self.folder

        def blocks(batches):
            files = _Files(folder)
            for t in batches:
                for shard in t.column("path").to_pylist():
                    d = files.directory(shard)
                    yield pa.RecordBatch.from_arrays([pa.array([shard] * len(d)), pa.array([x[1] for x in d], pa.int64()), pa.array([x[2] for x in d], pa.int64())], names=["path", "offset", "length"])

        def records(batches):
            files = _Files(folder)
            for t in batches:
                for block in zip(*(t.column(i).to_pylist() for i in range(3)), strict=True):
                    yield _read_back(files, files.block(*block))

        listed = cut(self.shards.select("path").mapInArrow(blocks, "path string, offset long, length long"))
        tasks = max(1, -(-listed.count() // 8))
        return listed.repartition(tasks, "path", "offset").mapInArrow(records, READ)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def archive(pages: DataFrame, folder: str | None = None, id_col="page_id", url_col="url", html_col="html", min_revisit_bytes: int = 0) -> Archive:
    """Writes archives and index of ``pages`` into ``folder`` (a URI; by default a new one in the shared folder).

    Defined cases: null html is an empty payload; a null or empty URL has the
    key ")/"; rows with a null id are not written; rows that repeat the id of a
    response are responses too (a page id is looked up by its URL, so rows that
    share an id stay apart); line breaks in URLs are percent-encoded; payloads
    below ``min_revisit_bytes`` are responses always; other columns are ignored;
    an empty table gives no files.
    """
    spark = prepare(pages.sparkSession)
    folder = folder or new_folder(spark, "warc")
    manifest = write_archive(pages, folder, id_col, url_col, html_col, min_revisit_bytes)
    shards = write_index(manifest, folder)
    return Archive(spark, folder, shards, write_shard_list(shards, folder))
