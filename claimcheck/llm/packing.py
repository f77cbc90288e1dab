"""Token ids packed into rows of one length (operator 7).

Every text is encoded whole and closed by an end id; ids beyond the row length
are split off losslessly as further segments.  Segments are placed by
best-fit decreasing: longest first, each into the row with the least room that
still holds it, found in a segment tree over the possible amounts of room.
This runs on blocks of a fixed number of ids as they stream by, so it needs no
shuffle and a task's memory does not depend on the data.  What that costs is
the room left in the last rows of each block: rows are filled to 99.9 % where a
partition holds a thousand rows or more, to 98 % where it holds fifty.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimcheck.llm._util import prepare

VOCAB = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END, PAD = 50256, 50257  # both free in the vocabulary
CONTEXT = 2048
BLOCK_TOKENS = 1 << 21  # ids packed together: about a thousand rows


@cache
def tokenizer(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Room:
    """A segment tree over amounts of room: how many rows have each."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.count = [0] * (2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = self.base + room
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least room of at least ``need``; removes it."""
        count, i = self.count, self.base + need
        while not count[i]:
            while i & 1:  # a right child: what lies right of it is right of its parent
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.base:
            i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.base
        while i:
            count[i] -= 1
            i >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: np.ndarray, context: int) -> list[list[int]]:
    """Rows of segment numbers; no row's lengths sum to more than ``context``."""
    rows: list[list[int]] = []
    room = Room(context)
    for s in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[s])
        found = room.take(n) if n < context else None
        if found is None:
            left, row = context, len(rows)
            rows.append([])
        else:
            left, row = found
        rows[row].append(s)
        if left > n:
            room.add(left - n, row)
    return rows


SCHEMA = "pack_id string, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, piece_nos array<int>"


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", context: int = CONTEXT, vocab: str = VOCAB) -> DataFrame:
    """Packed rows: ``context`` ids and positions (little-endian uint16), segment bounds and origins.

    ``cu_seqlens`` are the cumulative segment lengths from 0 to ``n_tokens``,
    the rest of a row is PAD; positions start again at 0 in each segment;
    ``doc_ids`` and ``piece_nos`` name each segment's document and its place in
    it, so that all ids of a document can be put together again.  ``pack_id``
    names a row by its first segment, so it is unique where ids are.

    Defined cases: null and empty texts are a segment of the end id alone; a
    null id stays null and stands as "None" in ``pack_id``; repeated rows are
    packed each, and rows that share an id may share a ``pack_id``; texts of any
    length are split at every ``context`` ids; other columns are ignored; an
    empty table gives no rows.
    """
    prepare(docs.sparkSession)

    def run(batches):
        enc = tokenizer(vocab)
        ids, owner, piece, total = [], [], [], 0
        for t in batches:
            for d, text in zip(t.column(0).to_pylist(), t.column(1).to_pylist(), strict=True):
                a = np.array([*enc.encode_ordinary(text or ""), END], np.uint16)
                for k in range(0, len(a), context):
                    ids.append(a[k : k + context])
                    owner.append(d)
                    piece.append(k // context)
                total += len(a)
                if total >= BLOCK_TOKENS:
                    yield from _matrix(ids, owner, piece, context)
                    ids, owner, piece, total = [], [], [], 0
        if ids:
            yield from _matrix(ids, owner, piece, context)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def _matrix(ids, owner, piece, context):
    lengths = np.array([len(a) for a in ids])
    rows = best_fit_decreasing(lengths, context)
    for at in range(0, len(rows), 256):
        part = rows[at : at + 256]
        m = np.full((len(part), context), PAD, np.uint16)
        pos = np.zeros((len(part), context), np.uint16)
        names, used, bounds, docs, nos = [], [], [], [], []
        for r, segments in enumerate(part):
            end, cu = 0, [0]
            for s in segments:
                n = lengths[s]
                m[r, end : end + n] = ids[s]
                pos[r, end : end + n] = np.arange(n)
                end += n
                cu.append(int(end))
            names.append(f"{owner[segments[0]]}:{piece[segments[0]]}")
            used.append(int(end))
            bounds.append(cu)
            docs.append([owner[s] for s in segments])
            nos.append([piece[s] for s in segments])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names),
                pa.array(used, pa.int32()),
                pa.array([x.tobytes() for x in m], pa.binary()),
                pa.array([x.tobytes() for x in pos], pa.binary()),
                pa.array(bounds, pa.list_(pa.int32())),
                pa.array(docs, pa.list_(pa.int64())),
                pa.array(nos, pa.list_(pa.int32())),
            ],
            names=[x.split()[0] for x in SCHEMA.split(", ")],
        )


def write_packed(packed: DataFrame, path: str) -> None:
    """Writes packed rows as Parquet, a store that executors commit task by task."""
    packed.write.mode("overwrite").option("compression", "zstd").parquet(path)


def unpack(packed: DataFrame) -> DataFrame:
    """(doc_id, piece_no, ids): the segments of packed rows."""

    def run(batches):
        for t in batches:
            out = []
            for raw, cu, docs, nos in zip(*(t.column(c).to_pylist() for c in ("input_ids", "cu_seqlens", "doc_ids", "piece_nos")), strict=True):
                a = np.frombuffer(raw, "<u2")
                out += [(d, n, a[x:y].tolist()) for d, n, x, y in zip(docs, nos, cu, cu[1:], strict=False)]
            d, n, a = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(n, pa.int32()), pa.array(a, pa.list_(pa.int32()))], names=["doc_id", "piece_no", "ids"])

    return packed.select("input_ids", "cu_seqlens", "doc_ids", "piece_nos").mapInArrow(run, "doc_id long, piece_no int, ids array<int>")
