"""Nearest neighbours by NN-descent and greedy graph search (operator 10).

Index: every distinct vector becomes a node of one of several shards of equal
size, dealt by a hash.  In a shard each node has its K nearest found so far.
The first lists come from blocks of nodes on the same sides of random
projections.  Then each round joins the neighbours of neighbours: a node's list
and the nodes that list it meet in one group, the pairs of that group in which
one is new are measured, and whoever is nearer than the worst of a list enters
it.

Search: a query is put to every shard.  It starts at its own node, if that is
there, and at a few fixed nodes.  Each round measures the neighbours of the best
unexpanded nodes of its beam and keeps the best, until the beam is expanded.
The beam's best are measured again on the original vectors in double precision;
the best of all shards are the result, copies of a vector as rows of their own.

A shard is a task's numpy arrays, so that neither its rounds nor a search's pass
through a shuffle; vectors are dealt out once for the graph and once for all
searches.  Nothing is broadcast but counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimcheck.llm._util import cut, giving_back, prepare
from claimcheck.llm._vectors import as_double, matrix, usable

K = 32  # neighbours a node keeps
REVERSE = 24  # nearest of the nodes that list a node, in the join of neighbours
GRAPH_REVERSE = 48  # the same, in the searched graph
BLOCK = 500  # nodes of a first block at most
SEEDS = 3  # first blockings
ROUNDS = 5
BEAM, EXPAND, RERANK = 160, 8, 128
ENTRIES = 32  # nodes where every query starts beside its own
SHARD = 25_000  # nodes of a shard, about: what a task holds
SPREAD, FEWEST = 12, 2_000  # so many shards even of fewer nodes, but of so many nodes each
GROUPS, MERGED, ASKED = 256, 2_048, 128  # groups joined, groups merged and queries searched at once


def shards_for(n: int) -> int:
    return max(1, -(-n // SHARD), min(SPREAD, n // FEWEST))


def pack(x: np.ndarray) -> list[bytes]:
    """Rows of doubles as bytes, each exactly: as floats where these are the same."""
    with np.errstate(over="ignore"):
        f = x.astype(np.float32)
    same = (f.astype(np.float64) == x).all(axis=1)
    return [a.tobytes() if ok else b.tobytes() for a, b, ok in zip(f, x, same, strict=True)]


def unpack(raw: list[bytes], dim: int) -> np.ndarray:
    """Rows of doubles of ``pack``."""
    if all(len(r) == 4 * dim for r in raw):
        return np.frombuffer(b"".join(raw), np.float32).reshape(-1, dim).astype(np.float64)
    return np.stack([np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64).astype(np.float64) for r in raw])


def _largest(x: np.ndarray) -> float:
    """By what a shard's vectors are divided, so that floats hold their squares."""
    return float(np.abs(x).max())


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances between rows, of single matrices or of stacks."""
    return np.maximum((x * x).sum(axis=-1)[..., :, None] + (y * y).sum(axis=-1)[..., None, :] - 2 * x @ np.swapaxes(y, -1, -2), 0)


def _places(keys: np.ndarray) -> np.ndarray:
    """The place of each element in its run of equal keys, from 0."""
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    start = np.flatnonzero(first)
    return np.arange(len(keys)) - np.repeat(start, np.diff(np.append(start, len(keys))))


def _nearest_of(k: int, ids: np.ndarray, ds: np.ndarray, fresh: np.ndarray):
    """The k nearest of each row, repeated ids and those under 0 left out; of equal ids the first stays."""
    o = np.argsort(ids, axis=1, kind="stable")
    i = np.take_along_axis(ids, o, 1)
    d, f = np.take_along_axis(ds, o, 1), np.take_along_axis(fresh, o, 1)
    out = i < 0
    out[:, 1:] |= i[:, 1:] == i[:, :-1]
    d = np.where(out, np.float32(np.inf), d)
    o = np.argsort(d, axis=1, kind="stable")[:, :k]
    i, d, f = (np.take_along_axis(a, o, 1) for a in (i, d, f))
    none = np.isinf(d)
    return np.where(none, -1, i), d, f & ~none


def _blocks(x: np.ndarray, block: int, rng: np.random.Generator):
    """Nodes split in halves by random projections until a part has at most ``block``."""
    todo = [np.arange(len(x))]
    while todo:
        part = todo.pop()
        if len(part) <= block:
            yield part
            continue
        o = np.argpartition(x[part] @ rng.normal(size=x.shape[1]).astype(np.float32), len(part) // 2)
        todo += [part[o[: len(part) // 2]], part[o[len(part) // 2 :]]]


def _reversed(ids: np.ndarray, ds: np.ndarray, fresh: np.ndarray, most: int):
    """Of each node the nearest of the nodes that list it, and whether that is new."""
    u, j = np.nonzero(ids >= 0)
    v, d = ids[u, j], ds[u, j]
    o = np.lexsort((u, d, v))
    u, v, f = u[o], v[o], fresh[u, j][o]
    at = _places(v)
    keep = at < most
    back, new = np.full((len(ids), most), -1, np.int32), np.zeros((len(ids), most), bool)
    back[v[keep], at[keep]], new[v[keep], at[keep]] = u[keep], f[keep]
    return back, new


def descend(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """The graph of a shard: each node's list and those that list it, -1 where there are fewer."""
    n = len(x)
    ids, ds, fresh = np.full((n, k), -1, np.int32), np.full((n, k), np.inf, np.float32), np.zeros((n, k), bool)
    for s in range(SEEDS if n > BLOCK else 1):
        for part in _blocks(x, BLOCK, np.random.default_rng(100 + s)):
            d = distances(x[part], x[part])
            np.fill_diagonal(d, np.inf)
            m = min(k, len(part) - 1)
            if m:
                j = np.argpartition(d, m - 1, axis=1)[:, :m]
                near = np.concatenate((ids[part], part[j].astype(np.int32)), axis=1), np.concatenate((ds[part], np.take_along_axis(d, j, 1)), axis=1)
                ids[part], ds[part], fresh[part] = _nearest_of(k, *near, np.ones(near[0].shape, bool))
    for _ in range(rounds if n > BLOCK else 0):
        back, back_new = _reversed(ids, ds, fresh, REVERSE)
        group, new = np.concatenate((ids, back), axis=1), np.concatenate((fresh, back_new), axis=1)
        busy = np.flatnonzero(new.any(axis=1))
        fresh = np.zeros((n, k), bool)
        for a in range(0, len(busy), MERGED):
            sent = []
            for b in range(a, min(a + MERGED, len(busy)), GROUPS):
                g = group[busy[b : min(b + GROUPS, a + MERGED)]]
                f = new[busy[b : min(b + GROUPS, a + MERGED)]]
                y = x[g]
                d = distances(y, y)
                there = g >= 0
                ok = (d < np.where(there, ds[g, -1], 0)[:, :, None]) & (f[:, :, None] | f[:, None, :]) & there[:, None, :] & (g[:, :, None] != g[:, None, :])
                at, i, j = np.nonzero(ok)
                sent.append((g[at, i], g[at, j], d[at, i, j]))
            u, v, d = (np.concatenate(c) for c in zip(*sent, strict=True))
            o = np.lexsort((v, u))
            u, v, d = u[o], v[o], d[o]
            one = np.ones(len(u), bool)  # a pair met in several groups is sent once
            one[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
            u, v, d = u[one], v[one], d[one]
            o = np.lexsort((d, u))
            u, v, d = u[o], v[o], d[o]
            at = _places(u)
            u, v, d, at = (c[at < k] for c in (u, v, d, at))
            if len(u):
                to, row = np.unique(u, return_inverse=True)
                more, far = np.full((len(to), k), -1, np.int32), np.full((len(to), k), np.inf, np.float32)
                more[row, at], far[row, at] = v, d
                both = [np.concatenate(c, axis=1) for c in ((ids[to], more), (ds[to], far), (fresh[to], np.ones(more.shape, bool)))]
                ids[to], ds[to], fresh[to] = _nearest_of(k, *both)
        if fresh.sum() <= 0.01 * n * k:
            break
    return np.concatenate((ids, _reversed(ids, ds, fresh, GRAPH_REVERSE)[0]), axis=1)


def walk(x: np.ndarray, near: np.ndarray, asked: np.ndarray, own: np.ndarray, beam: int, expand: int) -> np.ndarray:
    """The beams of queries after a greedy search of a shard's graph, nearest first, -1 where there are fewer.

    ``own``: a query's own node, or -1.
    """
    n, beam = len(x), min(beam, len(x))
    some = np.random.default_rng(7).choice(n, min(ENTRIES, n), replace=False)
    norms, out = (x * x).sum(axis=1), np.full((len(asked), beam), -1, np.int64)
    live, q = np.arange(len(asked)), asked
    ids, ds, done = np.full((len(q), beam), -1, np.int64), np.full((len(q), beam), np.inf, np.float32), np.ones((len(q), beam), bool)
    seen = np.zeros((len(q), n), bool)
    cand = np.concatenate((own[:, None], np.broadcast_to(some, (len(q), len(some)))), axis=1)
    while True:
        cand = np.sort(cand, axis=1)
        new = cand >= 0
        new[:, 1:] &= cand[:, 1:] != cand[:, :-1]
        r, c = np.nonzero(new)
        v = cand[r, c]
        ok = ~seen[live[r], v]
        r, c, v = r[ok], c[ok], v[ok]
        seen[live[r], v] = True
        d = np.full(cand.shape, np.inf, np.float32)
        d[r, c] = norms[v] - 2 * np.einsum("ij,ij->i", x[v], q[r])  # the query's own square is the same for all
        ids, ds = np.concatenate((ids, cand), axis=1), np.concatenate((ds, d), axis=1)
        done = np.concatenate((done, np.isinf(d)), axis=1)
        o = np.argpartition(ds, beam - 1, axis=1)[:, :beam]
        o = np.take_along_axis(o, np.argsort(np.take_along_axis(ds, o, 1), axis=1, kind="stable"), 1)
        ids, ds, done = (np.take_along_axis(a, o, 1) for a in (ids, ds, done))
        out[live] = np.where(np.isinf(ds), -1, ids)
        left = ~done.all(axis=1)
        if not left.any():
            return out
        live, q, ids, ds, done = live[left], q[left], ids[left], ds[left], done[left]
        place = np.cumsum(~done, axis=1)
        r, c = np.nonzero(~done & (place <= expand))
        front = np.full((len(live), expand), -1, np.int64)
        front[r, place[r, c] - 1] = ids[r, c]
        done[r, c] = True
        cand = np.where(front[:, :, None] >= 0, near[front], -1).reshape(len(live), -1)


def _whole(batches, names: list[str]):
    """The tables of a task's shards, from batches sorted by shard."""
    kept: list[pa.Table] = []
    for t in batches:
        t = pa.Table.from_batches([t]).select(names)
        while t.num_rows:
            s = t.column("shard").to_numpy()
            if kept and kept[0].column("shard")[0].as_py() != s[0]:
                yield pa.concat_tables(kept)
                kept = []
            same = int(np.searchsorted(s, s[0], side="right"))
            kept.append(t.slice(0, same))
            t = t.slice(same)
    if kept:
        yield pa.concat_tables(kept)


class Index:
    """Nodes with their vectors, their copies and their graph."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, rounds: int = ROUNDS, copies: int = 11):
        """Builds the graph over all usable vectors of the most frequent length.

        ``copies``: how many of a vector's rows, smallest ids first, a search can return.
        """
        spark = prepare(vectors.sparkSession)
        rows = vectors.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("id"), as_double(vectors, vec_col).alias("vec"))
        rows = rows.where(usable(F.col("vec")))
        lengths = rows.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
        self.spark, self.dim = spark, lengths[0].dim if lengths else 0
        rows = rows.where(F.size("vec") == self.dim).withColumn("h", F.xxhash64(F.transform("vec", lambda x: x + 0.0)))
        self.rows = cut(rows)
        classes = self.rows.select("h", "vec").distinct()
        self.exact = cut(classes.withColumn("rep", F.monotonically_increasing_id()))  # which also fixes the numbers
        w = Window.partitionBy("rep").orderBy("id")
        member = self.rows.join(self.exact, ["h", "vec"]).select("rep", "id")
        self.members = member.withColumn("r", F.row_number().over(w)).where(F.col("r") <= copies).select("rep", "id")
        self.size = self.exact.count()
        self.shards = shards_for(self.size)
        shards, dim = self.shards, self.dim

        def packed(batches):
            for t in batches:
                yield pa.RecordBatch.from_arrays([t.column("rep"), pa.array(pack(matrix(t.column("vec"))), pa.binary())], names=["rep", "raw"])

        def build(batches):
            for t in _whole(batches, ["shard", "rep", "raw"]):
                x = unpack(t.column("raw").to_pylist(), dim)
                near = descend((x / _largest(x)).astype(np.float32), k, rounds)
                for a in range(0, len(x), 1000):
                    part = t.slice(a, 1000).combine_chunks()
                    lists = pa.array([g.tobytes() for g in near[a : a + 1000]], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column(c).combine_chunks() for c in ("shard", "rep", "raw")] + [lists], names=["shard", "rep", "raw", "near"])

        nodes = self.exact.select("rep", "vec").mapInArrow(packed, "rep long, raw binary")
        nodes = nodes.select(F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int").alias("shard"), "rep", "raw")
        nodes = nodes.repartitionById(shards, "shard").sortWithinPartitions("shard", "rep")
        self.graph = cut(nodes.mapInArrow(giving_back(build), "shard int, rep long, raw binary, near binary"))

    def search(self, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = 10, beam: int | None = None, expand: int = EXPAND) -> DataFrame:
        """(query_id, rank, vec_id, score): the nearest found of each usable query, its own id left out."""
        beam = max(beam or BEAM, 2 * top)
        q = queries.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("q"), as_double(queries, vec_col).alias("vec"))
        q = q.where(usable(F.col("vec")) & (F.size("vec") == self.dim)).groupBy("q").agg(F.min("vec").alias("vec"))
        q = q.withColumn("h", F.xxhash64(F.transform("vec", lambda x: x + 0.0)))
        q = q.join(self.exact.select("h", "vec", "rep"), ["h", "vec"], "left").select("q", "rep", "vec")
        shards, dim = self.shards, self.dim

        def packed(batches):
            for t in batches:
                yield pa.RecordBatch.from_arrays([t.column("q"), t.column("rep"), pa.array(pack(matrix(t.column("vec"))), pa.binary())], names=["q", "rep", "raw"])

        asked = q.mapInArrow(packed, "q long, rep long, raw binary")
        asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "q", "rep", "raw")
        rows = self.graph.select("shard", F.lit(None).cast("long").alias("q"), "rep", "raw", "near").unionByName(asked, allowMissingColumns=True)

        def find(batches):
            for t in _whole(batches, ["shard", "q", "rep", "raw", "near"]):
                n = t.column("q").null_count  # nodes come first
                if n in (0, t.num_rows):
                    continue
                rep = t.column("rep").slice(0, n).to_numpy()
                x = unpack(t.column("raw").slice(0, n).to_pylist(), dim)
                near = np.frombuffer(b"".join(t.column("near").slice(0, n).to_pylist()), np.int32).reshape(n, -1)
                ids = t.column("q").slice(n).to_numpy()
                first = t.column("rep").slice(n).fill_null(-1).to_numpy()
                raw, most = t.column("raw").slice(n).to_pylist(), _largest(x)
                small, at = (x / most).astype(np.float32), np.minimum(np.searchsorted(rep, first), n - 1)
                own = np.where(rep[at] == first, at, -1)
                for a in range(0, len(ids), ASKED):
                    v = unpack(raw[a : a + ASKED], dim)
                    best = walk(small, near, (v / most).astype(np.float32), own[a : a + ASKED], beam, expand)[:, : 2 * top]
                    r, c = np.nonzero(best >= 0)
                    d = x[best[r, c]] - v[r]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a + r]), pa.array(rep[best[r, c]]), pa.array(np.sqrt((d * d).sum(axis=1)))], names=["q", "rep", "score"])

        scored = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", F.col("q").asc_nulls_first(), "rep").mapInArrow(giving_back(find), "q long, rep long, score double")
        near = Window.partitionBy("q").orderBy("score", "rep")
        scored = scored.withColumn("r", F.row_number().over(near)).where(F.col("r") <= RERANK).drop("r")
        w = Window.partitionBy("query_id").orderBy("score", "vec_id")
        out = scored.join(self.members, "rep").where("id <> q").select(F.col("q").alias("query_id"), F.col("id").alias("vec_id"), "score")
        return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    top: int = 10,
    k: int = K,
    rounds: int = ROUNDS,
    beam: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` nearest found among ``vectors``, by Euclidean distance.

    Ties go to the smaller id; a query does not find its own id; with fewer
    candidates all are returned.

    Defined cases: vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do those of another length than the
    most frequent; null ids take no part; of rows with one id and several
    vectors a query takes the smallest, while all are searched; exact copies
    are one node and come back as rows, smallest ids first; other columns are ignored; empty tables give
    no rows.
    """
    return Index(vectors, id_col, vec_col, k, rounds, top + 1).search(queries, id_col, vec_col, top, beam)
