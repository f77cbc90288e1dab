"""Near-duplicate embeddings by a forest of random-projection trees (operator 4).

Vectors are compared within a label.  Each tree splits a label's vectors again
and again at the median of a random direction; vectors near the median go to
both sides, so that a close pair is seldom parted, and several trees make it
all but certain that some leaf holds it.  Within a leaf all pairs are compared
by cosine in double precision, and only verified pairs count.  A node that is
already dense with links, or that the spill band would hardly make smaller, is
not split but compared whole, in blocks; the band is never cut.  Of such a node
links are counted and a spanning forest is kept, never the links themselves; a
pair in several such nodes counts in the first.

Exact copies form classes first: one vector stands for them, and the number of
copies enters the counts, so a vector repeated a million times costs one row.
A label that a task can hold is done there with all its trees and gives one
count a row and a spanning forest.  A larger one is split over the cluster by
the same rule, at medians that Spark computes, until its parts fit.  A node
there that is not to be split is compared as pairs of blocks dealt over the
cluster.  The parts are split twice: first to know all nodes that are compared
whole, in whatever tree, and then to compare, so that the links of small leaves,
which the parts return, leave out what a whole node counts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimcheck.llm._util import components, cut, prepare, spread
from claimcheck.llm._vectors import as_double, matrix, usable

THRESHOLD = 0.93
TREES = 10
LEAF = 200
PART = 20_000  # vectors that one task splits and compares at most
SPILL = 0.65  # half width of the spill band, in standard deviations of a threshold pair's difference
BLOCK = 1024
WIDEST = 0.65  # largest share of a node that a side may hold: larger sides save little over comparing the node whole
NODE = ["grp", "tree", "path"]
TASK = [*NODE, "x", "y"]


def _direction(dim: int, *seed: int) -> np.ndarray:
    v = np.random.default_rng([x & 0x7FFFFFFF for x in seed]).normal(size=dim)
    return v / np.linalg.norm(v)


def band(threshold: float, dim: int) -> float:
    """Half width of the spill band for unit vectors."""
    return SPILL * (2 * (1 - threshold) / dim) ** 0.5


def _dense(u: np.ndarray, threshold: float, rng) -> bool:
    """Whether a fifth of a node's pairs, judged by sixty-four of its rows, are links."""
    s = u[rng.choice(len(u), min(64, len(u)), replace=False)]
    g = s @ s.T
    n = len(s)
    return (np.count_nonzero(g >= threshold) - n) >= 0.2 * n * (n - 1)


def leaves(u: np.ndarray, threshold: float, tree: int, leaf: int = LEAF):
    """(index array, whether it is more than a leaf and compared whole) of the ends of one tree over unit vectors."""
    rng = np.random.default_rng(tree + 17)
    width = band(threshold, u.shape[1])
    stack = [np.arange(len(u))]
    while stack:
        at = stack.pop()
        if len(at) <= leaf:
            yield at, False
            continue
        if _dense(u[at], threshold, rng):
            yield at, True
            continue
        p = u[at] @ _direction(u.shape[1], tree, int(rng.integers(2**31)))
        mid = np.median(p)
        left, right = p <= mid + width, p >= mid - width
        if max(left.sum(), right.sum()) > WIDEST * len(at):
            yield at, True
            continue
        stack += [at[left], at[right]]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None] if len(x) else x


def ends(x: np.ndarray, threshold: float, trees: range, leaf: int = LEAF):
    """(leaves, nodes compared whole) of the trees, without nodes that lie in an earlier one."""
    small, whole = [], []
    u = unit(x)
    inside = np.zeros((len(x), 0), bool)
    for tree in trees:
        for at, more in leaves(u, threshold, tree, leaf):
            if not more:
                small.append(at)
            elif not inside[at].all(axis=0).any():
                own = np.zeros((len(x), 1), bool)
                own[at] = True
                inside = np.concatenate((inside, own), axis=1)
                whole.append(at)
        if any(len(at) == len(x) for at in whole):  # nothing is left to find
            return [], [at for at in whole if len(at) == len(x)]
    return small, whole


def leaf_links(x: np.ndarray, threshold: float, small: list[np.ndarray], within: np.ndarray) -> np.ndarray:
    """Pairs (i < j) of rows of the leaves with cosine >= threshold that share no column of ``within``."""
    n = len(x)
    norm = np.sqrt((x * x).sum(axis=1))
    found: list[np.ndarray] = []
    held = 0
    for at in small:
        c = (x[at] @ x[at].T) / (norm[at][:, None] * norm[at][None])
        r, s = np.nonzero(np.triu(c >= threshold, 1))
        p, q = np.minimum(at[r], at[s]), np.maximum(at[r], at[s])
        if within.shape[1] and len(p):
            apart = ~(within[p] & within[q]).any(axis=1)
            p, q = p[apart], q[apart]
        found.append(p * n + q)
        held += len(p)
        if held > 1 << 22:
            found = [np.unique(np.concatenate(found))]
            held = len(found[0])
    codes = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return np.stack([codes // n, codes % n], axis=1) if n else np.zeros((0, 2), np.int64)


def _columns(within: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The columns that a row of ``at`` is in, as numbers for ``count_links``."""
    w = within[at]
    return w[:, w.any(axis=0)].astype(np.float32)


def _root(name: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names with those that the edges (a, b) join made one, the smallest."""
    while True:
        x, y = name[a], name[b]
        if (x == y).all():
            return name
        low, high = np.minimum(x, y), np.maximum(x, y)
        up = np.arange(len(name))
        np.minimum.at(up, high, low)
        while (up[up] != up).any():
            up = up[up]
        name = up[name]


def links_within(x: np.ndarray, copies: np.ndarray, threshold: float, trees: range, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(copies of the rows linked to each row, the first row of its component) as found by the trees."""
    n = len(x)
    small, whole = ends(x, threshold, trees, leaf)
    within = np.zeros((n, len(whole)), bool)
    counts, name = np.zeros(n, np.int64), np.arange(n)
    for i, at in enumerate(whole):
        w = _columns(within, at)
        k, _, edges = count_links(x[at], None, copies[at], None, w, None, threshold)
        counts[at] += k
        if edges:
            e = at[np.array(edges)]
            name = _root(name, e[:, 0], e[:, 1])
        within[at, i] = True
    p = leaf_links(x, threshold, small, within)
    np.add.at(counts, p[:, 0], copies[p[:, 1]])
    np.add.at(counts, p[:, 1], copies[p[:, 0]])
    return counts, _root(name, p[:, 0], p[:, 1])


def count_links(x, y, cx, cy, wx, wy, threshold: float):
    """(counts of x, counts of y, tree edges) of all pairs of the rows of two blocks; y None: of the rows of one.

    A row counts the copies of each row it links to, unless the pair shares a
    column of ``wx`` and ``wy``.  The edges join the rows as all links do.
    """
    one = y is None
    if one:
        y, cy, wy = x, cx, wx
    n, m = len(x), len(y)
    nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    kx, ky = np.zeros(n, np.int64), np.zeros(m, np.int64)
    name = np.arange(n if one else n + m)
    edges = []
    for i in range(0, n, BLOCK):
        for j in range(i if one else 0, m, BLOCK):
            a, b = slice(i, i + BLOCK), slice(j, j + BLOCK)
            hit = (x[a] @ y[b].T) / (nx[a][:, None] * ny[b][None]) >= threshold
            mirror = one and i == j
            if mirror:
                np.fill_diagonal(hit, False)
            shift = j if one else n + j
            while True:
                apart = hit & (name[i : i + hit.shape[0]][:, None] != name[shift : shift + hit.shape[1]][None])
                r, s = np.flatnonzero(apart.any(axis=1)), np.flatnonzero(apart.any(axis=0))
                if not len(r):
                    break
                # each row to its first link and each column to its first
                p = np.concatenate((r, apart[:, s].argmax(axis=0))) + i
                q = np.concatenate((apart[r].argmax(axis=1), s)) + shift
                for a1, b1 in zip(p.tolist(), q.tolist(), strict=True):
                    if name[a1] != name[b1]:
                        name[name == name[b1]] = name[a1]
                        edges.append((a1, b1))
            if wx.shape[1]:
                hit &= (wx[a] @ wy[b].T) < 0.5
            kx[a] += hit @ cy[b]
            if not mirror:
                ky[b] += hit.T @ cx[a]
    return (kx + ky, None, edges) if one else (kx, ky, edges)


def _dense_nodes(rows: DataFrame, n: DataFrame, threshold: float) -> DataFrame:
    """The dense ones of the nodes of ``n``, judged by about sixty-four hashed rows of each."""
    taken = rows.join(n, NODE).where(F.pmod(F.xxhash64("rep", "tree", "path"), F.col("n")) < 64)
    taken = taken.groupBy(*NODE).agg(F.collect_list("vec").alias("vecs"))

    def run(batches):
        for t in batches:
            keep = []
            for vecs in t.column("vecs"):
                keep.append(_dense(unit(matrix(vecs.values)), threshold, np.random.default_rng(17)))
            yield pa.RecordBatch.from_arrays([t.column(c) for c in NODE], names=NODE).filter(pa.array(keep, pa.bool_()))

    return taken.mapInArrow(run, "grp string, tree int, path long")


def _node_id(tree: int, path: int, k: int) -> int:
    """A number of the k-th node of a part that is compared whole."""
    return int.from_bytes(hashlib.blake2b(f"{tree}:{path}:{k}".encode(), digest_size=8).digest(), "big", signed=True)


def _tasks(batches):
    """(key, batch of all its rows) of the tasks, from batches sorted by TASK."""
    held, now = [], None
    for t in batches:
        keys = list(zip(*(t.column(c).to_pylist() for c in TASK), strict=True))
        starts = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]] + [len(keys)]
        for a, b in zip(starts, starts[1:], strict=False):
            if a == b:
                continue
            if held and keys[a] != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = keys[a]
            held.append(t.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def _parts(reps: DataFrame, threshold: float, trees: int, part: int, leaf: int) -> DataFrame:
    """Rows (grp, tree, path, x, y, at, wid, w, rep, copies, vec) of the tasks (grp, tree, path, x, y).

    x = -1: a part of at most ``part`` rows, split over the cluster where need
    be; tree -1 there is a group that fits as a whole, for all trees at once.
    x >= 0: the blocks x and y (``at`` names the row's) of a node ``wid`` that
    is compared whole.  ``w`` holds all such nodes that the row is in, those
    within parts too.
    """
    cols = ["rep", "copies", "vec"]
    size = reps.groupBy("grp").agg(F.count("*").alias("n"))
    sized = reps.join(size, "grp")
    fits = sized.where(F.col("n") <= part).select("grp", F.lit(-1).alias("tree"), F.lit(0).cast("long").alias("path"), *cols)
    none = F.lit(-1)
    plain = lambda df, w: df.select(*NODE, none.alias("x"), none.alias("y"), none.alias("at"), F.lit(0).cast("long").alias("wid"), w.alias("w"), *cols)
    if size.where(F.col("n") > part).limit(1).count() == 0:
        return plain(fits, F.array().cast("array<long>"))
    todo = sized.where(F.col("n") > part).select(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(1).cast("long").alias("path"), *cols
    )

    def project(batches):
        for t in batches:
            u = unit(matrix(t.column("vec")))
            tree, path = (t.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "path"))
            p = np.zeros(len(u))
            for s, w in set(zip(tree.tolist(), path.tolist(), strict=True)):
                m = (tree == s) & (path == w)
                p[m] = u[m] @ _direction(u.shape[1], 7, s, w, w >> 31)
            yield pa.RecordBatch.from_arrays([*t.columns, pa.array(p)], names=[*t.schema.names, "p"])

    done, whole = todo.limit(0), todo.limit(0).withColumn("n", F.lit(0).cast("long"))
    level = 0
    while True:
        level += 1
        placed = cut(todo.mapInArrow(project, "grp string, tree int, path long, rep long, copies long, vec array<double>, p double"))
        cuts = placed.groupBy(*NODE).agg(F.percentile_approx("p", 0.5, 1000).alias("mid"), F.avg(F.size("vec")).alias("dim"))
        width = F.lit(SPILL) * F.sqrt(F.lit(2 * (1 - threshold)) / F.col("dim"))
        left, right = F.col("p") <= F.col("mid") + width, F.col("p") >= F.col("mid") - width
        sided = cut(placed.join(cuts, NODE).select(*NODE, *cols, left.alias("left"), right.alias("right")))
        count = cut(sided.groupBy(*NODE).agg(F.count("*").alias("n"), F.greatest(F.count_if("left"), F.count_if("right")).alias("side")))
        wide = count.where((F.col("side") > F.lit(WIDEST) * F.col("n")) | F.lit(level >= 60)).select(NODE)
        stop = cut(wide.unionByName(_dense_nodes(sided, count.select(*NODE, "n"), threshold)).distinct())
        if level == 1:  # a group compared whole needs no other tree
            stop = stop.groupBy("grp").agg(F.min("tree").alias("tree"), F.min("path").alias("path"))
        whole = whole.unionByName(sided.join(stop, NODE).join(count.drop("side"), NODE).select(whole.columns))
        sides = F.filter(
            F.array(F.when(F.col("left"), F.col("path") * 2), F.when(F.col("right"), F.col("path") * 2 + 1)), lambda x: x.isNotNull()
        )
        split = sided.join(stop, "grp" if level == 1 else NODE, "left_anti").select("grp", "tree", F.explode(sides).alias("path"), *cols)
        split = cut(split)
        n = split.groupBy(*NODE).agg(F.count("*").alias("n"))
        big = split.join(n, NODE)
        done = done.unionByName(big.where(F.col("n") <= part).drop("n"))
        todo = big.where(F.col("n") > part).drop("n")
        if n.where(F.col("n") > part).limit(1).count() == 0:
            break
    whole = cut(whole.withColumn("wid", F.xxhash64("tree", "path")))
    done = plain(done, F.array().cast("array<long>")).drop("w")

    def inner(batches):
        """(grp, rep, wid): the rows of the nodes within a part that are compared whole."""
        for (grp, tree, path, *_), t in _tasks(batches):
            rep = t.column("rep").to_numpy()
            for k, at in enumerate(ends(matrix(t.column("vec")), threshold, range(tree, tree + 1), leaf)[1]):
                yield pa.RecordBatch.from_arrays([pa.array([grp] * len(at)), pa.array(rep[at]), pa.array(np.full(len(at), _node_id(tree, path, k)))], names=["grp", "rep", "wid"])

    inside = spread(done, *TASK).sortWithinPartitions(*TASK, "rep").mapInArrow(inner, "grp string, rep long, wid long")
    within = cut(whole.select("grp", "rep", "wid").unionByName(inside).groupBy("grp", "rep").agg(F.collect_set("wid").alias("w")))
    blocks = F.ceil(F.col("n") / max(1, part // 2)).cast("int")
    dealt = whole.join(within, ["grp", "rep"]).withColumn("at", F.pmod(F.xxhash64("rep", F.lit(3)), blocks).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select(*NODE, F.least("at", "o").alias("x"), F.greatest("at", "o").alias("y"), "at", "wid", "w", *cols)
    done = done.join(within, ["grp", "rep"], "left").withColumn("w", F.coalesce("w", F.array().cast("array<long>"))).select(dealt.columns)
    return plain(fits, F.array().cast("array<long>")).unionByName(done).unionByName(dealt)


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    trees: int = TREES,
    part: int = PART,
    leaf: int = LEAF,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Rows are linked if their labels are equal and not null and the cosine of
    their vectors is at least ``threshold``; ``n_links`` counts the other rows
    linked directly and ``component_id`` is the smallest id reachable.

    Defined cases: vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null label, link with nothing;
    vectors of different lengths are not linked; exact copies are linked, also
    those of one id; rows that share an id are compared each by its own vector;
    rows with a null id are not returned; other columns are ignored; an empty
    table gives no rows.
    """
    prepare(vectors.sparkSession)
    rows = vectors.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        as_double(vectors, vec_col).alias("vec"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
    )
    rows = rows.withColumn("ok", usable(F.col("vec")) & F.col("label").isNotNull())
    grp = F.concat_ws("|", F.size("vec").cast("string"), F.col("label"))
    rows = cut(rows.select("id", "ok", F.when(F.col("ok"), grp).alias("grp"), F.when(F.col("ok"), F.col("vec")).alias("vec")))
    # + 0.0 makes negative zeros equal to zeros
    same = F.xxhash64(F.transform("vec", lambda x: x + 0.0)).alias("h")
    keyed = rows.where("ok").select("id", "grp", "vec", same)
    classes = keyed.groupBy("grp", "h", "vec").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = cut(classes.withColumn("rep", F.monotonically_increasing_id()))  # which also fixes the numbers
    parts = _parts(classes.select("grp", "rep", "copies", "vec"), threshold, trees, part, leaf)

    def compare(batches):
        """(a, b, n): a link (n = 0), an edge of a spanning forest (n = -1), or copies counted for a (b null)."""

        def out(a, b, n):
            for i in range(0, len(a), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[i : i + 50_000], pa.int64()), pa.array(b[i : i + 50_000], pa.int64()), pa.array(n[i : i + 50_000], pa.int64())],
                    names=["a", "b", "n"],
                )

        def counted(rep, counts, a, b):
            some = counts > 0
            yield from out(rep[some], pa.nulls(int(some.sum()), pa.int64()), counts[some])
            yield from out(a, b, np.full(len(a), -1))

        def nodes(t, least=None):
            """Which nodes each row is in, of those below ``least``."""
            w = t.column("w").to_pylist()
            names = sorted({v for r in w for v in r if least is None or v < least})
            place = {v: i for i, v in enumerate(names)}
            within = np.zeros((len(w), len(names)), bool)
            for i, r in enumerate(w):
                within[i, [place[v] for v in r if v in place]] = True
            return within, place

        for (_, tree, path, bx, by), t in _tasks(batches):
            rep, copies, at = (t.column(c).to_numpy() for c in ("rep", "copies", "at"))
            vec = matrix(t.column("vec"))
            if tree < 0:
                counts, name = links_within(vec, copies, threshold, range(trees), leaf)
                joined = np.flatnonzero(name != np.arange(len(name)))
                yield from counted(rep, counts, rep[joined], rep[name[joined]])
            elif bx < 0:
                within, place = nodes(t)
                small, whole = ends(vec, threshold, range(tree, tree + 1), leaf)
                for k, rows in enumerate(whole):
                    wid = _node_id(tree, path, k)
                    w = _columns(within[:, [i for v, i in place.items() if v < wid]], rows)
                    counts, _, edges = count_links(vec[rows], None, copies[rows], None, w, None, threshold)
                    e = np.array(edges, np.int64).reshape(-1, 2)
                    yield from counted(rep[rows], counts, rep[rows[e[:, 0]]], rep[rows[e[:, 1]]])
                p = leaf_links(vec, threshold, small, within)
                yield from out(rep[p[:, 0]], rep[p[:, 1]], np.zeros(len(p), np.int64))
            else:
                within, _ = nodes(t, t.column("wid")[0].as_py())
                f, g = np.flatnonzero(at == bx), np.flatnonzero(at == by)
                if bx == by:
                    counts, _, edges = count_links(vec, None, copies, None, _columns(within, f), None, threshold)
                    order = f
                else:
                    order = np.concatenate((f, g))
                    w = _columns(within, order)
                    k, m, edges = count_links(vec[f], vec[g], copies[f], copies[g], w[: len(f)], w[len(f) :], threshold)
                    counts = np.concatenate((k, m))
                e = np.array(edges, np.int64).reshape(-1, 2)
                yield from counted(rep[order], counts, rep[order[e[:, 0]]], rep[order[e[:, 1]]])

    found = cut(
        spread(parts, *TASK)
        .sortWithinPartitions(*TASK, "rep")
        .mapInArrow(compare, "a long, b long, n long")
        .select(F.least("a", "b").alias("a"), F.when(F.col("b").isNotNull(), F.greatest("a", "b")).alias("b"), "n")
        # one part's pairs are distinct already; parts of several trees or sides repeat some
        .groupBy("a", "b", F.least("n", F.lit(1)).alias("kind"))
        .agg(F.sum("n").alias("n"))
    )
    edges = found.where("kind = 0").select("a", "b")
    size = classes.select("rep", "copies")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(size.withColumnRenamed("rep", "b"), "b").select(F.col("a").alias("rep"), "copies")
    others = others.unionByName(found.where("kind = 1").select(F.col("a").alias("rep"), F.col("n").alias("copies")))
    others = others.groupBy("rep").agg(F.sum("copies").alias("others"))
    labels = components(found.where("kind < 1").select("a", "b")).withColumnRenamed("node", "rep")
    named = cut(classes.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    smallest = cut(named.groupBy("component").agg(F.min("id").alias("component_id")))
    per_class = (
        named.join(smallest, "component")
        .join(others, "rep", "left")
        .select("grp", "h", "vec", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    )
    hit = keyed.join(per_class, ["grp", "h", "vec"]).select("id", "n_links", "component_id")
    miss = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return hit.unionByName(miss).select("id", F.col("n_links").cast("long").alias("n_links"), "component_id", (F.col("component_id") == F.col("id")).alias("kept"))
