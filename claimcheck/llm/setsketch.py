"""Near-duplicate documents by SetSketch registers (operator 2).

A sketch has M registers.  An element draws one value from each of M
consecutive intervals of an exponential law (so its values are exponentially
distributed minima, spaced and truncated) and gives the j-th to a register by
an element-wise permutation; a register keeps the smallest value, on the
logarithmic scale of base B.  As values of later intervals are larger, a
register that has a value after step j is final, and a large set is done
after few steps.  Sketches merge by the maximum of each register, and equal
registers become as likely as the Jaccard similarity.

Search: registers are banded, and the centre of a bucket is the member that
shares most buckets overall.  Each member first goes to one centre, that of the
densest of its buckets; the estimate by likelihood drops hopeless pairs, and
the rest is verified on the full sets.  Members of buckets that are still split
between components then go to their other centres.  What is left outside its
bucket's largest component after that is compared with every member of another
component, sketches first and texts only where a likely pair is.  No pair of a
bucket is left out and no bucket has a cap; a large group costs about one
comparison a member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimcheck.llm import _words
from claimcheck.llm._util import broadcast_if, components, cut, giving_back, prepare, spread

M = 256  # registers, a power of two
B = 1.1  # base of the register scale
RATE = 20.0  # rate of the exponential law: keeps one-element sets inside the scale
BANDS, ROWS = 32, 6  # at a similarity of 0.8 a pair shares no band once in 16,000
BLOCK = 512  # texts of a block in the comparison of what is left apart
COARSE = 8  # so many blocks of texts make a block of sketches
BROADCAST_GROUPS = 200_000  # at most so many sizes of groups are broadcast
BROADCAST_KEYS = 100_000  # and so many keys of texts
FEW_EDGES = 200_000  # at most so many links are settled in one task


# ---------------------------------------------------------------- sketches


def sketches(values: np.ndarray, bounds: np.ndarray, m: int = M) -> np.ndarray:
    """uint8 registers (documents x m) of sets given as runs of distinct hashes."""
    docs = len(bounds) - 1
    least = np.full(docs * m, 2.0)
    size = np.diff(bounds)
    doc = np.repeat(np.arange(docs), size)
    key = _words.mix(values ^ np.uint64(0x5851F42D4C957F2D))
    mask = np.uint64(m - 1)
    place = key & mask
    stride = ((key >> np.uint64(20)) & mask) | np.uint64(1)
    open_docs = size > 0
    for j in range(m):
        if not len(values):
            break
        draw = _words.mix(values + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        t = (j + (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53) / m
        at = doc * m + (place & mask).astype(np.int64)
        if j:
            free = least[at] > 1.5
            np.minimum.at(least, at[free], t[free])
        else:
            np.minimum.at(least, at, t)
        place = place + stride
        if j + 1 < m:
            open_docs &= (least.reshape(docs, m) > 1.5).any(axis=1)
            live = open_docs[doc]
            if not live.all():
                values, doc, place, stride = values[live], doc[live], place[live], stride[live]
    x = -np.log1p(-np.minimum(least, 1 - 1e-15)) / RATE
    reg = np.floor(1.0 - np.log(np.maximum(x, 1e-300)) / np.log(B))
    return np.clip(reg, 0, 255).astype(np.uint8).reshape(docs, m)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarities of sketch rows with known set sizes."""
    up = (a > b).sum(axis=1).astype(float)
    down = (a < b).sum(axis=1).astype(float)
    same = a.shape[1] - up - down
    u = na / (na + nb)
    v = 1.0 - u
    top = np.minimum(u / v, v / u)

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)

    def likelihood(j):
        p, q = chance(u - v * j), chance(v - u * j)
        tiny = 1e-12
        return (
            up * np.log(np.maximum(p, tiny))
            + down * np.log(np.maximum(q, tiny))
            + same * np.log(np.maximum(1 - p - q, tiny))
        )

    lo, hi = np.zeros_like(top), top.copy()
    golden = (5**0.5 - 1) / 2
    for _ in range(28):
        c, d = hi - golden * (hi - lo), lo + golden * (hi - lo)
        left = likelihood(c) > likelihood(d)
        hi, lo = np.where(left, d, hi), np.where(left, lo, c)
    return (lo + hi) / 2


def floor_of_estimate(threshold: float, m: int = M) -> float:
    """Five standard errors below the threshold: drops a pair there about once in 375,000, far less often than the bands."""
    return threshold - 5.0 * (threshold * (1 - threshold) / m) ** 0.5


_FEATURES = "id long, th long, n_shingles long, fp1 long, fp2 long, sketch binary"


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, text): a row is known by its id and the hash of its text, as rows may share an id."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def features(texts: DataFrame, k: int) -> DataFrame:
    """Set size, a 128-bit fingerprint of the set and the sketch of each text of ``keyed_texts``."""
    prepare(texts.sparkSession)

    def run(batches):
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            for first, data, off in _words.slices(batch.column(2)):
                values, bounds = _words.shingle_sets(data, off, k)
                size = np.diff(bounds)
                reg = sketches(values, bounds)
                prints = []
                for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
                    s = np.zeros(len(values) + 1, np.uint64)
                    np.cumsum(_words.mix(values ^ np.uint64(seed)), out=s[1:])
                    prints.append((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(size)),
                        hashes.slice(first, len(size)),
                        pa.array(size, pa.int64()),
                        *(pa.array(p) for p in prints),
                        pa.array([r.tobytes() for r in reg], pa.binary()),
                    ],
                    names=["id", "th", "n_shingles", "fp1", "fp2", "sketch"],
                )

    return texts.mapInArrow(giving_back(run), _FEATURES)


# ---------------------------------------------------------------- pairs

_PAIR = ["a", "ida", "tha", "b", "idb", "thb"]
_PAIR_SCHEMA = ", ".join(f"{c} long" for c in _PAIR)


def _likely(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose estimate reaches ``least``, with the keys of their texts."""
    side = lambda n: classes.select(
        F.col("node").alias(n), F.col("id").alias("id" + n), F.col("th").alias("th" + n), F.col("n_shingles").alias("n" + n), F.col("sketch").alias("s" + n)
    )

    def run(batches):
        for t in batches:
            if not t.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint8).reshape(-1, M) for c in ("sa", "sb"))
            na, nb = (t.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb"))
            keep = pa.array(estimate(x, y, na, nb) >= least)
            yield pa.RecordBatch.from_arrays([t.column(c).filter(keep) for c in _PAIR], names=_PAIR)

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, _PAIR_SCHEMA)


def verify(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int, per_task: int = 256) -> DataFrame:
    """Those (a, b) of distinct ``pairs`` (as of ``_likely``) with den * |A and B| >= num * |A or B| on full sets.

    ``a`` is the side that many pairs share: its text is sent once for each
    ``per_task`` of its partners, and a task holds the set of one ``a`` and one
    batch of partners.  Texts are joined to what is wanted of them in one join.
    """
    p = cut(pairs)
    hub = cut(p.groupBy("a", "ida", "tha").agg(F.ceil(F.count("*") / per_task).cast("int").alias("shards")))
    many = broadcast_if(hub.where("shards > 1").select("a", "shards"), BROADCAST_GROUPS)
    shards = F.coalesce("shards", F.lit(1))
    hubs = hub.select(
        F.col("ida").alias("id"), F.col("tha").alias("th"), "a", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(None).cast("long").alias("b")
    )
    partners = p.join(many, "a", "left").select(
        F.col("idb").alias("id"), F.col("thb").alias("th"), "a", F.pmod(F.xxhash64("b"), shards).cast("int").alias("shard"), "b"
    )
    wanted = cut(hubs.unionByName(partners))

    def run(batches):
        hub_id, hub_set = None, None
        for t in batches:
            ids, others = t.column("a").to_pylist(), t.column("b").to_pylist()
            out_a, out_b = [], []
            for first, data, off in _words.slices(t.column("text")):
                values, bounds = _words.shingle_sets(data, off, k)
                for i in range(len(off) - 1):
                    s = values[bounds[i] : bounds[i + 1]]
                    a, b = ids[first + i], others[first + i]
                    if b is None:
                        hub_id, hub_set = a, s
                        continue
                    if a != hub_id:
                        continue
                    if _linked(hub_set, s, num, den):
                        out_a.append(a)
                        out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return (
        spread(_fetched(texts, wanted).select("a", "shard", "b", "text"), "a", "shard")
        .sortWithinPartitions("a", "shard", F.col("b").asc_nulls_first())
        .mapInArrow(giving_back(run), "a long, b long")
    )


def _fetched(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the texts of its (id, th); a null id is an id.

    A few keys are broadcast, so that only their texts are shuffled.
    """
    key = lambda df: df.withColumns({"__id": F.coalesce("id", F.lit(0)), "__null": F.col("id").isNull()}).drop("id")
    on = ["__id", "__null", "th"]
    texts, wanted = key(texts), key(wanted)
    keys = wanted.select(on).distinct()
    if keys.count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(keys), on, "left_semi")
    return texts.join(wanted.hint("merge"), on)


_APART = "grp long, x int, y int, node long, id long, th long, comp long, odd boolean, n_shingles long, sketch binary"
_APART_COLS = [c.split()[0] for c in _APART.split(", ")]


def _near(sa: np.ndarray, sb: np.ndarray, n: float, nb: np.ndarray, num: int, den: int) -> np.ndarray:
    """Rows of ``sb`` that share a band with ``sa`` and whose set sizes allow a link."""
    j = np.flatnonzero(np.minimum(nb, n) * den >= np.maximum(nb, n) * num)
    same = sb[j, : BANDS * ROWS] == sa[: BANDS * ROWS]
    return j[same.reshape(len(j), BANDS, ROWS).all(axis=2).any(axis=1)]


def _apart(members: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between members of one bucket that are in different components.

    In each bucket the largest component is taken as settled; a member outside
    it is odd there.  All odd members of a component's buckets are compared
    with one another and with the component's members in those buckets.  Both
    sides are dealt in blocks, so a task holds two blocks however large the
    component is.  Sketches go first, in blocks of COARSE * BLOCK rows; only
    rows with a likely partner in a pair of text blocks have their texts sent
    there, and pairs are verified on their full sets at once.  Only links are
    returned.
    """
    least = floor_of_estimate(num / den)
    # what is joined to members by key is written first: Spark can split a hot key between two exchanges only
    m = cut(members.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp")))
    split = cut(m.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key"))
    m = cut(m.join(split, "key"))
    sizes = m.groupBy("key", "comp").agg(F.count("*").alias("c"))
    main = cut(sizes.groupBy("key").agg(F.max(F.struct("c", (-F.col("comp")).alias("m"))).alias("c")).select("key", (-F.col("c.m")).alias("grp")))
    rows = m.join(main, "key").groupBy("grp", "node", "comp").agg(F.lit(1).alias("one")).select("grp", "node", "comp", (F.col("comp") != F.col("grp")).alias("odd"))
    rows = cut(rows)
    # groups of one block need no size, so what is joined has one row for each BLOCK rows at most
    count = cut(rows.groupBy("grp").agg(F.count_if("odd").alias("n_odd"), F.count("*").alias("n")).where(F.col("n") > BLOCK))
    rows = rows.join(broadcast_if(count, BROADCAST_GROUPS), "grp", "left")
    blocks = lambda n, size: F.coalesce(F.greatest(F.lit(1), F.ceil(F.col(n) / size)), F.lit(1)).cast("int")
    own = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), blocks(n, BLOCK)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n, BLOCK * COARSE) - 1))
    coarse = lambda c: F.floor(F.col(c) / COARSE).cast("int")
    odd = rows.where("odd").withColumn("x", own("n_odd", 1)).withColumn("bx", coarse("x")).withColumn("by", every("n")).withColumn("y", F.lit(-1))
    both = rows.withColumn("y", own("n", 2)).withColumn("by", coarse("y")).withColumn("bx", every("n_odd")).withColumn("x", F.lit(-1))
    cols = ["grp", "bx", "by", "x", "y", "node", "comp", "odd"]
    sketched = odd.select(cols).unionByName(both.select(cols)).join(classes.select("node", "id", "th", "n_shingles", "sketch"), "node")

    def likely(part):
        """Rows of a pair of coarse blocks that have a likely partner, by pair of text blocks."""
        xs, ys, comp, odd, n = (part.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y", "comp", "odd", "n_shingles"))
        node = part.column("node").to_numpy(zero_copy_only=False)
        left, right = np.flatnonzero(xs >= 0), np.flatnonzero(xs < 0)
        if not len(left) or not len(right):
            return
        s = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(-1, M)
        sb, nb, cb, ob, idb, yb = s[right], n[right].astype(float), comp[right], odd[right], node[right], ys[right]
        hits = set()
        for i in left.tolist():
            j = _near(s[i], sb, float(n[i]), nb, num, den)
            j = j[(cb[j] != comp[i]) & (~ob[j] | (idb[j] > node[i]))]
            if not len(j):
                continue
            j = j[estimate(np.broadcast_to(s[i], (len(j), M)), sb[j], np.full(len(j), float(n[i])), nb[j]) >= least]
            hits.update((i, int(xs[i]), y) for y in np.unique(yb[j]).tolist())
            hits.update((int(right[q]), int(xs[i]), int(yb[q])) for q in j.tolist())
        if hits:
            at, x, y = map(np.array, zip(*sorted(hits), strict=True))
            t = part.take(pa.array(at))
            side = pa.array(xs[at] < 0)
            fixed = [t.column("grp"), pa.array(x, pa.int32()), pa.array(y, pa.int32()), side]
            yield pa.RecordBatch.from_arrays([*fixed, *(t.column(c) for c in _APART_COLS[3:])], names=["grp", "x", "y", "right", *_APART_COLS[3:]])

    def search(batches):
        for part in _grouped(batches, ["grp", "bx", "by"]):
            yield from likely(part)

    wanted = cut(
        spread(sketched, "grp", "bx", "by")
        .sortWithinPartitions("grp", "bx", "by")
        .mapInArrow(giving_back(search), _APART.replace("y int,", "y int, right boolean,"))
    )

    def compare(rows):
        left, right = [r for r in rows if not r[0]], [r for r in rows if r[0]]
        found = []
        if not left or not right:
            return found
        ib, cb = (np.array([r[i] for r in right], np.int64) for i in (1, 2))
        nb = np.array([r[4] for r in right], float)
        sb = np.frombuffer(b"".join(r[5] for r in right), np.uint8).reshape(-1, M)
        odd_b = np.array([r[3] for r in right])
        for _, i, comp, _, n, raw, mine in left:
            sa = np.frombuffer(raw, np.uint8)
            j = _near(sa, sb, n, nb, num, den)
            j = j[(cb[j] != comp) & (~odd_b[j] | (ib[j] > i))]
            if len(j):
                est = estimate(np.broadcast_to(sa, (len(j), M)), sb[j], np.full(len(j), float(n)), nb[j])
                joined = set()  # one link to a component joins all of it
                for x in j[np.argsort(-est)][: np.count_nonzero(est >= least)].tolist():
                    if cb[x] not in joined and _linked(mine, right[x][6], num, den):
                        joined.add(cb[x])
                        found.append((i, int(ib[x])))
        return found

    def run(batches):
        group, rows = None, []
        for t in batches:
            meta = list(zip(*(t.column(c).to_pylist() for c in ("grp", "x", "y", "right", "node", "comp", "odd", "n_shingles", "sketch")), strict=True))
            for first, data, off in _words.slices(t.column("text")):
                values, bounds = _words.shingle_sets(data, off, k)
                for i in range(len(off) - 1):
                    g, x, y, *r = meta[first + i]
                    if (g, x, y) != group:
                        if found := compare(rows):
                            yield _pairs(found)
                        group, rows = (g, x, y), []
                    rows.append((*r, values[bounds[i] : bounds[i + 1]].copy()))
        if found := compare(rows):
            yield _pairs(found)

    return (
        spread(_fetched(texts, wanted), "grp", "x", "y")
        .sortWithinPartitions("grp", "x", "y")
        .mapInArrow(giving_back(run), "a long, b long")
    )


def _grouped(batches, keys: list[str]):
    """The rows of each value of ``keys`` as one batch, from batches sorted by them."""
    held, now = [], None
    for t in batches:
        if not t.num_rows:
            continue
        cols = [t.column(c).to_numpy(zero_copy_only=False) for c in keys]
        new = np.zeros(t.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), t.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            key = tuple(c[a] for c in cols)
            if held and key != now:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            now = key
            held.append(t.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """den * |A and B| >= num * |A or B| for sorted sets; an empty set links with nothing."""
    if not a.size or not b.size:
        return False
    pos = np.searchsorted(a, b)
    pos[pos == a.size] = 0
    both = int((a[pos] == b).sum())
    return den * both >= num * (a.size + b.size - both)


def _pairs(found) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


# ---------------------------------------------------------------- operator


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    num: int = 80,
    den: int = 100,
) -> DataFrame:
    """(id, th, n_shingles, component_id, kept) of every row; ``th`` is the xxhash64 of its text.

    Documents are linked when den * |A and B| >= num * |A or B| on their sets
    of distinct ``shingle_words``-word shingles; ``component_id`` is the
    smallest id reachable by links, and ``kept`` marks one text of each
    component: that of the smallest id, and of these the one of the smallest
    ``th``.

    Defined cases: null, empty and blank texts have an empty set, link with
    nothing and are kept; texts of fewer words have one shingle, the whole
    sequence; exact copies share one component; rows are compared by their
    texts, so rows that share an id but not the text may be in different
    components; rows that repeat id and text give equal rows; rows with a null
    id take part, come after all others in the choice of what is kept, and
    have a null ``component_id`` where no id is reachable; other columns of
    ``docs`` are ignored; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col)
    feats = cut(features(texts, shingle_words))
    order = F.struct(F.col("id").isNull(), "id", "th")
    classes = (
        feats.where("n_shingles > 0")
        .groupBy("fp1", "fp2", "n_shingles")
        .agg(F.min_by(F.struct("id", "th", "sketch"), order).alias("r"))
        .select("fp1", "fp2", "n_shingles", "r.id", "r.th", "r.sketch", F.monotonically_increasing_id().alias("node"))
    )
    classes = cut(classes)  # which also fixes the node numbers
    keyed = classes.select(
        "node",
        F.explode(F.array(*[F.xxhash64(F.lit(i), F.substring("sketch", i * ROWS + 1, ROWS)) for i in range(BANDS)])).alias("key"),
    )
    shared = cut(keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    members = cut(keyed.join(shared, "key"))
    density = members.groupBy("node").agg(F.sum("c").alias("density"))
    centre = cut(members.join(density, "node").groupBy("key").agg(F.max(F.struct("density", (-F.col("node")).alias("m"))).alias("c")))
    members = cut(members.select("key", "node").join(centre.select("key", (-F.col("c.m")).alias("centre"), "c.density"), "key"))
    least = floor_of_estimate(num / den)
    # each member goes to one centre first, and to the others only while a bucket of theirs is split
    others = members.where("node <> centre")
    first = others.groupBy("node").agg(F.max(F.struct("density", (-F.col("centre")).alias("m"))).alias("c")).select((-F.col("c.m")).alias("a"), F.col("node").alias("b"))
    first = cut(first)
    links = verify(_likely(first, classes, least), texts, shingle_words, num, den)
    labels = components(links, small=FEW_EDGES)
    at = lambda n: labels.select(F.col("node").alias(n), F.col("component").alias("c" + n))
    rest = others.select(F.col("centre").alias("a"), F.col("node").alias("b")).join(at("b"), "b", "left").join(at("a"), "a", "left")
    rest = rest.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b").distinct().join(first, ["a", "b"], "left_anti")
    links = verify(_likely(rest, classes, least), texts, shingle_words, num, den)
    star = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
    labels = components(star.unionByName(links), small=FEW_EDGES)
    more = cut(_apart(members, labels, classes, texts, shingle_words, num, den))
    if more.limit(1).count():
        star = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
        labels = components(star.unionByName(more), small=FEW_EDGES)
    named = classes.join(labels, "node", "left").select("fp1", "fp2", "n_shingles", "id", "th", F.coalesce("component", "node").alias("component"))
    named = cut(named)
    chosen = cut(named.groupBy("component").agg(F.min_by(F.struct("id", "th"), order).alias("k")))
    named = named.join(chosen, "component").select("fp1", "fp2", "n_shingles", "k")
    kept = F.col("id").eqNullSafe(F.col("k.id")) & (F.col("th") == F.col("k.th"))
    full = feats.where("n_shingles > 0").join(named, ["fp1", "fp2", "n_shingles"]).select("id", "th", "n_shingles", F.col("k.id").alias("component_id"), kept.alias("kept"))
    empty = feats.where("n_shingles = 0").select("id", "th", "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return full.unionByName(empty)
