"""Toxic spans and document scores by a linear-chain random field (operator 9).

Tokens are runs of letters and digits, lower-cased in A-Z.  Two states, clean
and toxic; a token's emission is the sum of hashed weights of the whole token
and of its beginnings of four to six bytes, and transitions couple neighbours.

Labels are given for documents, so tokens are labelled first: in the sample, a
token of a toxic document is toxic if it or one of its beginnings is in more
toxic documents than chance allows for any feature (a likelihood-ratio test
corrected for their number).  The field is then fitted to those tags by its
exact gradient (forward-backward).  A
document's score is a logistic function of its marginals: of the largest and of
their sum.  Only the text enters a score.
"""

from __future__ import annotations

import io
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimcheck.llm import _words
from claimcheck.llm._util import giving_back, prepare

BUCKETS = 1 << 22
SAMPLE_DOCS = 800  # toxic documents that the fit takes at most, and clean ones for the field
CLEAN_FACTOR = 8  # so many times as many clean documents to tell toxic tokens from chance
SAMPLE_CHARS = 40_000  # longer documents are left out of the sample (never of the scoring)
CHUNK = 128  # tokens of one column of the vectorised recursions
PIECE = 1 << 16  # tokens of a longer text that the recursions take at once
HEADS = (4, 5, 6)  # bytes of the beginnings that are features
SEEN_DOCS, TIMES = 3, 8  # a telling feature is in so many toxic documents and so many times as frequent there
EPOCHS = 40
SPAN = 0.5

_OUTSIDE = np.ones(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _OUTSIDE[_a:_b] = False


@dataclass
class Model:
    """Emission weights by bucket, bias, transition scores, start score, and the document's logistic."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    start: float
    logit: np.ndarray

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self))
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Model:
        with np.load(io.BytesIO(raw)) as z:
            return cls(z["buckets"], z["weights"], float(z["bias"]), z["trans"], float(z["start"]), z["logit"])

    def dense(self) -> np.ndarray:
        w = np.zeros(BUCKETS, np.float32)
        w[self.buckets] = self.weights
        return w


def _buckets(hashes) -> np.ndarray:
    return np.stack([(h & np.uint64(BUCKETS - 1)).astype(np.int64) for h in hashes])


def tokens(data: np.ndarray, off: np.ndarray):
    """(start, end, document, feature buckets) of a slice's tokens."""
    start, end, doc = _words.words(data, off, _OUTSIDE)
    h = _words.Hashes(data)
    return start, end, doc, _buckets([h.of(start, end, 1)] + [h.of(start, np.minimum(end, start + k), k) for k in HEADS])


def _long_tokens(data: np.ndarray):
    """(start, end, feature buckets) of the tokens of one long text, piece by piece."""
    for start, end, raw in _words.runs(data, _OUTSIDE):
        yield start, end, _buckets([_words.salted(raw, 1)] + [_words.salted(_words.heads(data, start, end, k), k) for k in HEADS])


class Chains:
    """Documents' tokens laid out in chunks, for exact recursions over all of them at once."""

    def __init__(self, doc: np.ndarray, docs: int, goes_on: bool = False):
        self.n = np.bincount(doc, minlength=docs)
        chunks = -(-self.n // CHUNK)
        self.first_chunk = np.concatenate(([0], np.cumsum(chunks)))
        at = np.concatenate(([0], np.cumsum(self.n)))
        owner = np.repeat(np.arange(docs), chunks)
        begin = at[owner] + (np.arange(len(owner)) - self.first_chunk[owner]) * CHUNK
        self.index = begin[:, None] + np.arange(CHUNK)[None]
        self.valid = self.index < at[owner + 1][:, None]
        self.index[~self.valid] = 0
        self.opens = np.zeros(self.index.shape, bool)  # the first token of its document
        self.opens[self.first_chunk[:-1][self.n > 0], 0] = not goes_on
        self.chunks = chunks

    def _products(self, e: np.ndarray, a: np.ndarray):
        """(factors of the tokens by chunk, scaled products of each chunk's matrices)."""
        c = len(self.index)
        x = np.exp(np.clip(e, -30, 30))[self.index] if len(e) else np.zeros((0, CHUNK))
        p00, p01, p10, p11 = np.ones(c), np.zeros(c), np.zeros(c), np.ones(c)
        for j in range(CHUNK):
            ok, op, y = self.valid[:, j], self.opens[:, j], x[:, j]
            q00, q01 = np.where(op, p00, p00 * a[0, 0] + p01 * a[1, 0]), np.where(op, p01, p00 * a[0, 1] + p01 * a[1, 1]) * y
            q10, q11 = np.where(op, p10, p10 * a[0, 0] + p11 * a[1, 0]), np.where(op, p11, p10 * a[0, 1] + p11 * a[1, 1]) * y
            s = q00 + q01 + q10 + q11
            p00, p01 = np.where(ok, q00 / s, p00), np.where(ok, q01 / s, p01)
            p10, p11 = np.where(ok, q10 / s, p10), np.where(ok, q11 / s, p11)
        return x, (p00, p01, p10, p11)

    def product(self, e: np.ndarray, trans: np.ndarray) -> np.ndarray:
        """The scaled product of all matrices of a single document."""
        out = np.eye(2)
        for m in np.stack(self._products(e, np.exp(trans))[1], axis=1).reshape(-1, 2, 2):
            out = out @ m
            out /= out.sum()
        return out

    def run(self, e: np.ndarray, trans: np.ndarray, start: float, enter: np.ndarray | None = None, leave: np.ndarray | None = None):
        """(toxic marginals, pair marginals summed) of emissions ``e``.

        ``enter`` and ``leave``: the states' weights before and after, for a piece of a document.
        """
        a = np.exp(trans)
        c = len(self.index)
        x, (p00, p01, p10, p11) = self._products(e, a)
        v0, v1, w0, w1 = np.empty(c), np.empty(c), np.empty(c), np.empty(c)
        prior = np.array([1.0, np.exp(start)]) / (1 + np.exp(start))
        most = int(self.chunks.max(initial=0))
        order = np.argsort(-self.chunks, kind="stable")
        many = -self.chunks[order]
        (f0, f1), (b0, b1) = ((np.full(len(order), v[0]), np.full(len(order), v[1])) for v in (prior if enter is None else enter, (0.5, 0.5) if leave is None else leave))
        for k in range(most):
            live = int(np.searchsorted(many, -k, "left"))
            at = self.first_chunk[order[:live]] + k
            v0[at], v1[at] = f0[:live], f1[:live]
            g0, g1 = f0[:live] * p00[at] + f1[:live] * p10[at], f0[:live] * p01[at] + f1[:live] * p11[at]
            f0[:live], f1[:live] = g0 / (g0 + g1), g1 / (g0 + g1)
            back = self.first_chunk[order[:live] + 1] - 1 - k
            w0[back], w1[back] = b0[:live], b1[:live]
            h0, h1 = p00[back] * b0[:live] + p01[back] * b1[:live], p10[back] * b0[:live] + p11[back] * b1[:live]
            b0[:live], b1[:live] = h0 / (h0 + h1), h1 / (h0 + h1)
        fwd = np.empty((CHUNK, 2, c))
        for j in range(CHUNK):
            ok, op, y = self.valid[:, j], self.opens[:, j], x[:, j]
            g0 = np.where(op, v0, v0 * a[0, 0] + v1 * a[1, 0])
            g1 = np.where(op, v1, v0 * a[0, 1] + v1 * a[1, 1]) * y
            s = g0 + g1
            fwd[j, 0], fwd[j, 1] = v0, v1  # before the token
            v0, v1 = np.where(ok, g0 / s, v0), np.where(ok, g1 / s, v1)
        marginal = np.zeros((c, CHUNK))
        pairs = np.zeros((2, 2))
        for j in range(CHUNK - 1, -1, -1):
            ok, op, y = self.valid[:, j], self.opens[:, j], x[:, j]
            u0, u1 = fwd[j]
            d0, d1 = w0, w1 * y
            m00, m01, m10, m11 = u0 * a[0, 0] * d0, u0 * a[0, 1] * d1, u1 * a[1, 0] * d0, u1 * a[1, 1] * d1
            first = op
            z = np.where(first, u0 * d0 + u1 * d1, m00 + m01 + m10 + m11)
            marginal[:, j] = np.where(first, u1 * d1, m01 + m11) / z
            inner = ok & ~first
            for r, t in enumerate(((m00, m01), (m10, m11))):
                for q in (0, 1):
                    pairs[r, q] += (t[q][inner] / z[inner]).sum()
            g0 = np.where(op, d0, a[0, 0] * d0 + a[0, 1] * d1)
            g1 = np.where(op, d1, a[1, 0] * d0 + a[1, 1] * d1)
            s = g0 + g1
            w0, w1 = np.where(ok, g0 / s, w0), np.where(ok, g1 / s, w1)
        out = np.zeros(len(e))
        out[self.index[self.valid]] = marginal[self.valid]
        return out, pairs


def long_marginals(e: np.ndarray, trans: np.ndarray, start: float) -> np.ndarray:
    """Toxic marginals of one document's tokens, exact, with the recursions' arrays for PIECE tokens only."""
    pieces = [slice(i, i + PIECE) for i in range(0, len(e), PIECE)]
    chains = lambda at: Chains(np.zeros(len(e[at]), np.int64), 1, goes_on=at.start > 0)
    products = [chains(at).product(e[at], trans) for at in pieces]
    enter, leave = [np.array([1.0, np.exp(start)]) / (1 + np.exp(start))], [np.array([0.5, 0.5])]
    for m, back in zip(products, reversed(products), strict=True):
        f, b = enter[-1] @ m, back @ leave[-1]
        enter.append(f / f.sum())
        leave.append(b / b.sum())
    out = np.empty(len(e))
    for i, at in enumerate(pieces):
        out[at] = chains(at).run(e[at], trans, start, enter[i], leave[len(pieces) - 1 - i])[0]
    return out


def summaries(p: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """(1, largest marginal, log of 1 + the sum of marginals above a twentieth) of each document."""
    top = np.zeros(docs)
    np.maximum.at(top, doc, p)
    total = np.bincount(doc, np.where(p > 0.05, p, 0.0), minlength=docs)
    return np.stack([np.ones(docs), top, np.log1p(total)], axis=1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _toxic_features(texts: list[str], toxic: np.ndarray) -> np.ndarray:
    """Buckets that mark toxic documents, by a test over all the sample."""
    t, c = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.int32)
    for first, data, off in _words.slices(pa.array(texts, pa.string())):
        _, _, doc, feats = tokens(data, off)
        for f in feats:
            seen = np.unique(doc * BUCKETS + f)
            d, b = seen // BUCKETS + first, seen % BUCKETS
            np.add.at(t, b[toxic[d]], 1)
            np.add.at(c, b[~toxic[d]], 1)
    base = toxic.mean()
    features = np.count_nonzero(t) + np.count_nonzero(c[t == 0])
    at = np.flatnonzero(t >= SEEN_DOCS)
    at = at[t[at] * (1 - base) >= TIMES * c[at] * base]
    x, y = t[at].astype(float), c[at].astype(float)
    total = x + y
    g = 2 * (x * np.log(x / (base * total)) + y * np.log(np.maximum(y, 0.5) / ((1 - base) * total)))
    marks = np.zeros(BUCKETS, bool)
    marks[at[g >= 2 * np.log(features + 1)]] = True
    return marks


def fit(texts: list[str], labels: list[int], clean_docs: int = SAMPLE_DOCS) -> Model:
    """Fits the field and the document's logistic to whole labelled texts.

    All texts serve to find toxic tokens; the field is fitted to the toxic and
    the first ``clean_docs`` clean ones.
    """
    none = np.zeros(0, np.int64)
    zero = Model(none, none.astype(np.float32), 0.0, np.zeros((2, 2)), 0.0, np.array([-40.0 if not any(labels) else 40.0, 0, 0]))
    toxic = np.array(labels, bool)
    if not len(toxic) or toxic.all() or not toxic.any():
        return zero
    marks = _toxic_features(texts, toxic)
    chosen = toxic | (np.cumsum(~toxic) <= clean_docs)
    texts, toxic = [t for t, k in zip(texts, chosen, strict=True) if k], toxic[chosen]
    feats, doc = [], []
    for first, data, off in _words.slices(pa.array(texts, pa.string())):
        _, _, d, f = tokens(data, off)
        feats.append(f)
        doc.append(d + first)
    feats, doc = np.concatenate(feats, axis=1), np.concatenate(doc)
    docs = len(toxic)
    y = marks[feats].any(axis=0) & toxic[doc]
    chains = Chains(doc, docs)
    used, feats = np.unique(feats, return_inverse=True)
    feats = feats.reshape(4, -1)
    w = np.zeros(len(used))
    theta = np.array([-4.0, 0.0, 0.0, 0.0, 0.0, 0.0])  # bias, transitions 00 01 10 11, start
    inner = np.concatenate(([False], doc[1:] == doc[:-1]))
    have = np.bincount((y[:-1] * 2 + y[1:])[inner[1:]], minlength=4)
    opens = np.flatnonzero(~inner)
    step_w, step_t = np.full(len(used), 1e-6), np.full(6, 1e-6)
    for _ in range(EPOCHS):
        e = w[feats].sum(axis=0) + theta[0]
        p, pairs = chains.run(e, theta[1:5].reshape(2, 2), theta[5])
        d = p - y
        g = np.bincount(feats.ravel(), np.tile(d, 4), minlength=len(used)) + 0.05 * w
        gt = np.array([d.sum(), *(pairs.ravel() - have), d[opens].sum()]) + 0.05 * theta
        step_w += g * g
        step_t += gt * gt
        w -= 0.5 * g / np.sqrt(step_w)
        theta -= 0.3 * gt / np.sqrt(step_t)
    p, _ = chains.run(w[feats].sum(axis=0) + theta[0], theta[1:5].reshape(2, 2), theta[5])
    z = summaries(p, doc, docs)
    logit = np.zeros(3)
    for _ in range(50):  # Newton steps of a ridge logistic regression
        q = _sigmoid(z @ logit)
        grad = z.T @ (q - toxic) + 0.1 * logit
        hess = (z * (q * (1 - q) + 1e-6)[:, None]).T @ z + 0.1 * np.eye(3)
        logit -= np.linalg.solve(hess, grad)
    some = np.abs(w) > 1e-3
    return Model(used[some], w[some].astype(np.float32), float(theta[0]), theta[1:5].reshape(2, 2), float(theta[5]), logit)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """(h, text, y): at most ``most`` toxic and CLEAN_FACTOR times as many clean texts, by a hash of their ids.

    Rows whose crc32 of the id as text is divisible by five are left out.
    """
    key = F.col(f"`{id_col}`").cast("long")
    lab = labels.select(key.alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).where("id is not null and y in (0, 1) and crc32(cast(id as string)) % 5 <> 0")
    lab = lab.groupBy("id").agg(F.max("y").alias("y")).withColumn("h", F.md5(F.col("id").cast("string")))
    picked = lab.where("y = 1").orderBy("h").limit(most).unionByName(lab.where("y = 0").orderBy("h").limit(CLEAN_FACTOR * most))
    text = docs.select(key.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    # one text an id, so that rows that repeat an id do not widen the sample
    return text.join(F.broadcast(picked), "id").groupBy("id", "h", "y").agg(F.min("text").alias("text")).select("h", "text", "y")


def without_copies(texts: list[str], labels: list[int]) -> tuple[list[str], list[int]]:
    """Texts that do not share most of their runs of four words with earlier ones.

    An eighth of the runs, chosen by their hash, stands for all, which bounds
    what is remembered; a text that has none of that eighth stays.
    """
    kept, ys, seen = [], [], set()
    for text, y in zip(texts, labels, strict=True):
        w = text.split()
        every = (zlib.crc32(" ".join(w[i : i + 4]).encode()) for i in range(max(1, len(w) - 3)))
        parts = {h for h in every if h % 8 == 0}
        if parts and len(parts & seen) * 2 > len(parts):
            continue
        seen |= parts
        kept.append(text)
        ys.append(y)
    return kept, ys


SCORED = "score double, predicted int, spans array<struct<start:int,end:int,p:double>>"


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, spans) of every whole text.

    ``spans`` are runs of tokens whose toxic marginal is at least a half: code
    point offsets and the largest marginal.

    Defined cases: null and empty texts score as texts without tokens; repeated
    rows are scored each; null ids stay null; other columns are ignored; an
    empty table gives no rows.  No shuffle; a task holds one slice of texts, and
    of a text longer than that its tokens' places and marginals.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        weights = model.dense()
        for t in batches:
            ids = t.column(0)
            for first, n, s, spans in _scored(t.column(1), model, weights):
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, n),
                        pa.array(s),
                        pa.array((s >= 0.5).astype(np.int32)),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))),
                    ],
                    names=["id", "score", "predicted", "spans"],
                )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(giving_back(run), f"id {kind}, {SCORED}")


def _scored(column, model: Model, weights: np.ndarray):
    """(first row, rows, scores, spans) of the slices of a text column."""
    for first, data, off in _words.slices(column):
        n = len(off) - 1
        if n == 1 and len(data) > 2 * _words.SLICE_BYTES:
            start, end, e = (np.concatenate(x) for x in zip(*((s, t, weights[f].sum(axis=0, dtype=np.float64)) for s, t, f in _long_tokens(data)), strict=True))
            doc = np.zeros(len(e), np.int64)
            p = long_marginals(e + model.bias, model.trans, model.start)
        else:
            start, end, doc, feats = tokens(data, off)
            e = weights[feats].sum(axis=0, dtype=np.float64) + model.bias
            p, _ = Chains(doc, n).run(e, model.trans, model.start)
        yield first, n, _sigmoid(summaries(p, doc, n) @ model.logit), _spans(data, off, start, end, doc, p, n)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below a half; no shuffle.

    Defined cases: as ``score``; each row is judged by its text alone, so null
    ids and repeated rows need no care.
    """
    prepare(docs.sparkSession)

    def run(batches):
        weights = model.dense()
        for t in batches:
            keep = np.ones(t.num_rows, bool)
            for first, n, s, _ in _scored(t.column(text_col), model, weights):
                keep[first : first + n] = s < 0.5
            yield t.filter(pa.array(keep))

    return docs.mapInArrow(giving_back(run), docs.schema)


def _points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many characters begin before each of the ascending byte positions ``at``."""
    out, before = np.zeros(len(at), np.int64), 0
    for i in range(0, len(data) + 1, _words.SLICE_BYTES):
        begins = np.concatenate(([0], np.cumsum((data[i : i + _words.SLICE_BYTES] & 0xC0) != 0x80)))
        mine = (at >= i) & (at < i + _words.SLICE_BYTES)
        out[mine] = before + begins[at[mine] - i]
        before += int(begins[-1])
    return out


def _spans(data, off, start, end, doc, p, docs):
    """Each document's runs of tokens whose marginal is at least SPAN, in characters of its text."""
    out = [[] for _ in range(docs)]
    hits = np.flatnonzero(p >= SPAN)
    if not len(hits):
        return out
    asked = np.unique(np.concatenate((start[hits], end[hits], off[:-1])))
    point = dict(zip(asked.tolist(), _points(data, asked).tolist(), strict=True))
    last = -2
    for i in hits.tolist():
        d = int(doc[i])
        a, b = (point[int(x)] - point[int(off[d])] for x in (start[i], end[i]))
        if out[d] and last == i - 1:
            out[d][-1].update(end=b, p=max(out[d][-1]["p"], float(p[i])))
        else:
            out[d].append({"start": a, "end": b, "p": float(p[i])})
        last = i
    return out


def detect(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """Fits on a bounded sample of ``labels`` (see ``fitted``) and scores every document (see ``score``)."""
    return score(docs, fitted(docs, labels, id_col, text_col, label_col, sample_docs), id_col, text_col)


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model fitted to the bounded sample of the labelled rows.

    The fit runs in one task, which holds the sample; only the model comes to
    the driver.

    Defined cases: labels that are null or neither 0 nor 1, null ids and ids
    without a document are left out; an id labelled both ways is toxic; of the
    texts of a repeated id the smallest is taken; null texts and texts beyond
    SAMPLE_CHARS are left out; near copies in the sample count once; if the
    sample holds one label only, or none, every score is 0 or, if that label is
    toxic, 1.
    """
    prepare(docs.sparkSession)

    def run(batches):
        texts, ys = [], []
        for t in batches:
            texts += t.column("text").to_pylist()
            ys += t.column("y").to_pylist()
        yield pa.RecordBatch.from_pydict({"model": [fit(*without_copies(texts, ys), sample_docs).to_bytes()]})

    rows = sample(docs, labels, id_col, text_col, label_col, sample_docs)
    one = rows.repartition(1).sortWithinPartitions("h", "text").select("text", "y").mapInArrow(giving_back(run), "model binary").collect()
    return Model.from_bytes(one[0].model) if one else fit([], [])
