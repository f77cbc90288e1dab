"""Words, hashes and shingle sets of whole Arrow columns, by array operations.

A word is a run of bytes outside space and 0x09-0x0D, after A-Z is lowered;
as UTF-8 never uses those bytes inside a character this equals the rule on
code points.  A word's hash is a 64-bit polynomial over table values of its
bytes, then mixed; shingles combine the hashes of their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # texts handled at once; one longer text is handled alone

_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE[ord("A") : ord("Z") + 1] = _TABLE[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 0xD6E8FEB86659FD93
_ALL = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (a xor-shift-multiply finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 1 << 21:  # what slices need
            _powers[base] = have
    return have[:n]


def slices(column: pa.Array | pa.ChunkedArray):
    """(first row, bytes, offsets) for runs of rows of at most SLICE_BYTES."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, "right")) - 1)
        yield i, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray, outside: np.ndarray = _SEP):
    """(start, end, document) of each word of a slice: a run of bytes not in ``outside``."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    sep = outside[data]
    first = off[:-1][off[:-1] < len(data)]
    begins = ~sep
    begins[1:] &= sep[:-1]
    begins[first] = ~sep[first]
    ends = ~sep
    ends[:-1] &= sep[1:]
    last = first[first > 0] - 1
    ends[last] = ~sep[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


class Hashes:
    """Hashes of any byte ranges of a slice, from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * _power(_BASE, len(data)), out=self.sums[1:])
        self.back = _power(_INVERSE, len(data) + 1)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def of(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        return salted(self.raw(start, end), seed)


def runs(data: np.ndarray, outside: np.ndarray = _SEP):
    """(starts, ends, raw hashes) of the words of one long text, which is gone through in pieces of SLICE_BYTES."""
    begun, part = -1, 0  # where a word that goes on in the next piece began, and its hash so far
    for i in range(0, len(data), SLICE_BYTES):
        piece = data[i : i + SLICE_BYTES]
        start, end, _ = words(piece, np.array([0, len(piece)]), outside)
        raw = Hashes(piece).raw(start, end)
        start, end = start + i, end + i
        if begun >= 0:
            if len(start) and start[0] == i:
                raw[0] = (part + int(raw[0]) * pow(_BASE, i - begun, 1 << 64)) & _ALL
                start[0] = begun
            else:
                yield np.array([begun]), np.array([i]), np.array([part], np.uint64)
            begun = -1
        if len(end) and end[-1] == i + len(piece) < len(data):
            begun, part = int(start[-1]), int(raw[-1])
            start, end, raw = start[:-1], end[:-1], raw[:-1]
        yield start, end, raw


def salted(raw: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of raw ones."""
    return mix(raw + np.uint64(seed * _STEP & _ALL))


def heads(data: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Raw hashes of the first ``n`` bytes of words."""
    out = np.zeros(len(start), np.uint64)
    for j in range(n):
        at = start + j
        inside = at < end
        out[inside] += _TABLE[data[at[inside]]] * np.uint64(pow(_BASE, j, 1 << 64))
    return out


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int):
    """(values, bounds): each document's distinct k-word shingle hashes, sorted.

    A text of fewer than k words gives its whole sequence as one shingle; a
    text without words gives none.  A long text takes 8 bytes a word a few
    times over, not a byte.
    """
    docs = len(off) - 1
    if docs == 1 and len(data) > 2 * SLICE_BYTES:
        h = salted(np.concatenate([raw for _, _, raw in runs(data)]))
        count = np.array([len(h)])
    else:
        start, end, doc = words(data, off)
        h = Hashes(data).of(start, end)
        count = np.bincount(doc, minlength=docs)
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64)
    doc = np.repeat(np.arange(docs, dtype=np.int32), count)
    at = np.concatenate(([0], np.cumsum(count)))
    full = max(0, len(h) - k + 1)
    acc = h[:full].copy()
    for j in range(1, k):
        acc += h[j : j + full] * np.uint64(pow(_STEP, j, 1 << 64))
    inside = doc[:full] == doc[k - 1 : k - 1 + full]
    acc = mix(acc[inside] + np.uint64(k))
    n = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(n)))
    out = np.empty(bounds[-1], np.uint64)
    whole = np.repeat(count >= k, n)
    out[whole] = acc
    for d in np.flatnonzero((count > 0) & (count < k)):
        total = sum(x * pow(_STEP, j, 1 << 64) for j, x in enumerate(h[at[d] : at[d + 1]].tolist()))
        out[bounds[d]] = mix(np.array([(total + int(count[d])) & _ALL], np.uint64))[0]
    sizes = np.zeros(docs, np.int64)
    keep = np.ones(len(out), bool)
    for d in range(docs):
        part = out[bounds[d] : bounds[d + 1]]
        if len(part) > 1:
            part.sort()
            keep[bounds[d] + 1 : bounds[d + 1]] = part[1:] != part[:-1]
        sizes[d] = len(part)
    total = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], total[bounds]
