"""SentencePiece encoding and decoding by a streaming Viterbi lattice (operator 5).

A node of the lattice is a boundary of the text, an edge a piece.  For a
unigram model the best path has the largest sum of scores.  For a BPE model
the path must be the one that merging gives; as merging across a boundary
depends on the two pieces beside it only, that is the single path all of whose
neighbouring pieces are stable together, so an edge is allowed after a piece
or it is not, and each boundary keeps one back-pointer or none.

The lattice is a stream: a boundary is extended once the longest piece's length
of text after it is known, so only boundaries within that length can still be
extended.  When the back-pointers of all these meet in one boundary, the ids up
to it are given out and the text before it is dropped.  A text is read in
slices.  Where the vocabulary has no piece across a boundary (before a space,
beside a line break, between a letter and a mark), all paths meet there, so a
short segment between two such is looked up in a bounded cache first and its
lattice ends there; a long one passes through the stream bit by bit.
"""

from __future__ import annotations

import codecs
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimcheck.llm._util import giving_back, prepare

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
CACHE = 250_000  # segments of one generation that a worker remembers
PAIRS = 500_000  # pairs of pieces that it remembers
SHORT = 64  # characters of a segment that is remembered
SLICE = 1 << 16  # characters of a text that are read at once, and ids that are decoded at once
BATCH_BYTES = 8 << 20  # texts that a task handles at once; a longer one is handled alone
UNIGRAM, BPE = 1, 2


class Vocabulary:
    """Pieces, scores and flags of a model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(sp.serialized_model_proto())
        norm, self.kind = proto.normalizer_spec, proto.trainer_spec.model_type
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models that leave texts as they are can be read")
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models can be read")
        self.prefix = norm.add_dummy_prefix
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte = [sp.unk_id()] * 256
        self.out: list[bytes] = []
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
                self.out.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.out.append(b"")
            else:
                self.ids[p], self.scores[p] = i, sp.get_score(i)
                self.out.append(p.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.ids))
        # by character: (piece that ends here, its id, or the character, or None; what may follow or None)
        self.trie: dict = {}
        for p, i in self.ids.items():
            kids = self.trie
            for n, c in enumerate(p, 1):
                node = kids.get(c)
                if node is None:
                    node = kids[c] = [c if n == 1 else None, None]
                if n == len(p):
                    node[0] = i
                else:
                    if node[1] is None:
                        node[1] = {}
                    kids = node[1]
        self.piece = {i: p for p, i in self.ids.items()}
        self.packed: dict[int | str, bytes] = {i: np.array([i], np.int32).tobytes() for i in self.piece}
        self.unknown = min(self.scores.values()) - 10.0
        many = [p for p in self.ids if len(p) > 1]
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in many) and not any("\n" in p for p in many)
        beside = {(a, b) for p in many for a, b in zip(p, p[1:], strict=False)}
        joined = {b for a, b in beside if a.isalnum()}
        self.marks = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in joined)
        # what may follow a piece; a piece is known by its id, a character without one by itself
        self.after: dict[int | str, dict[int | str, bool]] = {}
        self._known_pairs = 0

    def id_bytes(self, piece: int | str) -> bytes:
        known = self.packed.get(piece)
        return known if known is not None else np.array([self.byte[b] for b in piece.encode()], np.int32).tobytes()

    def score(self, piece: int | str) -> float:
        return self.unknown if isinstance(piece, str) else self.scores[self.piece[piece]]

    def row(self, left: int | str) -> dict[int | str, bool]:
        """What is known of the pieces after one; emptied when all rows hold too much."""
        if self._known_pairs > PAIRS:
            self.after, self._known_pairs = {}, 0
        row = self.after.get(left)
        if row is None:
            row = self.after[left] = {}
        return row

    def stable(self, left: int | str, right: int | str, row: dict[int | str, bool]) -> bool:
        """Whether merging the two pieces' characters gives just these pieces; remembered in ``row``."""
        a, b = self.piece.get(left, left), self.piece.get(right, right)
        ok = row[right] = self.merged(a + b) == ([a, b] if a else [b])
        self._known_pairs += 1
        return ok

    def merged(self, text: str) -> list[str]:
        """Merges of a short text: best score first, then the leftmost."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


class StreamingViterbi:
    """Feeds on text bit by bit; gives out ids as soon as they are certain."""

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self.text = ""  # what follows the last committed boundary
        self.at = 0  # the first boundary of it that is not extended yet
        self.back = [0]  # where the best path's piece that ends at each boundary begins; -1: no path
        self.last: list[int | str] = [""]  # that piece
        self.score: list[float] = [0.0]
        self.most = 0  # characters held at most, for tests

    def push(self, more: str, last: bool = False) -> bytes:
        """Extends the lattice; ids (int32) that no later text can change, all that are left if it is the last."""
        text = self.text = self.text + more if self.text else more
        n = len(text)
        if n > self.most:
            self.most = n
        room = n + 1 - len(self.back)
        self.back += [-1] * room
        self.last += [""] * room
        stop = n if last else n - self.v.longest
        if stop > self.at:
            if self.v.kind == BPE:
                self._extend_bpe(stop)
            else:
                self.score += [0.0] * room
                self._extend_unigram(stop)
            self.at = stop
        if last:
            return self._ids(n)
        return self._give(self._meeting()) if n > 2 * self.v.longest else b""

    def _extend_bpe(self, stop: int) -> None:
        """From each live boundary, the pieces that are stable after the one that ends there."""
        v, text, back, last = self.v, self.text, self.back, self.last
        trie, n = v.trie, len(text)
        for j in range(self.at, stop):
            if back[j] < 0:
                continue
            row = v.row(last[j])
            kids = trie
            for i in range(j, n):
                node = kids.get(text[i])
                if node is None:
                    if i == j and back[j + 1] < 0 and (row.get(text[j]) or v.stable(last[j], text[j], row)):
                        back[j + 1], last[j + 1] = j, text[j]
                    break
                piece, kids = node
                if piece is not None and back[i + 1] < 0:
                    ok = row.get(piece)
                    if ok or ok is None and v.stable(last[j], piece, row):
                        back[i + 1], last[i + 1] = j, piece
                if kids is None:
                    break

    def _extend_unigram(self, stop: int) -> None:
        """From each boundary, the pieces that make a better path; of equal ones the first start wins."""
        v, text, back, last, score = self.v, self.text, self.back, self.last, self.score
        n = len(text)
        for j in range(self.at, stop):
            kids = v.trie
            for i in range(j, n):
                node = kids.get(text[i])
                piece, kids = node if node is not None else (text[j] if i == j else None, None)
                if piece is not None:
                    s = score[j] + v.score(piece)
                    if back[i + 1] < 0 or s > score[i + 1]:
                        back[i + 1], last[i + 1], score[i + 1] = j, piece, s
                if kids is None:
                    break

    def _meeting(self) -> int:
        """The last boundary that the paths of all boundaries that can still be extended have in common."""
        live = {i for i in range(self.at, len(self.text) + 1) if self.back[i] >= 0}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(self.back[last])
        return live.pop() if live else 0

    def _ids(self, end: int) -> bytes:
        """The ids of the path to ``end``."""
        back, last, packed = self.back, self.last, self.v.packed
        out = []
        while end:
            out.append(packed.get(last[end]) or self.v.id_bytes(last[end]))
            end = back[end]
        out.reverse()
        return b"".join(out)

    def _give(self, end: int) -> bytes:
        """The ids of the path to ``end``, from where the lattice goes on."""
        out = self._ids(end)
        self.text = self.text[end:]
        self.back = [0, *(b - end if b >= 0 else -1 for b in self.back[end + 1 :])]
        self.last = self.last[end:]
        self.score = [s - self.score[end] for s in self.score[end:]] if self.v.kind == UNIGRAM else self.score
        self.at -= end
        return out


class Codec:
    """Encodes and decodes whole texts; keeps one worker's caches."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        word = f"{SPACE}*[^\\W_]+(?=[{re.escape(self.v.marks)}])|" if self.v.marks else ""
        self._segments = re.compile(f"{word}{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+")
        self._meets = re.compile(f"(?<=[^{SPACE}])(?={SPACE})|(?<=\n)|(?=\n)")  # boundaries that no piece crosses

    def _fresh(self, segment: str) -> bytes:
        """Ids of a segment that the younger generation does not know."""
        if len(segment) > SHORT:
            return StreamingViterbi(self.v).push(segment, last=True)
        ids = self.older.get(segment)
        if ids is None:
            ids = StreamingViterbi(self.v).push(segment, last=True)
        if len(self.known) >= CACHE:
            self.older, self.known = self.known, {}
        self.known[segment] = ids
        return ids

    def _ids(self, text: str):
        """The ids of a text in runs, read in slices."""
        prefix, splits = self.v.prefix, self.v.splits
        fresh, find = self._fresh, self._segments.findall
        held, stream = "", None  # the segment that the next slice may go on with; a segment longer than a slice
        for at in range(0, len(text), SLICE):
            piece = held + (SPACE if prefix and at == 0 else "") + text[at : at + SLICE].replace(" ", SPACE)
            held, last = "", at + SLICE >= len(text)
            if stream is None and not splits:
                stream = StreamingViterbi(self.v)
            if stream is not None:
                end = self._meets.search(piece, 1) if splits else None
                if end is None:
                    yield stream.push(piece, last)
                    continue
                yield stream.push(piece[: end.start()], last=True)
                stream, piece = None, piece[end.start() :]
            segments = find(piece)
            if not last and segments:
                held = segments.pop()
            known = self.known.get  # a generation that grows old meanwhile is still right
            yield b"".join([known(s) or fresh(s) for s in segments])
            if len(held) >= SLICE // 2:
                stream = StreamingViterbi(self.v)
                yield stream.push(held[:-1])
                held = held[-1:]  # its neighbour shows whether paths meet after it

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self._ids(text)), np.int32)

    def _texts(self, ids: np.ndarray):
        """The decoded text in runs."""
        out, utf8, first = self.v.out, codecs.getincrementaldecoder("utf-8")("replace"), self.v.prefix
        for at in range(0, len(ids), SLICE):
            more = utf8.decode(b"".join([out[i] for i in ids[at : at + SLICE].tolist()]), at + SLICE >= len(ids))
            if first and more:
                more, first = more.removeprefix(" "), False
            yield more

    def decode(self, ids: np.ndarray) -> str:
        return "".join(self._texts(ids))

    def decodes_to(self, ids: np.ndarray, text: str) -> bool:
        """Whether the ids decode to the text; holds neither twice."""
        at = 0
        for more in self._texts(ids):
            if not text.startswith(more, at):
                return False
            at += len(more)
        return at == len(text)


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def _bounded(t: pa.RecordBatch, col: str):
    """Runs of rows of at most BATCH_BYTES in a column, one row at least."""
    column = t.column(col)
    i = 0
    while i < t.num_rows:
        n = t.num_rows - i
        while n > 1 and column.slice(i, n).nbytes > BATCH_BYTES:
            n = (n + 1) // 2
        yield t.slice(i, n)
        i += n


def _added(df: DataFrame, source: str, added: list[tuple[str, T.DataType]], work) -> DataFrame:
    """``df`` with the columns (put in place of those of their names) that ``work`` makes of Arrow batches."""
    fresh = [n for n, _ in added]
    fields = [f for f in df.schema.fields if f.name not in fresh]
    names = [f.name for f in fields]

    def run(batches):
        for whole in batches:
            for t in _bounded(whole, source):
                yield pa.RecordBatch.from_arrays([*(t.column(c) for c in names), *work(t)], names=[*names, *fresh])

    return df.select([F.col(f"`{c}`") for c in df.columns]).mapInArrow(giving_back(run), T.StructType([*fields, *(T.StructField(n, k) for n, k in added)]))


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", model: str = MODEL, check_col: str | None = None) -> DataFrame:
    """``docs`` with the ids of each whole text as array<int>; other columns stay.

    ``check_col``: a further column that says whether the ids decode to the text.

    Defined cases: null and empty texts have no ids; characters without a
    piece become byte pieces; U+2581 is the model's own sign of a space, so a
    text that holds it decodes to one with spaces there and does not pass the
    check; repeated rows are encoded each; a column named ``ids_col`` is
    replaced; an empty table gives an empty result.  Texts of any length are a
    stream: besides the text and its ids a task holds a slice of it.
    """
    prepare(docs.sparkSession)

    def work(t):
        c = codec(model)
        column = t.column(text_col)
        ids, good = [], []
        for x in column:
            text = x.as_py() or ""
            ids.append(c.encode(text))
            if check_col:
                good.append(c.decodes_to(ids[-1], text))
        ends = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
        out = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))]
        return [*out, pa.array(good, pa.bool_())] if check_col else out

    added = [(ids_col, T.ArrayType(T.IntegerType()))] + ([(check_col, T.BooleanType())] if check_col else [])
    return _added(docs, text_col, added, work)


def decode(rows: DataFrame, ids_col: str = "ids", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``rows`` with the texts of their ids; null and empty ids give an empty text; other columns stay."""
    prepare(rows.sparkSession)

    def work(t):
        c = codec(model)
        col = t.column(ids_col)
        return [pa.array([c.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else "" for x in col], pa.string())]

    return _added(rows, ids_col, [(text_col, T.StringType())], work)
