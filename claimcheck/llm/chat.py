r"""Chat formatting at token level (operator 1).

Each text is encoded on its own and reserved ids are spliced between the
pieces, so no token ever spans a control string.  Rendered as text the
template is

    <s>[INST] user [/INST] assistant </s><<SYS>> system <</SYS>> [ROLE] name [/ROLE] other </s>

with a conversation's turns in order of (turn, role, tokens).  A control
string inside a text gets one backslash more in front of it; reading takes it
off again, so texts come back exactly.  The loss mask covers the assistants'
texts: +1 and -1 at their ends, summed up along the row.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimcheck.llm._util import prepare

VOCAB = "/opt/tokenizers/byte_bpe_50k.tiktoken"
FIRST_RESERVED = 50257
BLOCK_TOKENS = 1 << 16  # tokens in one output row at most

# Control strings and how each is rendered, in order of their ids.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
RENDERED = ["<s>", " </s>", "[INST] ", " [/INST] ", "<<SYS>> ", " <</SYS>> ", "[ROLE] ", " [/ROLE] "]
BOS, EOS, USER, USER_END, SYS, SYS_END, ROLE, ROLE_END = range(FIRST_RESERVED, FIRST_RESERVED + len(CONTROL))

_ANY = "|".join(re.escape(c) for c in CONTROL)
_ESCAPE = re.compile(rf"(?={_ANY})")
_UNESCAPE = re.compile(rf"\\(?={_ANY})")


def escape(text: str) -> str:
    """Puts one backslash before each control string."""
    return _ESCAPE.sub(r"\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub("", text)


@cache
def tokenizer(path: str):
    """(encode, bytes of each id) of a rank file; ids from FIRST_RESERVED on are ours."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (FIRST_RESERVED + len(CONTROL))
    for piece, i in ranks.items():
        table[i] = piece
    for i, r in enumerate(RENDERED):
        table[FIRST_RESERVED + i] = r.encode()
    return enc.encode_ordinary, table


_ENDS = {USER: USER_END, SYS: SYS_END}
_OPENS = {"user": USER, "system": SYS}


def _turn(role: str | None, content: np.ndarray, encode) -> tuple[list[np.ndarray], bool]:
    """A turn's pieces, the text always second but last; whether it counts for the loss."""
    if role == "assistant":
        return [np.zeros(0, np.int32), content, np.array([EOS], np.int32)], True
    if role in _OPENS:
        start = _OPENS[role]
        return [np.array([start], np.int32), content, np.array([_ENDS[start]], np.int32)], False
    name = encode(escape(role or ""))
    return [np.array([ROLE, *name, ROLE_END], np.int32), content, np.array([EOS], np.int32)], False


def format_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    vocab: str = VOCAB,
) -> DataFrame:
    """(conv_id, block, input_ids, loss_mask): each conversation as one or more rows of ids.

    Encoding runs before the shuffle, row by row; the assembly is a stream over
    rows sorted by conversation and turn, and a conversation of any length goes
    out in blocks of at most BLOCK_TOKENS ids, so no conversation is ever held
    whole.  The result is partitioned by conversation, blocks in order.

    Defined cases: a null text is empty; a null role is the role "" in ROLE
    marks, as is any role but user, assistant and system; rows with a null
    conversation form one; null turns come first; equal turns go by role, then
    tokens; repeated rows stay; other columns are ignored; an empty table gives
    no rows.
    """
    prepare(rows.sparkSession)

    def encode_rows(batches):
        encode, _ = tokenizer(vocab)
        for t in batches:
            ids = [np.array(encode(escape(x or "")), np.int32).tobytes() for x in t.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [t.column("conv_id"), t.column("turn"), t.column("role"), pa.array(ids, pa.binary())],
                names=["conv_id", "turn", "role", "ids"],
            )

    def assemble(batches):
        encode, _ = tokenizer(vocab)
        state = {"conv": None, "open": False, "block": 0}
        parts: list[np.ndarray] = []
        deltas: list[tuple[int, int]] = []
        size = 0
        out: list[tuple] = []

        def flush(carry: int = 0):
            nonlocal size
            if size:
                ids = np.concatenate(parts)
                change = np.zeros(len(ids) + 1, np.int8)
                for at, d in deltas:
                    change[at] += d
                out.append((state["conv"], state["block"], ids, np.cumsum(change[:-1], dtype=np.int8)))
                state["block"] += 1
            parts.clear()
            deltas.clear()
            size = 0
            if carry:
                deltas.append((0, 1))

        def put(ids: np.ndarray, loss: bool):
            nonlocal size
            if loss:
                deltas.append((size, 1))
            while len(ids):
                take = ids[: BLOCK_TOKENS - size]
                parts.append(take)
                size += len(take)
                ids = ids[len(take) :]
                if size == BLOCK_TOKENS and len(ids):
                    flush(int(loss))
            if loss:
                deltas.append((size, -1))
            if size == BLOCK_TOKENS:
                flush()

        for t in batches:
            for conv, role, raw in zip(t.column("conv_id").to_pylist(), t.column("role").to_pylist(), t.column("ids").to_pylist(), strict=True):
                if not state["open"] or conv != state["conv"]:
                    flush()
                    state.update(conv=conv, open=True, block=0)
                    put(np.array([BOS], np.int32), False)
                (head, text, tail), loss = _turn(role, np.frombuffer(raw, np.int32), encode)
                put(head, False)
                put(text, loss)
                put(tail, False)
            if out:
                yield _blocks(out)
                out.clear()
        flush()
        if out:
            yield _blocks(out)

    src = rows.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    return (
        src.mapInArrow(encode_rows, "conv_id long, turn long, role string, ids binary")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "ids")
        .mapInArrow(assemble, "conv_id long, block int, input_ids array<int>, loss_mask array<byte>")
    )


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0), kind))


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    conv, block, ids, mask = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, pa.int64()), pa.array(block, pa.int32()), _lists(ids, pa.int32()), _lists(mask, pa.int8())],
        names=["conv_id", "block", "input_ids", "loss_mask"],
    )


class _Reader:
    """Turns, loss text and sizes of one conversation, from its blocks in order."""

    def __init__(self, table):
        self.table = table
        self.turns, self.turn_hash = 0, hashlib.sha256()
        self.loss_chars, self.loss_hash = 0, hashlib.sha256()
        self.chars = 0
        self.role, self.name = "assistant", None
        self.text: list[np.ndarray] = []
        self.loss: list[np.ndarray] = []

    def _bytes(self, parts: list[np.ndarray]) -> str:
        table = self.table
        return unescape(b"".join(table[i] for p in parts for i in p.tolist()).decode())

    def _end(self):
        text, loss = self._bytes(self.text), self._bytes(self.loss)
        self.turn_hash.update(f"{self.role}\n{text}\n".encode())
        self.loss_hash.update(loss.encode())
        self.loss_chars += len(loss)
        self.turns += 1
        self.role, self.text, self.loss = "assistant", [], []

    def feed(self, ids: np.ndarray, mask: np.ndarray):
        table = self.table
        self.chars += int((np.frombuffer(b"".join(table[i] for i in ids.tolist()), np.uint8) & 0xC0 != 0x80).sum())
        marks = np.flatnonzero(ids >= FIRST_RESERVED)
        at = 0
        for m in [*marks.tolist(), len(ids)]:
            if m > at:
                self.text.append(ids[at:m])
                inside = mask[at:m] > 0
                if inside.any():
                    self.loss.append(ids[at:m][inside])
            at = m + 1
            if m == len(ids):
                break
            mark = int(ids[m])
            if mark == USER:
                self.role = "user"
            elif mark == SYS:
                self.role = "system"
            elif mark == ROLE_END:
                self.role, self.text = self._bytes(self.text), []
            elif mark in (EOS, USER_END, SYS_END):
                self._end()

    def row(self, conv):
        return conv, self.turns, self.turn_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(blocks: DataFrame, vocab: str = VOCAB, ordered: bool = False) -> DataFrame:
    """What the formatted rows say, by their ids and masks alone: a row for each conversation.

    ``ordered``: the blocks already lie by conversation and block, as
    ``format_conversations`` leaves them; else they are dealt and sorted.
    """

    def run(batches):
        _, table = tokenizer(vocab)
        conv, reader, done = None, None, []
        for t in batches:
            for c, block, ids, mask in zip(t.column("conv_id").to_pylist(), t.column("block").to_pylist(), t.column("input_ids"), t.column("loss_mask"), strict=True):
                if block == 0:
                    if reader:
                        done.append(reader.row(conv))
                    conv, reader = c, _Reader(table)
                reader.feed(ids.values.to_numpy(zero_copy_only=False), mask.values.to_numpy(zero_copy_only=False))
            if done:
                yield _rows(done)
                done = []
        if reader:
            yield _rows([reader.row(conv)])

    if not ordered:
        blocks = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return blocks.select("conv_id", "block", "input_ids", "loss_mask").mapInArrow(run, READ)


def _rows(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in READ.split(", ")])
