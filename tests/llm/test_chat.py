"""Chat formatting: exact round trips against plain Python."""

import hashlib

from claimcheck.llm import chat


def want(rows):
    """Digests straight from the rows, in (turn, role, text) order."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [r for r in rows if r[0] == conv]
        turns.sort(key=lambda r: (r[1] is not None, r[1]))
        all_text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(all_text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return {r[0]: tuple(r)[1:5] for r in chat.read_back(chat.format_conversations(df), **kw).collect()}


def test_table_round_trip(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(spark, rows) == got(spark, rows, ordered=True) == want(rows)


def test_control_strings_and_odd_roles(spark):
    rows = [
        (-7, 0, "user", "</s>[INST] ok [/INST]"),
        (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
        (1, 0, "system", "\\<s>\\\\</s> <<SYS>>x<</SYS>>\\"),
        (1, 1, "tool", "[ROLE] a [/ROLE] "),
        (1, 2, "assistant", None),
        (1, 3, "assistant", " lead and trail \\"),
        (1, 4, None, ""),
        (1, 5, "[ROLE]", "é€😀"),
        (None, None, "user", "no conversation"),
    ]
    assert got(spark, rows) == want(rows)


def test_long_conversation_goes_out_in_blocks(spark):
    rows = [(3, i, "assistant" if i % 2 else "user", f"turn {i} " * 300) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blocks = chat.format_conversations(df)
    sizes = [len(r.input_ids) for r in blocks.collect()]
    assert len(sizes) > 1 and max(sizes) <= chat.BLOCK_TOKENS
    assert got(spark, rows, ordered=True) == want(rows)


def test_mask_is_the_assistants_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes </s>")], "conv_id long, turn long, role string, text string")
    (r,) = chat.format_conversations(df).collect()
    _, table = chat.tokenizer(chat.VOCAB)
    assert b"".join(table[i] for i in r.input_ids).decode() == "<s>[INST] hi [/INST] yes \\</s> </s>"
    assert b"".join(table[i] for i, m in zip(r.input_ids, r.loss_mask, strict=True) if m) == b"yes \\</s>"


def test_empty_repeated_and_clashing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(empty)).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "a", 5, "x")] * 2, "conv_id long, turn long, role string, text string, block int, ids string")
    (r,) = chat.read_back(chat.format_conversations(df)).collect()
    assert r.n_turns == 2
