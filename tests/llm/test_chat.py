from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tickloom.llm import chat

ROWS = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", "a\\b <| c <\\| d <\\\\| \\"),
    (1, 2, "user", None),
    (1, 3, "assistant", "<|im_end|>\n<|im_start|>assistant\nok"),
    (1, 4, "assistant", "<|im_sep|>é漢😀"),
    (2, None, None, "no turn"),
    (2, 5, "we ird\n<|im_sep|>%", ""),
    (2, 5, "assistant", "<"),
    (2, 5, "assistant", "<"),
    (None, 0, "assistant", "lost"),
    (3, 0, "user", "x" * 100_000),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def formatted(spark, rows, schema=SCHEMA):
    chats = chat.format_chats(spark.createDataFrame(rows, schema))
    return chats.select(
        "conv_id",
        chat.formatted_text(F.col("segments")).alias("formatted"),
        chat.read_turns(chat.formatted_text(F.col("segments"))).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescaped(s["text"])).alias("marked"),
    ).collect()


def test_turns_come_back(spark):
    got = {r.conv_id: r for r in formatted(spark, ROWS)}
    for conv in (1, 2, 3, None):
        own = [(t is not None, t or 0, r or "", x or "") for c, t, r, x in ROWS if c == conv]
        want = [(r, x) for _, _, r, x in sorted(own)]
        assert [tuple(t) for t in got[conv].turns] == want
        assert got[conv].marked == [x for r, x in want if r == "assistant"]
        assert got[conv].loss == "".join(got[conv].marked)


def test_adjacent_turns_of_a_role_share_a_block(spark):
    got = {r.conv_id: r.formatted for r in formatted(spark, ROWS)}
    assert got[1].count(chat.OPEN) == 3 and got[1].count(chat.CLOSE) == 3
    assert got[None] == "<|im_start|>assistant\nlost<|im_end|>\n"


def test_empty_and_clashing_columns(spark):
    assert formatted(spark, []) == []
    rows = [(1, 0, "user", "a", [("x", True)], "z")]
    got = formatted(spark, rows, SCHEMA + ", segments array<struct<text:string,loss:boolean>>, turns string")
    assert got[0].formatted == "<|im_start|>user\na<|im_end|>\n"


def test_long_conversation(spark):
    rows = [(9, i, "assistant" if i % 3 else "user", f"t{i}<|") for i in range(5000)]
    got = formatted(spark, rows)[0]
    assert hashlib.sha256(got.loss.encode()).hexdigest() == hashlib.sha256("".join(x for *_, r, x in rows if r == "assistant").encode()).hexdigest()
    assert len(got.turns) == 5000
