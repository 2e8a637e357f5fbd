"""Chat formatting in Spark expressions: turns to one marked text with a loss mask, and back.

Template: adjacent turns of one role form a block

    <|im_start|>role \\n text <|im_sep|> text <|im_end|> \\n

The role is URL-encoded. In texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text holds a mark and
``unescaped`` restores it exactly.

Cases: a null role or text is empty; a null turn sorts first; turns with equal numbers are ordered by role, then
text; repeated rows are turns of their own; rows with a null ``conv_id`` form one conversation; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, NEXT, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_chats(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id`` and ``segments`` (text, loss), whose texts in order are the formatted text.

    A segment under the loss mask is exactly one escaped text of ``trained_role``.
    """

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    all_turns, n = F.col("turns"), F.size("turns")
    chats = chats.withColumn(
        "starts",
        F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: ~F.get(all_turns, i - 1)["role"].eqNullSafe(F.get(all_turns, i)["role"]),
        ),
    )
    starts = F.col("starts")
    blocks = chats.select(
        "conv_id",
        F.transform(
            starts,
            lambda s, j: F.struct(
                F.get(all_turns, s)["role"].alias("role"),
                F.slice(all_turns, s + 1, F.coalesce(F.get(starts, j + 1), n) - s)["text"].alias("texts"),
            ),
        ).alias("blocks"),
    )

    def block_segments(b: Column) -> Column:
        texts = F.transform(
            b["texts"],
            lambda t, i: F.array(
                segment(F.when(i > 0, F.lit(NEXT)).otherwise(F.lit("")), no),
                segment(escaped(t), b["role"] == trained_role),
            ),
        )
        head = segment(F.concat(F.lit(OPEN), F.url_encode(b["role"]), F.lit("\n")), no)
        return F.concat(F.array(head), F.flatten(texts), F.array(segment(F.lit(CLOSE), no)))

    return blocks.select("conv_id", F.flatten(F.transform("blocks", block_segments)).alias("segments"))


def formatted_text(segments: Column) -> Column:
    return F.array_join(segments["text"], "")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, one for each row that was formatted."""

    def literal(mark: str) -> str:
        return "\\Q" + mark + "\\E"

    def block_turns(block: Column) -> Column:
        role = F.url_decode(F.substring_index(block, "\n", 1))
        body = F.substr(block, F.instr(block, "\n") + 1)
        return F.transform(
            F.split(body, literal(NEXT)), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text"))
        )

    blocks = F.split(formatted, literal(CLOSE))
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)
    return F.flatten(F.transform(blocks, lambda b: block_turns(F.substr(b, F.lit(len(OPEN) + 1)))))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    marked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(marked, lambda s: unescaped(s["text"])), "")
