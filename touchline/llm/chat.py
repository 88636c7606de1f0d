"""Chat formatting with Spark expressions only.

Method: the turns of a conversation are collected as structs and sorted; neighbours in the array that have the same
role are merged into one block; the pieces are concatenated. No Python runs on the executors, and the one shuffle is
the grouping by conversation. Each output row is one whole conversation, so a conversation must fit in a task; the
arrays are only mapped, never grown turn by turn, so the work is linear in its length.

The template, with `…` for what a turn gives:

    <|im_start|>…role…
    …text…<|im_next|>…text…<|im_end|>

Texts and roles can't forge a mark: inside them `<|`, `<!|`, `<!!|` and so on get one more `!`, so `<|` never occurs;
unescaping takes it away again. A line feed in a role, which would end the header, is written as `<|line|>`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, STOP, LINE = "<|im_start|>", "<|im_next|>", "<|im_end|>", "<|line|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(!*)\|", r"<!$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<!(!*)\|", r"<$1|")


def _split(text: Column, mark: str) -> Column:
    return F.split(text, mark.replace("|", r"\|"))


def format_chat(turns: DataFrame, key: str = "conv_id", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: key, `formatted`, and `segments` (array of struct text, loss).

    `turns` has the columns key, turn, role and text. The segments joined are `formatted`; those with loss = true are
    the texts of roles in `learn`, the loss mask. A null text or role counts as empty; a null turn comes first; rows of
    one turn come in the order of role and text, and repeated rows stay; rows with a null key form one conversation; an
    empty table gives no row; other columns don't matter.
    """
    role, text = F.coalesce(turns["role"].cast("string"), F.lit("")), F.coalesce(turns["text"].cast("string"), F.lit(""))
    source = turns.select(turns[key].alias("key"), F.struct(turns["turn"].alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    sorted_ = source.groupBy("key").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    def of_turn(t: Column, i: Column) -> Column:
        def differs(j: Column) -> Column:
            return ~F.coalesce(F.get(F.col("ts"), j)["role"] == t["role"], F.lit(False))

        header = F.concat(F.lit(START), F.replace(escape(t["role"]), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
        opening = F.when(differs(i - 1), header).otherwise(F.lit(NEXT))
        closing = F.when(differs(i + 1), F.lit(f"{STOP}\n")).otherwise(F.lit(""))
        piece = lambda c, loss: F.struct(c.alias("text"), loss.alias("loss"))
        return F.array(piece(opening, F.lit(False)), piece(escape(t["text"]), t["role"].isin(*learn)), piece(closing, F.lit(False)))

    pieces = sorted_.select(F.col("key").alias(key), F.flatten(F.transform("ts", of_turn)).alias("segments"))
    return pieces.select(key, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_chat(formatted: Column) -> Column:
    """The turns (array of struct role, text) that a formatted conversation holds."""
    split = _split(formatted, START)
    blocks = F.slice(split, 2, F.size(split))

    def turns_of(block: Column) -> Column:
        header = F.substring_index(block, "\n", 1)
        role = unescape(F.replace(header, F.lit(LINE), F.lit("\n")))
        body = F.substring_index(F.substr(block, F.length(header) + 2), STOP, 1)
        return F.transform(_split(body, NEXT), lambda text: F.struct(role.alias("role"), unescape(text).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
