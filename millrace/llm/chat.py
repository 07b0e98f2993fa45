"""Chat formatting: turns sorted, same-role neighbours merged, concatenated; Spark expressions only.

A conversation becomes blocks ``<turn ROLE>\\n text [<next>\\n text ...] </turn>\\n``. Neighbouring
turns of one role share a block, with ``<next>`` where one turn ends, so the turns can be read
back. Texts and roles are escaped: ``\\`` is written ``\\b``, ``<`` ``\\l`` and ``>`` ``\\g``. No
escaped text holds ``<``, so nothing a user writes can look like a control string.

Defined results: a null text or role is empty; a null conv_id is a conversation of its own;
repeated rows stay, rows with one turn number are ordered by role and text; no rows give no
rows; other columns are ignored. One row per conversation is the result, so a conversation has
to fit one row; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NEXT = "<next>\n"
END = "</turn>\n"


def escape(text: Column) -> Column:
    for plain, written in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in (("<", "\\l"), (">", "\\g"), ("\\", "\\b")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _blocks(turns: Column) -> Column:
    """Runs of one role: array of (role, texts). Starts of runs are found by position, then sliced."""
    place = F.sequence(F.lit(0), F.size(turns) - 1)
    starts = F.filter(
        place,
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, F.greatest(i - 1, F.lit(0)))["role"]),
    )
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(turns)))
    spans = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.transform(
        spans,
        lambda s: F.struct(
            F.get(turns, s["a"])["role"].alias("role"),
            F.slice(turns, s["a"] + 1, s["b"] - s["a"])["text"].alias("texts"),
        ),
    )


def _pieces(block: Column) -> Column:
    """What a block writes, in order: (text, loss). Loss is on the assistant's texts alone."""
    loss = block["role"] == "assistant"

    def one(text: Column, i: Column) -> Column:
        head = F.when(i == 0, F.concat(F.lit("<turn "), escape(block["role"]), F.lit(">\n"))).otherwise(F.lit(NEXT))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(text).alias("text"), loss.alias("loss")),
        )

    close = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    return F.concat(F.flatten(F.transform(block["texts"], one)), close)


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, pieces) from (conv_id, turn, role, text).

    ``pieces`` is the loss mask: (text, loss) in order; their texts joined are ``formatted``.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return (
        turns.select("conv_id", turn.alias("t"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("turns"))
        .select("conv_id", _blocks(F.col("turns")).alias("blocks"))
        .select("conv_id", F.flatten(F.transform("blocks", _pieces)).alias("pieces"))
        .select("conv_id", F.array_join(F.col("pieces")["text"], "").alias("formatted"), "pieces")
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.regexp_replace(b, r"\A<turn [^>]*>\n", ""), NEXT),
                lambda t: F.struct(
                    unescape(F.regexp_extract(b, r"\A<turn ([^>]*)>\n", 1)).alias("role"),
                    unescape(t).alias("text"),
                ),
            ),
        )
    )


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return unescape(F.array_join(F.filter(pieces, lambda p: p["loss"])["text"], ""))
