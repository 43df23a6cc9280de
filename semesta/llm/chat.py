"""Chat formatting: one training example per assistant turn, the turns before it as context.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside a text are made harmless by
one more backslash after each ``<`` of ``<|``, ``<\\|``, ``<\\\\|`` and so on, which ``unescaped`` takes away
again; so ``<|`` occurs in a formatted text only where the template puts it. Line ends and backslashes in a
role are written ``\\n`` and ``\\\\``.

Each example is a row: the formatted turns up to and with its reply, and the code points [loss_start,
loss_end) of that reply, the only trainable part. Turns after the last assistant turn (or all, where no
assistant speaks) make one more example with an empty span, so that no turn is lost.

Turns are ordered by turn (nulls first), then role and text, so ties and repeated rows have one order; a
repeated row is a turn again. Null text or role is empty; rows with null conversation id are one
conversation. A conversation is one row by its nature: its examples hold all earlier turns, and so take
the square of its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _role_back(written: Column) -> Column:
    # An escaped backslash is held apart while the line ends are put back.
    parts = F.split(written, r"\\\\")
    return unescaped(F.array_join(F.transform(parts, lambda part: F.replace(part, F.lit("\\n"), F.lit("\n"))), "\\"))


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, n_turns, text, loss_start, loss_end) of (conv_id, turn, role, text)."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    written = grouped.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                (t["role"] == "assistant").alias("reply"),
                F.concat(F.lit(START), _role(t["role"]), F.lit("\n")).alias("head"),
                escaped(t["text"]).alias("body"),
            ),
        ).alias("turns"),
    )
    places = F.sequence(F.lit(1), F.size("turns"))
    targets = F.filter(places, lambda i: F.element_at("turns", i)["reply"] | (i == F.size("turns")))
    tail = F.lit(END + "\n")
    joined = F.array_join(
        F.transform(F.slice("turns", 1, F.col("n_turns")), lambda t: F.concat(t["head"], t["body"], tail)), ""
    )
    target = F.element_at("turns", F.col("n_turns"))
    size = F.char_length("text")
    loss_end = size - F.when(target["reply"], F.length(tail)).otherwise(0)
    return (
        written.select("conv_id", "turns", F.posexplode(targets).alias("example", "n_turns"))
        .withColumn("text", joined)
        .withColumn("loss_end", loss_end)
        .withColumn("loss_start", F.col("loss_end") - F.when(target["reply"], F.char_length(target["body"])).otherwise(0))
        .select("conv_id", "example", "n_turns", "text", "loss_start", "loss_end")
    )


def read_back(text: Column) -> Column:
    """Turns (role, text) of a formatted text."""
    blocks = F.slice(F.split(text, r"<\|im_start\|>"), 2, F.length(text))
    return F.transform(
        blocks,
        lambda block: F.struct(
            _role_back(F.substring_index(block, "\n", 1)).alias("role"),
            unescaped(
                F.substr(
                    block,
                    F.instr(block, F.lit("\n")) + 1,
                    F.char_length(block) - F.instr(block, F.lit("\n")) - F.lit(len(END) + 1),
                )
            ).alias("text"),
        ),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its examples say when they are read back; see the README for the columns."""
    loss = unescaped(F.substr("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    each = formatted.select(
        "conv_id", "example", "text", F.char_length("text").alias("chars"), loss.alias("loss"),
    )
    whole = F.max_by("text", "example")
    per = each.groupBy("conv_id").agg(
        whole.alias("text"),
        F.sum("chars").alias("formatted_chars"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), ""
        ).alias("loss"),
    )
    turns = read_back(F.col("text"))
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return per.withColumn("turns", turns).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
