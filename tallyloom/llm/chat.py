"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, its reply alone trainable. Turns behind
the last reply, or a conversation without one, make one more example in which nothing is trainable, so that the output holds
every turn. Marks of the template inside texts and roles are escaped, and can be read back.

Turns are ordered by (turn, role, text), nulls first; a null role or text counts as empty; a repeated row is a turn of its
own; rows without a conversation id form one conversation. An empty table gives no examples; other columns are left out, so no
name can clash. The output grows with the square of a conversation's turns, as the
method asks; a conversation is one training text and is put together in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Strings with a meaning for this template or for common others.
CONTROL = [START, SEPARATOR, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
TARGET = "assistant"


def escaped(text: Column) -> Column:
    """Double every backslash, then part each control string behind its first character by one."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted_turn(turn: Column) -> Column:
    return F.concat(F.lit(START), escaped(turn["role"]), F.lit(SEPARATOR), escaped(turn["text"]), F.lit(END + "\n"))


def examples(conversations: DataFrame) -> DataFrame:
    """One row per example of (conv_id, turn, role, text) rows.

    ``formatted`` is the whole text, ``loss_start`` and ``loss_length`` the span of it that is trained on, in characters;
    ``last`` marks the example that holds all turns of its conversation.
    """
    empty = F.lit("")
    turn = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")
    places = F.filter(F.sequence(F.lit(1), n), lambda i: (F.get("turns", i - 1)["role"] == TARGET) | (i == n))
    placed = grouped.select(
        "conv_id",
        F.transform("turns", formatted_turn).alias("pieces"),
        F.transform("turns", lambda one: one["role"] == TARGET).alias("targets"),
        F.posexplode(places).alias("example", "upto"),
        n.alias("n"),
    )
    trainable = F.get("targets", F.col("upto") - 1)
    head = len(START + TARGET + SEPARATOR)
    context = F.array_join(F.slice("pieces", F.lit(1), F.col("upto") - 1), "")
    piece = F.get("pieces", F.col("upto") - 1)
    return placed.select(
        "conv_id",
        "example",
        F.col("upto").alias("n_turns"),
        F.concat(context, piece).alias("formatted"),
        F.when(trainable, F.char_length(context) + head).alias("loss_start"),
        F.when(trainable, F.char_length(piece) - head - len(END + "\n")).alias("loss_length"),
        (F.col("upto") == F.col("n")).alias("last"),
    )


def turns_of(formatted: Column) -> Column:
    """The (role, text) turns of a formatted text, unescaped."""
    pieces = F.split(formatted, r"\Q" + END + r"\E\n")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # what follows the last end is empty
    return F.transform(
        pieces,
        lambda piece: F.struct(
            unescaped(F.substring_index(F.substr(piece, F.lit(len(START) + 1)), SEPARATOR, 1)).alias("role"),
            unescaped(F.substring_index(piece, SEPARATOR, -1)).alias("text"),
        ),
    )


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation what is read back from its examples: turns, trained text, and the length of all examples."""
    loss = F.substr("formatted", F.col("loss_start") + 1, F.col("loss_length"))
    read = rows.select(
        "conv_id",
        F.when(F.col("loss_start").isNotNull(), F.struct("example", unescaped(loss).alias("text"))).alias("loss"),
        F.when(F.col("last"), turns_of(F.col("formatted"))).alias("turns"),
        F.char_length("formatted").cast("long").alias("chars"),
    )
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read.select("conv_id", "loss", "chars", F.size("turns").alias("n"), F.sha2(written, 256).alias("sha"))
    whole = read.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"),
        F.max("sha").alias("turns_sha256"),
        F.sort_array(F.collect_list("loss")).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    text = F.array_join(F.transform("losses", lambda one: one["text"]), "")
    return whole.select("conv_id", "n_turns", "turns_sha256", text.alias("loss_text"), "formatted_chars").select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )
