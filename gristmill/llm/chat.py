"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns are its context and only
that reply is trainable. A conversation that doesn't end in an assistant turn also gets one example
without a target, so that the output holds every turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"


def escape(c: Column) -> Column:
    r"""Make control strings impossible inside a text: each `<` and `[` is followed by a backslash.

    Backslashes are doubled first, so the change can be undone. Nothing that starts with `<` or `[`
    (`<|start|>`, `</s>`, `[INST]`) survives in one piece.
    """
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit("<"), F.lit("<\\"))
    return F.replace(c, F.lit("["), F.lit("[\\"))


def unescape(c: Column) -> Column:
    c = F.replace(c, F.lit("[\\"), F.lit("["))
    c = F.replace(c, F.lit("<\\"), F.lit("<"))
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def chat_examples(conversations: DataFrame, target_role: str = "assistant") -> DataFrame:
    """(conv_id, example, text, loss_start, loss_chars): one row per assistant turn.

    `text` is the formatted context and reply; the loss mask covers `loss_chars` code points from
    `loss_start` (0-based). Turns are taken in order of (turn, role, text), so repeated turn numbers
    have a fixed order. Null role or text is the empty string; a null turn comes first; rows of a
    null conv_id form one conversation. Other columns are ignored. No rows in, no rows out.
    """
    rows = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    marked = turns.select(
        "conv_id",
        F.transform("ts", lambda t: t["role"] == target_role).alias("is_target"),
        F.transform("ts", lambda t: escape(t["text"])).alias("texts"),
        F.transform("ts", lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(SEP), escape(t["text"]), F.lit(END))).alias("parts"),
    )
    n = F.size("parts")
    targets = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("is_target", i))
    places = F.when(F.element_at("is_target", -1), targets).otherwise(F.concat(targets, F.array(n + 1)))
    each = marked.select("*", F.posexplode(places).alias("example", "at"))
    context = F.array_join(F.slice("parts", F.lit(1), F.col("at") - 1), "")
    has_target = F.col("at") <= n
    prompt = F.concat(context, F.when(has_target, F.lit(f"{START}{target_role}{SEP}")).otherwise(F.lit("")))
    reply = F.when(has_target, F.try_element_at("texts", F.col("at"))).otherwise(F.lit(""))
    made = each.select("conv_id", "example", prompt.alias("prompt"), reply.alias("reply"), has_target.alias("has_target"))
    return made.select(
        "conv_id",
        "example",
        F.concat("prompt", "reply", F.when(F.col("has_target"), F.lit(END)).otherwise(F.lit(""))).alias("text"),
        F.length("prompt").cast("long").alias("loss_start"),
        F.length("reply").cast("long").alias("loss_chars"),
    )


def parse_turns(text: Column) -> Column:
    """The turns of a formatted text: array of (role, text), unescaped."""
    parts = F.filter(F.split(text, r"<\|end\|>"), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(START) + 1)), SEP, 1)).alias("role"),
            unescape(F.substring_index(p, SEP, -1)).alias("text"),
        ),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples say: turns, loss text and sizes, all from the formatted text.

    The last example of a conversation holds every turn; the loss texts are those under each
    example's mask, in order. Grouping by conv_id keeps the partitioning of `chat_examples`.
    """
    masked = examples.select(
        "conv_id",
        "example",
        "text",
        unescape(F.substr("text", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int"))).alias("loss"),
        F.length("text").cast("long").alias("n"),
    )
    by = masked.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("last"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("n").alias("formatted_chars"),
    )
    read = by.select("conv_id", parse_turns(F.col("last")).alias("turns"), F.array_join(F.col("losses.loss"), "").alias("loss"), "formatted_chars")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
