r"""Relational chat formatting (operator 7).

The turns of a conversation are collected as structs and sorted by turn;
adjacent turns of one role share one header.  The formatted text is

    <|role|>ROLE<|text|>TEXT<|next|>TEXT ...<|end|><|role|> ...

Inside roles and texts a backslash is doubled and `<|` becomes `<\|`, so no
control string can occur there, and reading is the exact reverse.  The loss
mask is a list of (start, length) in code points of the formatted text, one
for each assistant turn's escaped text; their sums run over the turns in a
window, so long conversations cost no more a turn than short ones.

Null texts and roles are empty.  Rows with equal turn numbers are ordered by
role and text; repeated rows are turns of their own; a null turn comes first.
Rows with a null conversation id form one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLE, TEXT, NEXT, END = "<|role|>", "<|text|>", "<|next|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _literal(marker: str) -> str:
    return marker.replace("|", r"\|")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: its id, messages, formatted and loss.

    `messages` are the merged turns (role, texts), `loss` the spans under the
    loss mask (start, length), `formatted` the text.
    """
    own = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.lag("role").over(order)
    header = F.concat(F.lit(ROLE), escape(F.col("role")), F.lit(TEXT))
    lead = F.when(before.isNull(), header).when(before == F.col("role"), F.lit(NEXT)) \
        .otherwise(F.concat(F.lit(END), header))
    pieces = own.withColumn("lead", lead).withColumn("body", escape(F.col("text"))) \
        .withColumn("size", F.length("body"))
    placed = pieces.withColumn("start", F.coalesce(F.sum(F.length("lead") + F.col("size")).over(so_far), F.lit(0))
                               + F.length("lead"))
    fields = ["turn", "role", "text", "start", "size", "lead", "body"]
    sorted_turns = placed.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("t"))
    # Each header's run of turns ends where the next header begins.
    merged = sorted_turns.withColumn("h", F.filter(
        F.transform("t", lambda x, i: F.struct(i.alias("i"), x["role"].alias("role"), (x["lead"] == NEXT).alias("joins"))),
        lambda x: ~x["joins"])).withColumn(
        "bounds", F.concat(F.transform("h", lambda x: x["i"]), F.array(F.size("t"))))
    messages = F.transform("h", lambda x, k: F.struct(
        x["role"].alias("role"),
        F.transform(F.slice("t", x["i"] + 1, F.get("bounds", k + 1) - x["i"]), lambda y: y["text"]).alias("texts")))
    loss = F.transform(F.filter("t", lambda x: x["role"] == loss_role),
                       lambda x: F.struct(x["start"].cast("long").alias("start"), x["size"].cast("long").alias("length")))
    formatted = F.concat(F.array_join(F.transform("t", lambda x: F.concat(x["lead"], x["body"])), ""), F.lit(END))
    return merged.select(F.col("conv").alias(conv_col), messages.alias("messages"), formatted.alias("formatted"),
                         loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, one for each original row."""
    runs = F.filter(F.split(formatted, _literal(END), -1), lambda s: s != "")
    parts = F.transform(runs, lambda s: F.split(F.substr(s, F.lit(len(ROLE) + 1)), _literal(TEXT), 2))
    return F.flatten(F.transform(parts, lambda p: F.transform(
        F.split(F.get(p, F.lit(1)), _literal(NEXT), -1),
        lambda t: F.struct(unescape(F.get(p, F.lit(0))).alias("role"), unescape(t).alias("text")))))


def masked_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digest(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and hashes of what the formatted texts and masks read back as."""
    back = chats.select(conv_col, "formatted", read_turns(F.col("formatted")).alias("turns"),
                        masked_text(F.col("formatted"), F.col("loss")).alias("masked"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
