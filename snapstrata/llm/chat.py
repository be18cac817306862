"""Chat formatting with Spark expressions only: one text per conversation and its loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE, TEXT, NEXT, END = "<|role|>", "<|text|>", "<|next|>", "<|end|>"
#: Besides our own marks, which all start with ``<|``, marks of other templates are made harmless.
CONTROL = r"<(\\*)(\||/?s>)"
OTHER_CONTROL = r"\[(\\*)(/?INST\])"
ESCAPED = r"<\\(\\*)(\||/?s>)"
OTHER_ESCAPED = r"\[\\(\\*)(/?INST\])"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """One backslash after the first character of each control string, escaped ones too."""
    once = F.regexp_replace(text, CONTROL, r"<\\$1$2")
    return F.regexp_replace(once, OTHER_CONTROL, r"[\\$1$2")


def unescape(text: Column) -> Column:
    """Takes away the backslash that :func:`escape` has put in."""
    once = F.regexp_replace(text, ESCAPED, "<$1$2")
    return F.regexp_replace(once, OTHER_ESCAPED, "[$1$2")


def format_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans)``, one row per conversation.

    Turns are collected as structs and sorted by turn, then role, then text, nulls
    first; a null role or text is empty. Adjacent turns of one role share one block
    ``<|role|>r<|text|>a<|next|>b<|end|>``. ``loss_spans`` holds start (from 0) and
    length, in code points, of each assistant text as it stands in ``formatted``.
    Rows without a conversation id form one conversation with a null id; repeated
    rows are repeated turns; an empty table gives no row.
    """
    empty = F.lit("")
    sorted_turns = (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct(
            "turn", F.coalesce(F.col("role"), empty).alias("role"), F.coalesce(F.col("text"), empty).alias("text"),
        ))).alias("turns"))
    )
    count = F.size("turns")

    def piece(turn: Column, i: Column) -> Column:
        opens = (i == 0) | (F.get("turns", F.greatest(i - 1, F.lit(0)))["role"] != turn["role"])
        closes = (i == count - 1) | (F.get("turns", i + 1)["role"] != turn["role"])
        return F.struct(
            F.when(opens, F.concat(F.lit(ROLE), escape(turn["role"]), F.lit(TEXT)))
            .otherwise(F.lit(NEXT)).alias("before"),
            escape(turn["text"]).alias("text"),
            F.when(closes, F.lit(END)).otherwise(empty).alias("after"),
            (turn["role"] == LEARNED_ROLE).alias("learned"),
        )

    pieces = sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    no_span = F.array().cast("array<struct<start:bigint,length:bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), no_span.alias("spans"))

    def advance(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["before"])
        size = F.length(p["text"]).cast("bigint")
        span = F.struct(begin.alias("start"), size.alias("length"))
        return F.struct(
            (begin + size + F.length(p["after"])).alias("at"),
            F.when(p["learned"], F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"]).alias("spans"),
        )

    whole = F.transform("pieces", lambda p: F.concat(p["before"], p["text"], p["after"]))
    return pieces.select(
        "conv_id",
        F.array_join(whole, "").alias("formatted"),
        F.aggregate("pieces", start, advance, lambda s: s["spans"]).alias("loss_spans"),
    )


def parse_formatted(formatted: DataFrame, *keep: str) -> DataFrame:
    """``(conv_id, formatted, turns)`` and columns ``keep``; roles and texts come from the formatted text."""
    blocks = F.filter(F.split("formatted", r"<\|end\|>", -1), lambda b: b != "")

    def block_turns(block: Column) -> Column:
        body = F.substring_index(block, TEXT, -1)
        role = unescape(F.substring(F.substring_index(block, TEXT, 1), len(ROLE) + 1, F.length(block)))
        return F.transform(
            F.split(body, r"<\|next\|>", -1),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    return formatted.select("conv_id", "formatted", *keep, F.flatten(F.transform(blocks, block_turns)).alias("turns"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the mask, one after the other."""
    texts = F.transform(
        spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return F.array_join(texts, "")
