"""Chat formatting in Spark expressions: sorted turns, merged roles, a reversible template, a loss mask.

A conversation's turns are collected as structs and sorted. Adjacent turns of
one role merge into one block, in which a seam mark keeps the turns apart:

    <|turn|>user<|text|>first<|seam|>second<|end|>\\n

Texts and roles are escaped (``&`` to ``&amp;``, ``<`` to ``&lt;``), so no
``<`` in a formatted conversation comes from a text, and marks can neither be
forged nor lost. Only native functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = r"<\|(?:turn|text|seam)\|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One formatted string for each conversation of ``turns(conv_id, turn, role, text)``.

    Returns ``conv_id, formatted, loss_spans``, the latter an array of
    ``(start, length)`` in code points of ``formatted``, one for each turn of
    ``loss_role``, around its escaped text alone. Turns are ordered by
    ``turn`` (null first), ties by role, then text; repeated rows are turns of
    their own. A null role or text is empty; a null ``conv_id`` is one
    conversation. Other columns are ignored; an empty table gives an empty
    table. A conversation is one string, so one task holds it whole.
    """
    clean = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    sorted_turns = clean.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        last = F.get("turns", i - 1)
        head = F.concat(F.lit("<|turn|>"), escape(t["role"]), F.lit("<|text|>"))
        mark = F.when(i == 0, head).when(last["role"] == t["role"], F.lit("<|seam|>")).otherwise(F.concat(F.lit("<|end|>\n"), head))
        return F.struct(mark.alias("mark"), escape(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss"))

    pieces = sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def add(state: Column, p: Column) -> Column:
        begin = state["at"] + F.char_length(p["mark"])
        span = F.struct(begin.alias("start"), F.char_length(p["body"]).alias("length"))
        return F.struct((begin + span["length"]).alias("at"), F.when(p["loss"], F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    body = F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["body"])), "")
    return pieces.select("conv_id", F.concat(body, F.lit("<|end|>\n")).alias("formatted"), F.aggregate("pieces", start, add)["spans"].alias("loss_spans"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """The turns and the masked texts, read back from ``format_chats``' output alone.

    Returns ``conv_id, formatted, turns array<struct<role, text>>, loss_texts
    array<string>``.
    """
    blocks = F.filter(F.split("formatted", r"<\|end\|>\n", -1), lambda b: b != "")

    def block(b: Column) -> Column:
        parts = F.split(b, MARKS, -1)  # nothing, the role, then the texts
        texts = F.slice(parts, F.lit(3), F.size(parts) - 2)
        return F.transform(texts, lambda x: F.struct(unescape(parts[1]).alias("role"), unescape(x).alias("text")))

    loss = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["length"])))
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, block)).alias("turns"), loss.alias("loss_texts"))
