"""Chat formatting with typed content parts, DataFrame functions only.

A message is a list of parts ``struct<type, text, ref, units>``. The visitor
flattens them in order: text is escaped; image, audio and document parts become
the placeholder ``<|type:k|>`` (k counts the conversation's attachments from
0), with an attachment record (index, turn, type, ref, tokens) and the tokens
the placeholder expands to (``units`` are image pixels, audio milliseconds,
document pages). A turn is

    <|turn|>role<|text|>content</s>

A control string inside a text or role gets one more backslash after its first
character than it has; reading back removes one, so every text returns exactly.
The loss mask is the list of spans [from, to) of the formatted string that hold
assistant content.

A conversation becomes one string, so it has to fit into one row, as a
training sample must. Edge cases: a null text or role is empty; rows are
ordered by turn (nulls first, ties by role, then parts); a null ``conv_id`` is
a conversation; unknown part types are kept as placeholders of 0 tokens; extra
columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "</s>"
#: Strings that mean something to this or a common instruction template, without their first character and a backslash after it.
_CONTROL = r"([<\[])%s(\\*)(/?s>|/?INST\]|<SYS>>|</SYS>>|\|)"
#: Tokens of a placeholder: pixels a token, milliseconds a token, tokens a page.
PIXELS, MILLISECONDS, PAGE = 28 * 28, 40, 512
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL % "", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL % r"\\", "$1$2$3")


def part_tokens(part: Column) -> Column:
    units = F.greatest(F.coalesce(part["units"], F.lit(0)), F.lit(0))
    return (F.when(part["type"] == "image", F.ceil(units / PIXELS))
            .when(part["type"] == "audio", F.ceil(units / MILLISECONDS))
            .when(part["type"] == "document", units * PAGE).otherwise(0)).cast("long")


def text_parts(text: Column) -> Column:
    """The parts of a plain text message."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("bigint").alias("units")))


def _visit(message: Column, before: Column) -> Column:
    """Content of a message whose conversation has ``before`` attachments so far: struct<content, found>."""
    start = F.struct(F.lit("").alias("content"),
                     F.array().cast("array<struct<index:bigint,type:string,ref:string,tokens:bigint>>").alias("found"))

    def visit(state, part):
        index = before + F.size(state["found"])
        kind = F.coalesce(part["type"], F.lit("unknown"))
        other = F.struct(
            F.concat(state["content"], F.lit("<|"), F.regexp_replace(kind, r"[^\w]", "_"), F.lit(":"), index.cast("string"), F.lit("|>")).alias("content"),
            F.concat(state["found"], F.array(F.struct(index.alias("index"), kind.alias("type"), part["ref"].alias("ref"),
                                                      part_tokens(part).alias("tokens")))).alias("found"))
        text = F.struct(F.concat(state["content"], escape(F.coalesce(part["text"], F.lit("")))).alias("content"), state["found"].alias("found"))
        return F.when(kind == "text", text).otherwise(other)

    return F.aggregate(message, start, visit)


def format_conversations(messages: DataFrame) -> DataFrame:
    """Format ``messages(conv_id, turn, role, parts)``.

    Columns: conv_id, n_turns, formatted, loss_spans array<struct<from, to>>,
    attachments array<struct<index, turn, type, ref, tokens>>, expanded_tokens.

    Running sums over a conversation's turns give each message the number of attachments and characters before
    it; messages are visited one by one and joined once, so time grows with the turns, not with their square.
    """
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), parts.alias("parts"))
    other = F.size(F.filter("parts", lambda p: F.coalesce(p["type"], F.lit("unknown")) != "text")).cast("long")
    seen = rows.select("*", F.row_number().over(ordered).alias("place"), F.coalesce(F.sum(other).over(before), F.lit(0)).alias("attached"))
    seen = seen.withColumn("v", _visit(F.col("parts"), F.col("attached"))).withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)))
    size = (F.length("head") + F.length("v.content") + len(END)).cast("long")
    seen = seen.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    message = F.struct(
        "place", F.concat("head", "v.content", F.lit(END)).alias("text"),
        F.when(F.col("role") == "assistant", F.struct(F.col("at").cast("long").alias("from"), (F.col("at") + F.length("v.content")).cast("long").alias("to"))).alias("span"),
        F.transform("v.found", lambda a: F.struct(a["index"].alias("index"), F.col("turn").alias("turn"), a["type"].alias("type"), a["ref"].alias("ref"),
                                                  a["tokens"].alias("tokens"))).alias("found"))
    out = seen.groupBy("conv_id").agg(F.sort_array(F.collect_list(message)).alias("ms"), F.sum(F.aggregate(
        "v.found", F.lit(0).cast("long"), lambda s, a: s + a["tokens"])).alias("expanded_tokens"))
    return out.select("conv_id", F.size("ms").cast("long").alias("n_turns"), F.concat_ws("", F.transform("ms", lambda m: m["text"])).alias("formatted"),
                      F.filter(F.transform("ms", lambda m: m["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
                      F.flatten(F.transform("ms", lambda m: m["found"])).alias("attachments"), "expanded_tokens")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string: array<struct<role, content>>, content unescaped, placeholders as they stand."""
    turns = F.slice(F.split(formatted, END, -1), 1, F.size(F.split(formatted, END, -1)) - 1)
    return F.transform(turns, lambda t: F.struct(
        unescape(F.substring_index(F.substring(t, F.lit(len(TURN) + 1), F.length(t)), TEXT, 1)).alias("role"),
        unescape(F.substring(t, F.length(F.substring_index(t, TEXT, 1)) + len(TEXT) + 1, F.length(t))).alias("content")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped span by span, nothing between."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")))))
