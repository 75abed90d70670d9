"""Chat formatting of typed content parts. DataFrame functions only.

A message's content is an ordered list of parts: text, image, audio or document. A visitor
flattens it: text parts are escaped, every other part becomes a placeholder with a running number
per conversation, and its reference is recorded with the number of tokens the
placeholder stands for once expanded. Turns are marked by control strings; texts cannot form one,
because the characters that begin them are escaped, reversibly. The loss mask covers the content of
assistant turns, as code-point spans of the output.

Scale: the turns of a conversation are brought together by one shuffle, and everything else is row
work. A conversation is one output row, so a single one must fit in memory; nothing else need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetable.functions.binding import let
from tunetable.llm.text import whole

TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
# Tokens a placeholder expands to: images by tiles of TILE pixels, audio by seconds, documents by pages.
TILE, TILE_TOKENS, AUDIO_TOKENS, PAGE_TOKENS = 448, 256, 25, 1024
_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    for plain, safe in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(_ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A list of one text part."""
    null = lambda kind: F.lit(None).cast(kind)
    part = F.struct(
        F.lit("text").alias("type"), text.alias("text"), null("string").alias("ref"), null("int").alias("width"),
        null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages"),
    )
    return F.array(part)


def part_tokens(part: Column) -> Column:
    """Tokens that an attachment expands to; 0 for text. Unknown sizes count as one unit, unknown types as one token."""
    side = lambda x: F.ceil(F.greatest(F.coalesce(x, F.lit(1)), F.lit(1)) / TILE)
    return (
        F.when(part["type"] == "text", F.lit(0))
        .when(part["type"] == "image", side(part["width"]) * side(part["height"]) * TILE_TOKENS)
        .when(part["type"] == "audio", F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(1.0)), F.lit(0.0)) * AUDIO_TOKENS))
        .when(part["type"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * PAGE_TOKENS)
        .otherwise(F.lit(1))
        .cast("long")
    )


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, spans, attachments, n_turns`` from ``conv_id, turn, role, parts`` rows.

    ``formatted`` holds the turns in the order of ``turn``, then role and parts; ``spans`` the code points
    ``start, size`` under the loss mask, ``attachments`` the ``number, type, ref, tokens`` of the placeholders
    in order. NULL roles, texts and part lists are empty, a part without a type is text, a NULL ``conv_id`` is
    a conversation like any other. Repeated rows are repeated turns; an empty table gives no row.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("parts", F.array().cast(f"array<{PART}>")).alias("parts")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))

    rows = rows.withColumn("before", so_far(F.size(F.filter("parts", lambda p: ~_is_text(p)))))
    places = F.filter(F.transform("parts", lambda p, i: F.when(~_is_text(p), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("at", F.row_number().over(order)).withColumn("places", places).withColumn("visits", F.transform("parts", _visit))
    rows = rows.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY))).withColumn(
        "body", F.array_join(F.transform("visits", lambda v: v["shown"]), "")
    )
    start = so_far(F.length("head") + F.length("body") + len(END)) + F.length("head")
    piece = F.struct(
        "at",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        F.when(F.col("role") == "assistant", F.array(F.struct(start.alias("start"), F.length("body").cast("long").alias("size")))).alias("spans"),
        F.transform(F.filter("visits", lambda v: v["placed"]), lambda v: v["attachment"]).alias("attachments"),
    )
    talks = rows.withColumn("p", piece).groupBy("conv_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return talks.select(
        "conv_id",
        F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
        F.flatten(F.array_compact(F.transform("p", lambda x: x["spans"]))).alias("spans"),
        F.flatten(F.transform("p", lambda x: x["attachments"])).alias("attachments"),
        F.size("p").cast("long").alias("n_turns"),
    )


def _visit(part: Column, i: Column) -> Column:
    """What a part shows in the output, and the attachment it records. ``before`` counts the
    conversation's attachments in earlier turns, ``places`` lists the positions of this turn's."""
    placed = ~_is_text(part)
    number = (F.col("before") + F.array_position("places", i)).cast("int")
    shown = F.when(placed, F.concat(F.lit("<|"), escape(part["type"]), F.lit(":"), number.cast("string"), F.lit("|>"))).otherwise(escape(whole(part["text"])))
    attachment = F.struct(number.alias("number"), part["type"].alias("type"), part["ref"].alias("ref"), part_tokens(part).alias("tokens"))
    return F.struct(shown.alias("shown"), placed.alias("placed"), attachment.alias("attachment"))


def read_back(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of an output: exact for turns of text."""
    turns = F.slice(F.split(formatted, r"<\|turn\|>"), F.lit(2), F.greatest(F.size(F.split(formatted, r"<\|turn\|>")) - 1, F.lit(0)))

    def parse(turn: Column) -> Column:
        sides = lambda s: F.struct(
            unescape(F.get(s, F.lit(0))).alias("role"), unescape(F.regexp_replace(F.get(s, F.lit(1)), r"<\|end\|>$", "")).alias("text")
        )
        return let(F.split(turn, r"<\|text\|>"), sides)

    return F.transform(turns, parse)


def masked_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, in order and without anything between.

    The output is cut as four bytes a code point, where a place needs no count from the start, so the time
    grows with the output's length alone; it may have 500 million code points. A character
    put before each piece keeps a byte-order mark that begins it.
    """
    guard = F.encode(F.lit("x"), "UTF-32")

    def cut(points: Column) -> Column:
        at = lambda s: F.substring(points, (4 * s["start"] + 1).cast("int"), (4 * s["size"]).cast("int"))
        text = lambda s: F.decode(F.concat(guard, at(s)), "UTF-32")
        return F.array_join(F.transform(spans, lambda s: let(text(s), lambda t: unescape(F.substr(t, F.lit(2), F.length(t))))), "")

    return let(F.encode(formatted, "UTF-32"), cut)
