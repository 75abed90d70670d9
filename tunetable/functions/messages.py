"""Column expressions over message arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunetable.functions.binding import let
from tunetable.functions.objectives import running_sum
from tunetable.schema import share_columns


def message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def turns_to_messages(df: DataFrame, conv: str, turn: str, role: str = "role", content: str = "text") -> DataFrame:
    """One row per conversation from one row per turn. A conversation is one row, so it must fit one."""
    turns = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("r"), F.col(content).alias("c"))))
    return df.groupBy(conv).agg(F.transform(turns, lambda x: message(x.r, x.c)).alias("messages"))


def head(messages: Column, n: Column | int) -> Column:
    """The first ``n`` entries; ``n`` may be 0."""
    return F.slice(messages, 1, F.greatest(F.lit(n) if isinstance(n, int) else n, F.lit(0)))


def last_index(messages: Column, test) -> Column:
    """1-based index of the last message passing ``test``; 0 if none does."""
    marks = F.transform(messages, lambda x, i: F.when(test(x), i + 1).otherwise(0))
    return F.coalesce(F.array_max(marks), F.lit(0))


def first_index(messages: Column, test) -> Column:
    """1-based index of the first message passing ``test``; 0 if none does."""
    return F.coalesce(F.array_position(F.transform(messages, lambda x: F.coalesce(test(x), F.lit(False))), True).cast("int"), F.lit(0))


def from_share(messages: Column) -> Column:
    return F.transform(messages, lambda m: message(m["from"], m["value"]))


def to_chatml(df: DataFrame) -> DataFrame:
    """Rename ``from``/``value`` messages, and ``conversations`` to ``messages``."""
    df = df.withColumns({c: from_share(F.col(c)) for c in share_columns(df.schema)})
    return df.withColumnRenamed("conversations", "messages")


def share_roles(messages: Column) -> Column:
    """Standard role names; messages without role or content are dropped."""
    # Role names used by shared conversations.
    role = lambda m: F.when(m["from"] == "human", "user").when(m["from"] == "gpt", "assistant").otherwise(m["from"])
    kept = F.filter(messages, lambda m: F.coalesce(m["from"] != "", F.lit(False)) & m["value"].isNotNull())
    return F.transform(kept, lambda m: message(role(m), m["value"]))


# Columns that may hold a conversation, and column pairs that may hold one exchange.
CONVERSATION_KEYS = ("conversations", "conversation", "dialog", "dialogue")
EXCHANGE_KEYS = (
    ("prompt", "completion"),
    ("prompt", "response"),
    ("instruction", "output"),
    ("input", "output"),
    ("question", "answer"),
)


def infer_messages(schema: T.StructType) -> Column:
    """The ``messages`` column a table implies, chosen from its schema."""
    names = schema.fieldNames()
    if "messages" in names:
        return F.col("messages")
    for key in (k for k in CONVERSATION_KEYS if k in names and isinstance(schema[k].dataType, T.ArrayType)):
        item = schema[key].dataType.elementType
        if isinstance(item, T.StringType):
            return F.array(message("user", F.get(key, F.lit(0))), message("assistant", F.get(key, F.lit(1))))
        fields = item.fieldNames() if isinstance(item, T.StructType) else []
        if {"role", "content"} <= set(fields):
            return F.col(key)
        if {"from", "value"} <= set(fields):
            return share_roles(F.col(key))
    for user, assistant in EXCHANGE_KEYS:
        if user in names and assistant in names:
            turns = [message("user", F.col(user)), message("assistant", F.col(assistant))]
            if "system" in names:
                turns.insert(0, F.when(F.col("system") != "", message("system", F.col("system"))))
            return F.array_compact(F.array(*turns))
    raise ValueError(f"no conversation found in columns {sorted(names)}")


def to_last_assistant(messages: Column) -> Column:
    """Drop what follows the last assistant turn; empty without one."""
    return head(messages, last_index(messages, lambda m: m.role == "assistant"))


def drop_trailing_assistant(messages: Column) -> Column:
    return head(messages, last_index(messages, lambda m: m.role != "assistant"))


def split_last(messages: Column) -> tuple[Column, Column]:
    """``(prompt, completion)``: all but the last message, and the last."""
    return head(messages, F.size(messages) - 1), F.slice(messages, F.greatest(F.size(messages), F.lit(1)), 1)


def prompt_of(messages: Column) -> Column:
    """The messages to answer: all of them after a user turn, else all but the last."""
    asks = F.try_element_at(messages, F.lit(-1)).role == "user"
    return F.when(F.size(messages) == 0, messages).when(asks, messages).otherwise(head(messages, F.size(messages) - 1))


def total_chars(messages: Column) -> Column:
    return F.aggregate(messages, F.lit(0), lambda a, m: a + F.coalesce(F.length(m.content), F.lit(0)))


def with_system(content: Column, system: str) -> Column:
    return F.array(message("system", F.lit(system)), message("user", content))


def with_preamble(content: Column, preamble: str) -> Column:
    return F.array(message("user", F.concat(F.lit(preamble), content)))


def merge_thinking(messages: Column) -> Column:
    """Put a ``thinking`` field in front of the content as a think block, and drop the field."""
    thought = lambda m: F.coalesce(F.trim(m.thinking) != "", F.lit(False))
    return F.transform(
        messages,
        lambda m: message(
            m.role,
            F.when(thought(m), F.concat(F.lit("<think>"), m.thinking, F.lit("</think>"), m.content)).otherwise(m.content),
        ),
    )


def drop_nulls(col: Column, dtype: T.DataType) -> Column:
    """JSON text without null entries: mappings drop null keys, lists keep their nulls."""
    return F.to_json(_without_null_values(col, dtype), {"ignoreNullFields": "true"})


def _without_null_values(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.MapType):
        kept = F.map_filter(col, lambda k, v: v.isNotNull())
        return F.transform_values(kept, lambda k, v: _without_null_values(v, dtype.valueType))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _without_null_values(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [_without_null_values(col[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    return col


def image_blocks(messages: Column, images: Column) -> Column:
    """Content blocks with image references before the first user text.

    Roles other than system, user and assistant are an error.
    """
    first_user = first_index(messages, lambda m: m.role == "user")
    block = lambda kind, text, image: F.struct(
        F.lit(kind).alias("type"), text.cast("string").alias("text"), image.cast("string").alias("image_ref")
    )
    none = F.lit(None)
    pictures = F.transform(images, lambda i: block("image", none, i))
    known = F.forall(messages, lambda m: m.role.isin("system", "user", "assistant"))
    fill = lambda at: F.transform(
        messages,
        lambda m, i: F.struct(
            m.role.alias("role"),
            F.when(i + 1 == at, F.concat(pictures, F.array(block("text", m.content, none))))
            .otherwise(F.array(block("text", m.content, none)))
            .alias("content"),
        ),
    )
    out = let(first_user, fill)
    placed = (first_user > 0) | (F.size(images) == 0)
    return (
        F.when(~known, F.raise_error(F.lit("messages may only have the roles system, user and assistant")))
        .when(~placed, F.raise_error(F.lit("images given, but no user message to hold them")))
        .otherwise(out)
    )

def prepared_image_blocks(messages: Column, images: Column) -> Column:
    """``role, content`` with blocks, from messages that may be prepared already.

    A message has ``role``, ``content`` (a text) and ``blocks`` (``type, text``; NULL unless prepared).
    Texts become blocks, and the placeholders of all images stand before the first user text. Then the
    placeholders, given or new, get the images in order. A role other than system, user and
    assistant is an error, and so is any other number of placeholders than of images.
    """
    block = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"))
    first = first_index(messages, lambda m: (m.role == "user") & m.blocks.isNull())
    slots = F.transform(images, lambda i: block("image", F.lit(None)))

    def as_blocks(m: Column, here: Column) -> Column:
        own = F.transform(m.blocks, lambda b: F.struct(b.type.alias("type"), b.text.alias("text")))
        text = F.array(block("text", m.content))
        return F.when(m.blocks.isNotNull(), own).when(here, F.concat(slots, text)).otherwise(text)

    wrapped = let(first, lambda at: F.transform(messages, lambda m, i: F.struct(m.role.alias("role"), as_blocks(m, i + 1 == at).alias("content"))))
    is_image = lambda b: F.when(b.type == "image", 1.0).otherwise(0.0)
    known = F.forall(messages, lambda m: m.role.isin("system", "user", "assistant"))

    def filled(w: Column) -> Column:
        # The number of an image counts the placeholders up to it, over the blocks of all messages.
        seen = running_sum(F.flatten(F.transform(w, lambda m: F.transform(m.content, is_image))))
        ends = running_sum(F.transform(w, lambda m: F.size(m.content).cast("double")))
        part = lambda b, at, s: F.struct(
            b.type.alias("type"), b.text.alias("text"),
            F.when(b.type == "image", F.get(images, F.get(s, at).cast("int") - 1)).cast("string").alias("image_ref"),
        )
        place = lambda m, i, e, s: F.transform(m.content, lambda b, j: part(b, (F.get(e, i) - F.size(m.content)).cast("int") + j, s))
        done = let(
            F.struct(seen.alias("seen"), ends.alias("ends")),
            lambda x: F.struct(
                F.coalesce(F.try_element_at(x.seen, F.lit(-1)), F.lit(0.0)).alias("slots"),
                F.transform(w, lambda m, i: F.struct(m.role.alias("role"), place(m, i, x.ends, x.seen).alias("content"))).alias("messages"),
            ),
        )
        return let(
            done,
            lambda d: F.when(d.slots == F.size(images), d.messages).otherwise(
                F.raise_error(F.concat(F.size(images).cast("string"), F.lit(" images for "), d.slots.cast("int").cast("string"), F.lit(" placeholders")))
            ),
        )

    checked = F.when(known, wrapped).otherwise(F.raise_error(F.lit("messages may only have the roles system, user and assistant")))
    return let(checked, filled)


def rename_image_blocks(messages: Column, kind: str = "image_pil") -> Column:
    """Image blocks under another name, as some engines want: both the type and the field of the image."""
    part = lambda b: F.struct(
        F.when(b.type == "image", F.lit(kind)).otherwise(b.type).alias("type"), b.text.alias("text"), b.image_ref.alias(kind)
    )
    return F.transform(messages, lambda m: F.struct(m.role.alias("role"), F.transform(m.content, part).alias("content")))



def content_filter(df: DataFrame, messages: str, max_chars: int) -> DataFrame:
    """Rows whose messages have at most ``max_chars`` characters together."""
    return df.filter(total_chars(F.col(messages)) <= max_chars)


def prompt_filter(df: DataFrame, prompt: str, max_chars: int) -> DataFrame:
    return df.filter(F.length(F.get(prompt, F.lit(0)).content) <= max_chars)


def not_all_equal(samples: Sequence[Column]) -> Column:
    return F.size(F.array_distinct(F.array(*samples))) > 1


def prune_to(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that are there."""
    return df.select(*[c for c in wanted if c in df.columns])
