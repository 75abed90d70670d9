"""Message types and dataset-type detection, decided from the schema alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)
# A message that may call tools or name its speaker; ``arguments`` is JSON text.
CALL = T.StructType([T.StructField("name", T.StringType()), T.StructField("arguments", T.StringType())])
CALLING_MESSAGE = T.StructType([*MESSAGE.fields, T.StructField("name", T.StringType()), T.StructField("tool_calls", T.ArrayType(CALL))])
CALLING_MESSAGES = T.ArrayType(CALLING_MESSAGE)

# The columns that may hold messages, in lookup order.
MESSAGE_COLUMNS = ("prompt", "chosen", "rejected", "completion", "messages")
SHARE_COLUMNS = ("prompt", "completion", "chosen", "rejected", "messages", "conversations")


def _is_list_of(dtype: T.DataType, *fields: str) -> bool:
    return (
        isinstance(dtype, T.ArrayType)
        and isinstance(dtype.elementType, T.StructType)
        and set(fields) <= set(dtype.elementType.fieldNames())
    )


def message_columns(schema: T.StructType) -> list[str]:
    """Columns holding ``role``/``content`` messages."""
    return [c for c in MESSAGE_COLUMNS if c in schema.fieldNames() and _is_list_of(schema[c].dataType, "role", "content")]


def share_columns(schema: T.StructType) -> list[str]:
    """Columns holding ``from``/``value`` messages."""
    return [c for c in SHARE_COLUMNS if c in schema.fieldNames() and _is_list_of(schema[c].dataType, "from", "value")]


def is_conversational(schema: T.StructType) -> bool:
    return bool(message_columns(schema))


def is_conversational_from_value(schema: T.StructType) -> bool:
    return "conversations" in share_columns(schema)


def has_messages(col: Column | str) -> Column:
    """Row form of the format test: the list is there and not empty."""
    return F.coalesce(F.size(col) > 0, F.lit(False))


def dataset_type(schema: T.StructType) -> str:
    """Name of the dataset type the columns stand for."""
    names = set(schema.fieldNames())
    if {"prompt", "completions", "labels"} <= names:
        return "stepwise"
    if {"chosen", "rejected"} <= names:
        return "preference" if "prompt" in names else "implicit_preference"
    if {"prompt", "completion"} <= names:
        return "unpaired_preference" if "label" in names else "prompt_completion"
    if "prompt" in names:
        return "prompt_only"
    if names & {"text", "messages"}:
        return "language_modeling"
    raise ValueError(f"no dataset type has the columns {sorted(names)}")


def is_processed(df: DataFrame) -> bool:
    """Whether the rows already went through tokenisation."""
    return "input_ids" in df.columns
