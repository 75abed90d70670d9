"""Conversions between dataset types: projections, filters and explodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunetable.functions.binding import let
from tunetable.functions.render import common_prefix_length
from tunetable.schema import is_conversational


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def _lm_column(df: DataFrame, col: str) -> str:
    return "text" if _is_text(df, col) else "messages"


def to_language_modeling(df: DataFrame) -> DataFrame:
    """From prompt-completion, preference (chosen side), unpaired (good rows) or stepwise (all right)."""
    if "completions" in df.columns:
        df = df.filter(F.forall("labels", lambda x: x))
        return df.select(F.concat("prompt", F.array_join("completions", "")).alias("text"))
    side = "completion" if "completion" in df.columns else "chosen"
    if "label" in df.columns:
        df = df.filter("label")
    if "prompt" not in df.columns:
        return df.select(F.col(side).alias(_lm_column(df, side)))
    return df.select(F.concat("prompt", side).alias(_lm_column(df, side)))


def to_prompt_completion(df: DataFrame) -> DataFrame:
    """From preference, unpaired (good rows) or stepwise (all right)."""
    if "completions" in df.columns:
        df = df.filter(F.forall("labels", lambda x: x))
        return df.select("prompt", F.array_join("completions", "").alias("completion"))
    if "label" in df.columns:
        return df.filter("label").select("prompt", "completion")
    return maybe_extract_prompt(df).select("prompt", F.col("chosen").alias("completion"))


def to_prompt_only(df: DataFrame) -> DataFrame:
    return (maybe_extract_prompt(df) if {"chosen", "rejected"} <= set(df.columns) else df).select("prompt")


def to_implicit_preference(df: DataFrame) -> DataFrame:
    return df.select(F.concat("prompt", "chosen").alias("chosen"), F.concat("prompt", "rejected").alias("rejected"))


def to_unpaired(df: DataFrame) -> DataFrame:
    """From preference (two rows each) or stepwise (good when every step is)."""
    if "completions" in df.columns:
        label = F.forall("labels", lambda x: x)
        return df.select("prompt", F.array_join("completions", "").alias("completion"), label.alias("label"))
    return unpair(maybe_extract_prompt(df))


def _shared_items(chosen: Column, rejected: Column) -> Column:
    """How many entries open both lists."""
    pairs = F.zip_with(chosen, rejected, lambda a, b: F.coalesce(a != b, F.lit(True)))
    first = F.array_position(pairs, True).cast("int")
    return F.when(first > 0, first - 1).otherwise(F.least(F.size(chosen), F.size(rejected)))


def extract_prompt(df: DataFrame) -> DataFrame:
    """Split the shared start of chosen and rejected off as the prompt.

    Edge rules: a space right before the difference goes to the completions; if
    the shorter side is a start of the longer, its last element is not part of the prompt.
    """
    c, r = F.col("chosen"), F.col("rejected")
    if _is_text(df, "chosen"):
        def cut(shared: Column) -> Column:
            differs = shared < F.least(F.length(c), F.length(r))
            space = F.substr(c, shared, F.lit(1)) == " "
            at = F.when(differs & (shared > 0) & space, shared - 1).when(differs, shared).otherwise(F.greatest(shared - 1, F.lit(0)))
            return at
        df = df.withColumn("_at", let(common_prefix_length(c, r), cut))
        at = F.col("_at")
        parts = (F.substr(c, F.lit(1), at), F.substr(c, at + 1, F.length(c)), F.substr(r, at + 1, F.length(r)))
    else:
        shortest = F.least(F.size(c), F.size(r))
        shared = _shared_items(c, r)
        df = df.withColumn("_at", F.when(shared < shortest, shared).otherwise(F.greatest(shortest - 1, F.lit(0))))
        at = F.col("_at")
        parts = (F.slice(c, 1, at), F.slice(c, at + 1, F.size(c)), F.slice(r, at + 1, F.size(r)))
    return df.withColumns(dict(zip(("prompt", "chosen", "rejected"), parts, strict=True))).drop("_at")


def maybe_extract_prompt(df: DataFrame) -> DataFrame:
    """Extract the prompt unless there is one in the same format as the completions."""
    if not {"chosen", "rejected"} <= set(df.columns):
        return df
    if "prompt" in df.columns:
        formats = [is_conversational(df.select(x).schema) for x in ("chosen", "prompt")]
        if formats[0] == formats[1]:
            return df
    return extract_prompt(df)


def unpair(df: DataFrame) -> DataFrame:
    """Two rows per pair, in one scan: chosen as good, rejected as bad."""
    side = lambda c, good: F.struct(F.col(c).alias("completion"), F.lit(good).alias("label"))
    rest = [c for c in df.columns if c not in ("chosen", "rejected")]
    return df.select(*rest, F.explode(F.array(side("chosen", True), side("rejected", False))).alias("_s")).select(*rest, "_s.*")


def maybe_unpair(df: DataFrame) -> DataFrame:
    return unpair(df) if {"chosen", "rejected"} <= set(df.columns) else df


def explode_steps(df: DataFrame) -> DataFrame:
    """One row per step and label."""
    rest = [c for c in df.columns if c not in ("completions", "labels")]
    pairs = F.arrays_zip(F.col("completions").alias("completion"), F.col("labels").alias("label"))
    return df.select(*rest, F.posexplode(pairs).alias("step", "_s")).select(*rest, "step", "_s.*")
