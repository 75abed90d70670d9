"""Vocabulary building and encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.functions.tokens import words
from tunetable.operators.ordering import global_index
from tunetable.operators.skew import join_unique


def tokens_of(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Long form: one row per token, with its 0-based position."""
    return df.select(*keep, F.posexplode(words(F.col(text))).alias("pos", "token"))


def count_tokens(tokens: DataFrame, counts: Mapping[str, Column] | None = None) -> DataFrame:
    """Occurrences per token, counted on the map side first."""
    counts = counts or {"n": F.lit(True)}
    return tokens.groupBy("token").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


def build_vocabulary(tokens: DataFrame, first_id: int = 0) -> DataFrame:
    """Ids by falling count, then token."""
    ranked = global_index(count_tokens(tokens), F.desc("n"), F.asc("token"), name="id")
    return ranked.withColumn("id", (F.col("id") + first_id).cast("int"))


def _ids_in_order(pos: str, token_id: str) -> Column:
    """Aggregate: the ids by position, NULL ones included. Each goes as one number, position first, which costs less to move and sort than a pair."""
    low = -(2**31)
    slot = F.coalesce(F.col(token_id).cast("long") - low + 2**32, F.lit(0).cast("long"))
    packed = F.sort_array(F.collect_list(F.shiftleft(F.col(pos).cast("long"), 33).bitwiseOR(slot)))
    found = lambda x: F.shiftright(x, 32).bitwiseAND(F.lit(1)) == 1
    return F.transform(packed, lambda x: F.when(found(x), (x.bitwiseAND(F.lit(2**32 - 1)) + low).cast("int")))


def encode(df: DataFrame, text: str, vocabulary: DataFrame, keys: Sequence[str], out: str = "input_ids") -> DataFrame:
    """Token ids of a text column, regrouped to one row per text."""
    rows = join_unique(tokens_of(df, text, *keys), vocabulary, ["token"], "n", ["id"])
    ids = rows.groupBy(*keys).agg(_ids_in_order("pos", "id").alias(out))
    empty = F.array().cast("array<int>")
    return df.join(ids, list(keys), "left").withColumn(out, F.coalesce(out, empty))
