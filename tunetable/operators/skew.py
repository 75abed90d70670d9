"""Joins with a table that is unique by key, when some keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys with more than one in this many of all rows are joined from a broadcast table, which has
# fewer rows than this. Any other key holds too few rows to be hot in the shuffle.
HEAD_KEYS = 10_000
_SALTS = 4096  # a power of two


def _row_salt(rows: DataFrame) -> Column:
    """A reproducible salt from the row's plain columns, outside the range of ``_key_salt``."""
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    return F.xxhash64(*plain).bitwiseAND(F.lit(_SALTS - 1)) + 2


def _key_salt(keys: Sequence[str]) -> Column:
    # Computed from the key: a literal would be folded out of the join keys. Never NULL,
    # so no filter is inferred that would keep the table's shuffle from being reused.
    return F.xxhash64(*keys).bitwiseAND(F.lit(1))


def join_unique(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    weight: str,
    values: Sequence[str],
    head_keys: int = HEAD_KEYS,
    total: Column | None = None,
) -> DataFrame:
    """Left join adding ``values`` of ``table``, whose ``weight`` counts the rows of each key.

    ``total`` is the sum of the weights, where the caller has it already.

    Rows of the heaviest keys are served by a broadcast and spread over the shuffle join
    that serves the rest. A NULL key is a key like any other.
    """
    keys = list(keys)
    # Both sides read the same columns of the table, so its shuffle is computed once.
    entry = F.struct(*values, F.col(weight).alias("_weight"))
    named = lambda p: [F.col(k).alias(f"_{p}_{k}") for k in keys]
    # At most ``head_keys`` keys can hold more than that share of the rows, so no sort is needed.
    every = table.agg(F.sum(weight)).scalar() if total is None else total
    head = table.filter(F.col(weight) * F.lit(head_keys) > every).select(*named("h"), entry.alias("_head"))
    tail = table.select(*named("t"), _key_salt(keys).alias("_tail_salt"), entry.alias("_rest"))
    match = lambda p: [F.col(k).eqNullSafe(F.col(f"_{p}_{k}")) for k in keys]
    salted = rows.join(F.broadcast(head), match("h"), "left").withColumn(
        "_salt", F.when(F.col("_head").isNull(), _key_salt(keys)).otherwise(_row_salt(rows))
    ).withColumn("_head", F.when(F.col("_head").isNotNull(), F.struct(*[F.col(f"_head.{v}").alias(v) for v in values])))
    # The table is unique by key, so a task's share of it is small beside the rows, which need no sort this way.
    joined = salted.join(tail.hint("shuffle_hash"), [*match("t"), F.col("_salt") == F.col("_tail_salt")], "left")
    kept = [c for c in rows.columns if c not in values]
    found = lambda v: F.when(F.col("_head").isNull(), F.col(f"_rest.{v}")).otherwise(F.col(f"_head.{v}"))
    return joined.select(*kept, *[found(v).alias(v) for v in values])


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Attach aggregates of each group to its rows.

    The aggregates are computed on the map side first, so a group may hold any share of the rows.
    """
    table = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()], F.count("*").alias("_rows"))
    return join_unique(df, table, keys, "_rows", list(stats))
