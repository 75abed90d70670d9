"""Padding and flushing of batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetable.functions.tokens import pad, round_up, valid_only
from tunetable.operators.skew import with_group_stats


def pad_to_longest(df: DataFrame, ids: str, out: str, value: int, keys: list[str] = (), multiple: int = 1, side: str = "right") -> DataFrame:
    """Pad to the longest row of the batch (or table), rounded up to a multiple.

    The lengths are pre-aggregated, so a batch of any size is fine.
    """
    longest = F.max(F.size(ids))
    if keys:
        df = with_group_stats(df, keys, {"_longest": longest})
        n = F.col("_longest")
    else:
        n = df.agg(longest.alias("n")).scalar()
    return df.withColumn(out, pad(F.col(ids), round_up(n, multiple), value, side)).drop("_longest")


def flush(df: DataFrame, values: str | Sequence[str], mask: str, side: str, keys: list[str] = (), fill: int = 0) -> DataFrame:
    """Move valid positions to one side and drop columns empty in every row of the batch.

    ``values`` names one list column, several, or none: then the mask alone is flushed.
    """
    named = [values] if isinstance(values, str) else list(values)
    valid = {v: valid_only(F.col(v), F.col(mask)) for v in named}
    df = df.withColumns({**valid, mask: F.filter(mask, lambda m: m == 1)})
    other = "right" if side == "left" else "left"
    df = pad_to_longest(df, mask, mask, 0, keys, side=other)
    return df.withColumns({v: pad(F.col(v), F.size(mask), fill, other) for v in named})
