"""Distinct, samples, shuffles, samplers and chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.operators.ordering import global_index


def first_per(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row of each group; pre-aggregated, so repeated prompts do not pile up."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, "_r.*")


def sample_rows(df: DataFrame, n: int, draw: Column, *tie: str) -> DataFrame:
    """``n`` rows for display, by a hash."""
    return df.withColumn("_d", draw).orderBy("_d", *tie).limit(n).drop("_d")


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def shuffled(df: DataFrame, seed: int, *key: str) -> DataFrame:
    """All rows in a reproducible random order; columns stay together."""
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key)


def repeat_sampler(
    df: DataFrame, order: Sequence[str | Column], batch: int = 1, mini_repeat: int = 1, repeat: int = 1
) -> DataFrame:
    """Rows in chunks of ``batch``, each row ``mini_repeat`` times and each chunk ``repeat`` times.

    The last partial chunk is dropped. ``position`` is the place in the resulting order.
    """
    n = df.count()
    ranked = global_index(df, *order, name="_rank").withColumn("chunk", F.floor(F.col("_rank") / batch))
    full = ranked.filter(F.col("_rank") < (n // batch) * batch)
    copies = full.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1)))).withColumn(
        "mini", F.explode(F.sequence(F.lit(0), F.lit(mini_repeat - 1)))
    )
    inside = F.col("_rank") - F.col("chunk") * batch
    place = ((F.col("chunk") * repeat + F.col("repeat")) * batch + inside) * mini_repeat + F.col("mini")
    return copies.withColumn("position", place.cast("long")).drop("_rank")


def equal_chunks(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Chunk number of each row, ``size`` rows per chunk."""
    return global_index(df, *order, name="_rank").withColumn("chunk", F.floor(F.col("_rank") / size)).drop("_rank")


def even_chunks(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """``n`` chunks whose sizes differ by at most one, larger ones first."""
    total = df.count()
    small, extra = divmod(total, n)
    rank = F.col("_rank")
    border = extra * (small + 1)
    late = F.lit(extra) + F.floor((rank - border) / F.lit(max(small, 1)))
    chunk = F.when(rank < border, F.floor(rank / F.lit(small + 1))).otherwise(late)
    return global_index(df, *order, name="_rank").withColumn("chunk", chunk.cast("int")).drop("_rank")


def nan_to_null(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))
