"""Ranks, running totals and exact quantiles that never order a whole table, or a
hot group, in one task.

All of them use the same shape: range-partition by the order, fix that layout in
the shared folder, work inside each partition, then add the totals of the
partitions before it. The table of partition totals has at most a few rows per
partition, so it can be broadcast whatever the data size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetable.session import settle

_LOCAL_BITS = 33  # row bits of monotonically_increasing_id


def _columns(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _ranged(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    order = _columns(order)
    # No partition count, so small tables end up in few partitions at run time.
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(placed.withColumn("_at", F.monotonically_increasing_id())).withColumn(
        "_part", F.shiftright("_at", _LOCAL_BITS)
    )


def global_index(df: DataFrame, *order: str | Column, name: str = "row_index") -> DataFrame:
    """0-based position of each row in the total order."""
    ranged = _ranged(df, order)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        ranged.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + local)
        .drop("_part", "_at", "_start")
    )


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    measures: Mapping[str, Column],
    keys: Sequence[str] = (),
    inclusive: bool = False,
) -> DataFrame:
    """Running sums of ``measures`` along ``order``, within ``keys`` if given.

    Rows that the order does not tell apart follow each other in any order. Groups of
    any size are cut at the borders of the range partitions.
    """
    end = Window.currentRow if inclusive else -1
    named = {f"_m_{n}": c for n, c in measures.items()}
    ranged = _ranged(df.withColumns(named), [*_columns(keys), *_columns(order)])
    inside = Window.partitionBy(*keys, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, end)
    local = ranged.withColumns({f"_l_{n}": F.coalesce(F.sum(f"_m_{n}").over(inside), F.lit(0)) for n in measures})

    same = [f"_k_{k}" for k in keys]
    totals = ranged.groupBy(*[F.col(k).alias(s) for k, s in zip(keys, same)], "_part").agg(
        *[F.sum(f"_m_{n}").alias(f"_t_{n}") for n in measures]
    )
    # Only groups cut by a partition border need carries: at most two rows per partition.
    parts_of_group = Window.partitionBy(*same)
    if keys:
        totals = totals.withColumn("_parts", F.count("*").over(parts_of_group)).filter("_parts > 1")
    before = parts_of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *same, F.col("_part").alias("_k"), *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in measures]
    )
    match = F.col("_part") == F.col("_k")
    for k, s in zip(keys, same):
        match = match & F.col(k).eqNullSafe(F.col(s))
    joined = local.join(F.broadcast(carry), match, "left").drop("_k", *same)
    sums = {n: F.col(f"_l_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0)) for n in measures}
    spare = [f"_{k}_{n}" for n in measures for k in "mlc"]
    return joined.withColumns(sums).drop("_part", "_at", *spare)


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str = "rank",
) -> DataFrame:
    """1-based row number inside each group."""
    return running_totals(df, order, {name: F.lit(1).cast("long")}, keys, inclusive=True)


def first_in_order(df: DataFrame, n: int | Column, *order: str) -> Column:
    """Condition true for the first ``n`` rows by ``order`` (ascending, total).

    Only the order columns are ranked; the answer is a threshold, so the rows
    themselves are filtered where they are.
    """
    ranked = global_index(df.select(*order), *order)
    last = ranked.filter(F.col("row_index") < n).agg(F.max(F.struct(*order)).alias("t"))
    return F.coalesce(F.struct(*order) <= last.scalar(), F.lit(False))


def exact_quantile(df: DataFrame, value: str, q: float) -> DataFrame:
    """One-row frame with the linearly interpolated quantile in column ``quantile``."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    placed = running_totals(counts, [value], {"_before": F.col("_n")})
    n = placed.agg(F.sum("_n").alias("n"))
    placed = placed.withColumn("_pos", F.lit(float(q)) * (n.scalar() - 1))
    at = lambda edge: F.max(F.when(F.col("_before") <= edge("_pos"), F.col(value)))
    ends = placed.agg(
        at(F.floor).alias("lo"), at(F.ceil).alias("hi"), F.max(F.col("_pos") - F.floor("_pos")).alias("part")
    )
    return ends.select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("quantile"))
