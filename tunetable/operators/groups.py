"""Group analytics over rollouts.

Group statistics are pre-aggregated and joined back with the heavy groups served
by a broadcast, so one prompt with a third of all rollouts is spread like the others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetable.functions.binding import let
from tunetable.functions.objectives import array_sum, clip
from tunetable.operators.ordering import exact_quantile, running_totals
from tunetable.operators.skew import with_group_stats

EPS = 1e-4
ZERO_STD = 1e-8
_UNITS = 1 << 52


def all_null_rows(df: DataFrame, rewards: Sequence[str]) -> DataFrame:
    """Rows no reward function applied to."""
    return df.filter(F.coalesce(*[F.col(r) for r in rewards]).isNull())


def group_advantage(df: DataFrame, keys: Sequence[str], reward: str, scale: str = "group", small_groups: bool = False) -> DataFrame:
    """Advantage relative to the group mean, with the scaling std and a zero-std flag.

    ``scale``: ``group``, ``batch`` (the whole table) or ``none``. With ``small_groups``
    (say, what ``keep_best`` left) windows reuse the shuffle the groups already have.
    """
    if scale not in ("group", "batch", "none"):
        raise ValueError("scale is 'group', 'batch' or 'none'")
    mean, std = F.avg(reward), F.coalesce(F.stddev_samp(reward), F.lit(0.0))
    if small_groups:
        w = Window.partitionBy(*keys)
        out = df.withColumns({"group_mean": mean.over(w), "group_std": F.coalesce(F.stddev_samp(reward).over(w), F.lit(0.0))})
    else:
        out = with_group_stats(df, keys, {"group_mean": mean, "group_std": std})
    if scale == "batch":
        out = out.withColumn("group_std", df.agg(std.alias("s")).scalar())
    centred = F.col(reward) - F.col("group_mean")
    scaled = centred if scale == "none" else centred / (F.col("group_std") + EPS)
    return out.withColumn("advantage", scaled).withColumn("zero_std", F.col("group_std") < ZERO_STD)


def advantages_in_row(rewards: Column) -> Column:
    """The same for a group that is one list of rewards: structs ``reward, group_mean, group_std, advantage, zero_std``
    in the list's order. NULL rewards take no part in mean and std; nothing is shuffled."""
    known = F.filter(rewards, lambda r: r.isNotNull())

    def spread(m: Column) -> Column:
        n = F.size(known)
        squares = array_sum(F.transform(known, lambda r: (r - m) * (r - m)))
        return F.struct(m.alias("mean"), F.when(n > 1, F.sqrt(squares / F.greatest(n - 1, F.lit(1)))).otherwise(0.0).alias("std"))

    def row(r: Column, s: Column) -> Column:
        scaled = (r - s["mean"]) / (s["std"] + EPS)
        return F.struct(
            r.alias("reward"), s["mean"].alias("group_mean"), s["std"].alias("group_std"), scaled.alias("advantage"), (s["std"] < ZERO_STD).alias("zero_std")
        )

    mean = array_sum(known) / F.nullif(F.size(known), F.lit(0))
    return let(let(mean, spread), lambda s: F.transform(rewards, lambda r: row(r, s)))


def leave_one_out_advantage(
    df: DataFrame,
    keys: Sequence[str],
    reward: str,
    reward_range: tuple[float, float] | None = None,
    kl: str | None = None,
    beta: float = 0.0,
    normalise: bool = False,
) -> DataFrame:
    """Reward minus the mean of the other rows of the group; 0 in a group of one."""
    r = F.col(reward) if reward_range is None else clip(F.col(reward), *reward_range)
    if kl is not None:
        r = r - beta * F.col(kl)
    df = with_group_stats(df.withColumn("_r", r), keys, {"_s": F.sum("_r"), "_n": F.count("*")})
    alone = F.col("_r") - (F.col("_s") - F.col("_r")) / F.nullif(F.col("_n") - 1, F.lit(0))
    df = df.withColumn("advantage", F.coalesce(alone, F.lit(0.0))).drop("_r", "_s", "_n")
    if normalise:
        whole = df.agg(F.struct(F.avg("advantage").alias("m"), F.stddev_samp("advantage").alias("s")).alias("x")).scalar()
        df = df.withColumn("advantage", (F.col("advantage") - whole.m) / (whole.s + EPS))
    return df


def keep_best(df: DataFrame, keys: Sequence[str], score: str, order: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows of each group with the highest score.

    The rank filter is applied before the shuffle too, so a hot group is cut to
    ``k`` rows per task first.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc(score), *order)
    return df.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= k).drop("_k")


def replay_scores(df: DataFrame, keys: Sequence[str], advantage: str, std: str) -> DataFrame:
    """Score of each group worth replaying: total absolute advantage times std."""
    score = F.sum(F.abs(advantage) * F.col(std))
    out = df.groupBy(*keys).agg(score.alias("score"), F.max(std).alias("_std"))
    return out.filter(F.col("_std") > 0).drop("_std")


def replay_buffer(scores: DataFrame, keys: Sequence[str], capacity: int) -> DataFrame:
    """The ``capacity`` best groups."""
    return scores.orderBy(F.desc("score"), *keys).limit(capacity)


def uniform(seed: int, *cols: str | Column) -> Column:
    """A reproducible number in (0, 1) per row."""
    slot = F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 52))
    return (slot + 0.5) / float(1 << 52)


def weighted_draw(df: DataFrame, weight: str, n: int, u: Column, tie: Sequence[str]) -> DataFrame:
    """``n`` rows without replacement, by weight (exponential keys)."""
    return df.withColumn("_k", -F.log(u) / F.col(weight)).orderBy("_k", *tie).limit(n).drop("_k")


def draw_with_replacement(rows: DataFrame, buffer: DataFrame, weight: str, keys: Sequence[str], u: Column, out: str) -> DataFrame:
    """Give every row one buffered group by weight, NULL from an empty buffer.

    Weights are laid end to end as whole numbers out of 2^52 and cut by a guide table of as many equal cells as
    groups. A row looks up its cell, which holds two groups on average, so the buffer's size does not matter to it.
    Cells are drawn evenly whatever the weights. A share below 2^-53 is never drawn.
    """
    every = buffer.filter(F.col(weight) > 0).agg(F.sum(weight).cast("double")).scalar()
    units = buffer.filter(F.col(weight) > 0).select(*keys, F.col(weight).alias("w"), F.rint(F.col(weight) / every * F.lit(float(_UNITS))).cast("long").alias("_n"))
    placed = running_totals(units.filter("_n > 0"), list(keys), {"_lo": F.col("_n")}).withColumn("_hi", F.col("_lo") + F.col("_n"))
    size = placed.agg(F.struct(F.max("_hi").alias("total"), F.ceil(F.max("_hi") / F.count("*")).alias("width"))).scalar()
    cell = lambda at: F.floor(at / size.width)
    guide = placed.select(
        F.struct(*keys, "w").alias(out), "_lo", "_hi", F.explode(F.sequence(cell(F.col("_lo")), cell(F.col("_hi") - 1))).alias("_guide")
    )
    drawn = rows.withColumn("_at", F.least(F.floor(u * size.total), size.total - 1)).withColumn("_cell", cell(F.col("_at")))
    inside = (F.col("_cell") == F.col("_guide")) & (F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi"))
    return drawn.join(guide, inside, "left").drop("_at", "_cell", "_guide", "_lo", "_hi")


def fill_from_replay(groups: DataFrame, keys: Sequence[str], std: str, buffer: DataFrame, u: Column) -> DataFrame:
    """A replayed group for each zero-variance group, drawn by score with the numbers ``u``.

    Without replacement while the buffer is large enough, else with. Which of the two is decided inside the plan.
    """
    flat = groups.filter(F.col(std) < ZERO_STD).select(*keys)
    enough = flat.agg(F.count("*")).scalar() <= buffer.agg(F.count("*")).scalar()
    replayed = lambda x: [x[k].alias(f"replay_{k}") for k in keys]
    again = draw_with_replacement(flat.filter(~enough), buffer, "score", keys, u, "_r").select(*keys, *replayed(F.col("_r")))
    # At most as many rows as the buffer holds on both sides.
    drawn = buffer.select((-F.log(u) / F.col("score")).alias("_k"), *keys)
    in_order = drawn.agg(F.array_sort(F.collect_list(F.struct("_k", *keys)))).scalar()
    asking = flat.filter(enough).agg(F.array_sort(F.collect_list(F.struct(*keys))).alias("a")).withColumn("d", in_order)
    pair = lambda a, d: F.struct(*[a[k].alias(k) for k in keys], *replayed(d))
    once = asking.select(F.inline(F.zip_with("a", F.slice("d", F.lit(1), F.size("a")), pair)))
    return again.unionByName(once)


def high_entropy_mask(df: DataFrame, seq: str, values: str, mask: str, q: float, rank_error: float | None = None) -> DataFrame:
    """Mark valid tokens whose entropy reaches the quantile over all valid tokens.

    Exact and interpolated, by a sort of the distinct values; with ``rank_error`` from a mergeable sketch in one
    aggregation: the threshold is a value whose rank is off by at most that share of all valid tokens.
    """
    tokens = df.select(F.explode(F.arrays_zip(F.col(values).alias("v"), F.col(mask).alias("m"))).alias("t"))
    valid = tokens.filter("t.m = 1").select(F.col("t.v").alias("v"))
    if rank_error is None:
        threshold = exact_quantile(valid, "v", q)
    else:
        threshold = valid.agg(F.percentile_approx("v", q, math.ceil(1 / rank_error)))
    df = df.withColumn("_t", threshold.scalar())
    keep = F.zip_with(values, mask, lambda v, m: (m == 1) & (v >= F.col("_t")))
    return df.withColumn("entropy_mask", F.transform(keep, lambda x: x.cast("int"))).withColumnRenamed("_t", "threshold")


def whiten(df: DataFrame, values: str, mask: str, out: str, shift_mean: bool = True) -> DataFrame:
    """Zero mean and unit variance over all valid tokens; invalid ones become 0."""
    tokens = df.select(F.explode(F.arrays_zip(F.col(values).alias("v"), F.col(mask).alias("m"))).alias("t")).filter("t.m = 1")
    stats = tokens.agg(F.struct(F.avg("t.v").alias("m"), F.var_samp("t.v").alias("v")).alias("x"))
    df = df.withColumn("_s", stats.scalar())
    mean, scale = F.col("_s.m"), 1.0 / F.sqrt(F.col("_s.v") + 1e-8)
    shift = F.lit(0.0) if shift_mean else mean
    white = F.zip_with(values, mask, lambda v, m: F.when(m == 1, (v - mean) * scale + shift).otherwise(0.0))
    return df.withColumn(out, white).drop("_s")
