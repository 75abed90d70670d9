"""Metric roll-ups and evaluation tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.functions.tokens import ended
from tunetable.operators.ordering import running_totals


def share(cond: Column) -> Column:
    """Fraction of rows where a condition holds (NULL counts as not)."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def length_metrics(df: DataFrame, ids: str, end_ids: list[int], keys: Sequence[str] = ()) -> DataFrame:
    """Completion lengths over all rows and over those that ended (0 if none did)."""
    n = F.size(ids)
    done = ended(F.col(ids), end_ids)
    stats = {"mean": F.avg, "min": F.min, "max": F.max}
    return df.groupBy(*keys).agg(
        *[f(n).cast("double").alias(f"{k}_length") for k, f in stats.items()],
        share(~done).alias("clipped_ratio"),
        *[F.coalesce(f(F.when(done, n)).cast("double"), F.lit(0.0)).alias(f"{k}_terminated_length") for k, f in stats.items()],
    )


def tool_metrics(df: DataFrame, calls: Column, failures: Column) -> DataFrame:
    """Calls per row, and the share of calls that failed."""
    return df.agg(
        (F.sum(calls) / F.count("*")).alias("call_frequency"),
        F.coalesce(F.try_divide(F.sum(failures).cast("double"), F.sum(calls).cast("double")), F.lit(0.0)).alias("failure_frequency"),
    )


def reward_metrics(df: DataFrame, rewards: Sequence[str]) -> DataFrame:
    """Mean, std, minimum and maximum of each reward over the rows it applies to."""
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return df.agg(*[f(r).alias(f"{r}_{k}") for r in rewards for k, f in stats.items()])


def zero_std_fraction(df: DataFrame, keys: Sequence[str], reward: str, eps: float = 1e-8) -> DataFrame:
    """Share of rows in groups without spread, with mean reward and std, each group weighted by its rows."""
    std = F.coalesce(F.stddev_samp(reward), F.lit(0.0))
    groups = df.groupBy(*keys).agg(std.alias("s"), F.count("*").alias("n"), F.sum(reward).alias("t"))
    n = F.sum("n")
    return groups.agg(
        (F.sum("t") / n).alias("reward"),
        (F.sum(F.col("s") * F.col("n")) / n).alias("reward_std"),
        (F.sum(F.when(F.col("s") < eps, F.col("n")).otherwise(0)) / n).alias("frac_zero_std"),
    )


def roll_up(df: DataFrame, step: str = "step", mode: str = "mode", name: str = "name", value: str = "value") -> DataFrame:
    """Mean per step, mode and name; evaluation names get a prefix."""
    shown = F.when(F.col(mode) == "eval", F.concat(F.lit("eval_"), F.col(name))).otherwise(F.col(name))
    return df.groupBy(step, mode, shown.alias(name)).agg(F.avg(value).alias(value))


def class_split(df: DataFrame, keys: Sequence[str], label: Column, values: Mapping[str, Column]) -> DataFrame:
    """Mean of each value on the chosen and rejected class, from sums and counts; margin of rewards."""
    mean = lambda c, side: F.sum(F.when(side, c)) / F.nullif(F.count_if(side), F.lit(0))
    out = df.groupBy(*keys).agg(
        *[mean(c, s).alias(f"{n}_{k}") for n, c in values.items() for k, s in (("chosen", label), ("rejected", ~label))]
    )
    if "rewards" in values:
        out = out.withColumn("rewards_margins", F.col("rewards_chosen") - F.col("rewards_rejected"))
    return out


def token_accuracy(df: DataFrame, predicted: str, labels: str, ignored: int = -100) -> DataFrame:
    """Right predictions over labelled positions."""
    pairs = F.filter(
        F.zip_with(predicted, labels, lambda p, x: F.struct(p.alias("p"), x.alias("x"))), lambda t: t.x != ignored
    )
    hits = F.size(F.filter(pairs, lambda t: t.p == t.x))
    out = df.select(hits.alias("h"), F.size(pairs).alias("n"))
    return out.agg(
        F.sum("h").alias("correct"), F.sum("n").alias("total"), F.try_divide(F.sum("h"), F.sum("n")).alias("accuracy")
    )


def pair_accuracy(df: DataFrame, chosen: str, rejected: str) -> DataFrame:
    """Share of pairs ranked right; exact ties are left out."""
    decided = df.filter(F.col(chosen) != F.col(rejected))
    return decided.agg(F.count("*").alias("n"), share(F.col(chosen) > F.col(rejected)).alias("accuracy"))


def running_token_count(df: DataFrame, step: str, tokens: Column) -> DataFrame:
    """Tokens seen up to and including each step."""
    steps = df.groupBy(step).agg(F.sum(tokens).alias("tokens"))
    return running_totals(steps, [step], {"num_tokens": F.col("tokens")}, inclusive=True)


def running_moments(df: DataFrame, batch: str, value: str) -> DataFrame:
    """Count, mean and sample std of all values up to and including each batch, and the batch's rows.

    Sums are taken around the overall mean, which keeps small variances exact.
    """
    df = df.select(batch, value).withColumn("_centre", df.agg(F.avg(value)).scalar())
    centre, v = F.max("_centre"), F.col(value) - F.col("_centre")
    sums = df.groupBy(batch).agg(
        F.count("*").alias("rows"), F.count(v).cast("double").alias("n"), F.sum(v).alias("s"), F.sum(v * v).alias("q"),
        centre.alias("_centre"),
    )
    run = running_totals(
        sums, [batch], {"count": F.col("n"), "_s": F.col("s"), "_q": F.col("q")}, inclusive=True
    )
    n, s, q = F.col("count"), F.col("_s"), F.col("_q")
    var = F.greatest(q - s * s / n, F.lit(0.0)) / F.nullif(n - 1, F.lit(0.0))
    return run.select(batch, "rows", n.cast("long").alias("count"), (F.col("_centre") + s / n).alias("mean"), F.sqrt(var).alias("std"))


def running_baseline(df: DataFrame, batch: str, value: str) -> DataFrame:
    """``batch, rows, baseline``: the mean of the batch means up to and including each batch.

    Later batches have no part in it, and a batch weighs the same whatever its rows.
    """
    means = df.groupBy(batch).agg(F.avg(value).alias("_mean"), F.count("*").alias("rows"))
    sums = {"_sum": F.coalesce("_mean", F.lit(0.0)), "_seen": F.col("_mean").isNotNull().cast("long")}
    run = running_totals(means, [batch], sums, inclusive=True)
    return run.select(batch, "rows", F.try_divide("_sum", "_seen").alias("baseline"))


def win_rates(df: DataFrame, winner: str, probability: str | None = None) -> DataFrame:
    """Share of rows the policy (1) wins; failed verdicts (-1) stay in the denominator, and a rate without them."""
    w = F.col(winner)
    out = [share(w == 1).alias("win_rate"), F.avg(F.when(w != -1, F.when(w == 1, 1.0).otherwise(0.0))).alias("valid_win_rate")]
    if probability:
        out.append(F.avg(probability).alias("mean_win_probability"))
    return df.agg(*out)


def win_rate_table(pairs: DataFrame, step: int) -> DataFrame:
    return pairs.select(F.lit(step).alias("step"), "prompt", "reference", "policy", "winner")


def game_log(df: DataFrame, prompt: str, policy: str, ref: str) -> DataFrame:
    """Outputs of both models with the prompt cut off by its length."""
    rest = lambda c: F.substr(F.col(c), F.length(prompt) + 1, F.length(c))
    return df.select(F.col(prompt).alias("prompt"), rest(policy).alias("policy"), rest(ref).alias("reference"))


def scorer_summary(df: DataFrame, failed: Column, scores: Mapping[str, Column]) -> DataFrame:
    """Totals and the mean of each scorer over the rows where it gave a score."""
    return df.agg(
        F.count("*").alias("total_predictions"),
        F.count_if(~failed).alias("successful_predictions"),
        *[F.avg(F.when(~failed, s)).alias(f"avg_{n}") for n, s in scores.items()],
    )


def divergence_metrics(df: DataFrame, old: str, sampled: str, mask: str, cap: float) -> DataFrame:
    """Gap between two log-prob sources per valid token, and the truncated ratio."""
    zipped = F.arrays_zip(F.col(old).alias("o"), F.col(sampled).alias("s"), F.col(mask).alias("m"))
    tokens = df.select(F.explode(zipped).alias("t")).filter("t.m = 1")
    gap = F.col("t.o") - F.col("t.s")
    ratio = F.least(F.exp(gap), F.lit(float(cap)))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return tokens.agg(
        zero(F.avg(F.abs(gap))).alias("gap_mean"),
        zero(F.max(F.abs(gap))).alias("gap_max"),
        zero(F.min(ratio)).alias("ratio_min"),
        zero(F.avg(ratio)).alias("ratio_mean"),
        zero(F.max(ratio)).alias("ratio_max"),
    )
