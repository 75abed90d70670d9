"""Cutting a conversation to a token budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.functions.binding import let


def slice_ranges(roles: Column, counts: Column, budget: int, max_messages: int) -> Column:
    """For every possible end, the range of valid starts: ``array<struct<end, first, last>>`` (1-based).

    A slice ends on the role the conversation ends on, has at most ``max_messages``
    messages, after an assistant end a user turn before it, and its prompt (all
    but a final non-user message) fits the budget. Dropping leading messages only
    shortens a prompt, so the valid starts of an end are one interval and no pair
    of start and end is ever listed.
    """
    n = F.size(roles)

    def for_end(end: Column, target: Column) -> Column:
        asks = F.get(roles, end - 1) == "user"
        stop = F.when(asks, end).otherwise(end - 1)
        low = F.greatest(end - max_messages + 1, F.lit(1))
        # Walk back from the end while the prompt fits.
        back = F.reverse(F.slice(counts, low, F.greatest(stop - low + 1, F.lit(0))))
        state = F.struct(F.lit(0).cast("long").alias("used"), F.lit(0).alias("fit"), F.lit(True).alias("going"))

        def walk(s: Column, c: Column) -> Column:
            fits = s.going & (s.used + c <= budget)
            return F.struct(
                (s.used + F.when(fits, c).otherwise(0)).alias("used"),
                (s.fit + F.when(fits, 1).otherwise(0)).alias("fit"),
                fits.alias("going"),
            )

        fit = F.aggregate(back, state, walk, lambda s: s.fit)
        first = F.greatest(stop - fit + 1, low)
        before = F.slice(roles, low, F.greatest(end - low, F.lit(0)))
        user_at = F.coalesce(F.array_max(F.transform(before, lambda r, i: F.when(r == "user", low + i).otherwise(0))), F.lit(0))
        last = F.when(target == "assistant", user_at).otherwise(end)
        return F.struct(end.alias("end"), first.alias("first"), last.alias("last"))

    def all_ends(target: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), n), lambda e: F.get(roles, e - 1) == target)
        return F.filter(F.transform(ends, lambda e: for_end(e, target)), lambda r: r["first"] <= r["last"])

    return F.when(n > 0, let(F.get(roles, n - 1), all_ends))


def window_to_budget(
    df: DataFrame, roles: str, counts: str, budget: int, max_messages: int, end_draw: Column, start_draw: Column
) -> DataFrame:
    """Add ``start`` and ``end`` (1-based) of a random valid slice; rows without one are dropped.

    A conversation that fits stays whole. ``end_draw`` and ``start_draw`` are hashes:
    the first picks an end that has a valid start, the second one of its starts.
    """
    r, c = F.col(roles), F.col(counts)
    n = F.size(r)
    asks = F.get(r, n - 1) == "user"
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    prompt = F.when(asks, total(c)).otherwise(total(F.slice(c, 1, F.greatest(n - 1, F.lit(0)))))
    df = df.withColumn("_whole", (n <= max_messages) & (prompt <= budget))
    df = df.withColumn("_ranges", slice_ranges(r, c, budget, max_messages))
    pick = F.get("_ranges", F.pmod(end_draw, F.greatest(F.size("_ranges"), F.lit(1))).cast("int"))
    df = df.withColumn("_p", pick)
    start = F.col("_p.first") + F.pmod(start_draw, F.greatest(F.col("_p.last") - F.col("_p.first") + 1, F.lit(1))).cast("int")
    df = df.withColumn("start", F.when(F.col("_whole"), 1).otherwise(start)).withColumn(
        "end", F.when(F.col("_whole"), n).otherwise(F.col("_p.end"))
    )
    return df.filter(F.col("end").isNotNull()).drop("_whole", "_ranges", "_p")


def budget_filter(df: DataFrame, prompt_tokens: Column, messages: Column, budget: int, max_messages: int) -> DataFrame:
    """Rows within the prompt budget and message count; an empty result is an error once the rows are read."""
    kept = df.filter((messages <= max_messages) & (messages > 0) & (prompt_tokens <= budget))
    nothing = F.raise_error(F.lit("no row is within the budget")).cast("boolean")
    alarm = kept.agg(F.count("*").alias("_n")).filter(F.when(F.col("_n") == 0, nothing).otherwise(False))
    return kept.unionAll(alarm.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kept.schema.fields]))
