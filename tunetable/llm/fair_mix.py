"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

Every document of a source, in a shuffled but reproducible order, is served after the
ones before it. Its virtual finish time is the source's cumulative tokens divided by the
source's weight; a source that runs out starts again, ``max_epochs`` times at most. The
mix is the global order by finish time, cut where the total budget is spent. At that
virtual time each source has been served its weight's share; a document in service
at the cut is taken up to the cut, so the shares are met to the token.

Scale: a source may hold any share of the rows. The shuffled order of a source is cut into
``BUCKETS`` ranges of the hash; running sums are taken inside a range and added to the
sums of the ranges before it, so no task orders a whole source, nor the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetable.llm.text import short_hash, word_count
from tunetable.session import settle

# At 30 TB in one source a range holds about 2 GB.
BUCKETS = 1 << 14
BLOCK = 128
_HASH_BITS = 60


def cycled_weights(sources: DataFrame, weights: Sequence[int]) -> Column:
    """Weights given in turn to the sources in code-point order, NULL last. One row per source."""
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return F.get(F.array(*[F.lit(w) for w in weights]), at % len(weights)).cast("double")


def source_targets(sizes: DataFrame, weights: Sequence[int], budget_share: float, max_epochs: int) -> DataFrame:
    """``source, source_size, weight, target, cut`` from ``source, size`` rows.

    ``cut`` is the virtual time at which the budget is spent. A source whose every epoch is
    spent before that stops at ``max_epochs`` times its size, and its excess is shared by
    weight. The table holds one row per source, whatever the number of documents.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"))
    sources = sources.withColumn("weight", cycled_weights(sources, weights))
    every = Window.partitionBy()
    sources = sources.withColumns(
        {
            "cap": F.lit(float(max_epochs)) * F.col("source_size"),
            "budget": F.lit(float(budget_share)) * F.sum("source_size").over(every),
            "all_weights": F.sum("weight").over(every),
        }
    )
    # Sources run out in the order of cap / weight; one runs out if that comes before the level which
    # the sources from it on would reach together.
    earlier = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    level = rest / (F.col("all_weights") - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    sources = sources.withColumn("out", F.col("cap") / F.col("weight") < level)
    spent = F.coalesce(F.sum(F.when(F.col("out"), F.col("cap"))).over(every), F.lit(0.0))
    shared = F.coalesce(F.sum(F.when(~F.col("out"), F.col("weight"))).over(every), F.lit(0.0))
    cut = F.when(shared > 0, (F.col("budget") - spent) / shared).otherwise(F.max(F.col("cap") / F.col("weight")).over(every))
    target = F.when(F.col("out"), F.col("cap")).otherwise(F.least(F.col("weight") * F.col("cut"), F.col("cap")))
    return (
        sources.withColumn("cut", cut)
        .withColumn("target", target)
        .select("source", F.col("source_size").cast("long").alias("source_size"), "weight", "target", "cut")
    )


def served(
    df: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    budget_share: float = 1.5,
    max_epochs: int = 2,
    seed: str = "mix",
    carried: str = "row",
) -> DataFrame:
    """Rows of ``doc_id, source, size, <carried>`` with ``source_size, target, finish, taken``.

    ``finish`` is the virtual finish time of the first service as a share of the cut, NULL for
    a source without words; ``taken`` the words taken over all epochs. The order
    inside a source depends on ``doc_id``, then size and source text, never on the layout, so
    reruns agree; equal rows may trade places without a trace. NULL sizes are not allowed, NULL
    sources and ids are values like any other. An empty table gives an empty result.
    """
    rows = df.withColumn("_h", short_hash(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    rows = rows.withColumn("_b", F.shiftright("_h", _HASH_BITS - (BUCKETS.bit_length() - 1)))
    sums = settle(rows.groupBy("source", "_b").agg(F.sum("size").alias("size")))
    # What lies before a range: the blocks of ranges before its own, and the ranges before it in its block. No
    # window sees more than BLOCK rows of a source.
    before_in = lambda *keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    sum_before = lambda window: F.coalesce(F.sum("size").over(window), F.lit(0))
    ranges = sums.withColumn("_block", F.floor(F.col("_b") / BLOCK))
    blocks = ranges.groupBy(F.col("source").alias("_bs"), F.col("_block").alias("_bb")).agg(F.sum("size").alias("size"))
    blocks = blocks.select("_bs", "_bb", sum_before(before_in("_bs", by="_bb")).alias("_base"))
    inside_block = ranges.withColumn("_inside", sum_before(before_in("source", "_block", by="_b")))
    starts = inside_block.join(blocks, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("_block") == F.col("_bb"))).select(
        F.col("source").alias("_s"), F.col("_b").alias("_sb"), (F.col("_base") + F.col("_inside")).alias("_start")
    )
    targets = source_targets(sums.select("source", "size"), weights, budget_share, max_epochs).withColumnRenamed("source", "_t")
    # Both hold a row per range or source. Stored, so that Spark knows their size when it joins them.
    plan = settle(starts.join(targets, F.col("_s").eqNullSafe(F.col("_t"))).drop("_t"))

    order = Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("_before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    joined = inside.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_sb")))
    before = F.col("_start") + F.col("_before")
    whole_target = F.round("target").cast("long")
    taken = F.lit(0).cast("long")
    for epoch in range(max_epochs):
        taken = taken + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), whole_target - before - epoch * F.col("source_size")))
    finish = F.when(F.col("target") > 0, (before + F.col("size")) / F.col("target"))
    return joined.withColumn("finish", finish).withColumn("taken", taken).select("doc_id", "source", "size", carried, "source_size", "target", "finish", "taken")


def mixed_documents(df: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself, with the columns of the input, ordered by virtual finish time.

    A document comes once for every epoch that takes at least half of its words, so whole texts
    are kept and each source's words stay within half a document of its target. Documents without words are
    not taken.
    """
    packed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(ident).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")
    )
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    mix = served(packed, **options).filter("size > 0").withColumn("copies", copies).filter("copies > 0")
    each = mix.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    at = F.col("finish") + F.col("epoch") * F.col("source_size") / F.col("target")
    return each.orderBy(at, "doc_id").select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns])
