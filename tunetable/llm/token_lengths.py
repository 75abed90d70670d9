"""Token counts: an exact histogram of encoded lengths with suffix sums.

Documents are aggregated by the length of their encoding under a public byte-level BPE
vocabulary. For every length that occurs, suffix sums answer how many documents and tokens lie at
or beyond it, which share of the documents it holds whole (so any quantile), and how many tokens
remain if every document is cut at that context limit. Between two lengths these are linear.

Scale: the texts are encoded where they are and one number per document is aggregated before the shuffle.
The histogram has one row per distinct length. Its suffix sums are taken inside ranges of
``RANGE`` lengths and added to the totals of the ranges beyond, so not even the histogram is
ordered in one task.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunetable.llm.text import whole
from tunetable.session import settle

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary cuts text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RANGE = 1024


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("from-file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``length`` of each row's whole text. NULL and empty texts have 0; special tokens are ordinary text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_ordinary
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(encode(t.as_py())) for t in batch.column(0)], pa.int64())], names=["length"])

    return df.select(whole(F.col(text)).alias("text")).mapInArrow(run, "length long")


def length_histogram(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``length, docs``: one row per length that occurs. Equal rows all count; an empty table gives no row."""
    return encoded_lengths(df, text, tokenizer).groupBy("length").agg(F.count("*").alias("docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length as a context limit:

    ``docs, tokens`` of exactly that length; ``docs_from, tokens_from`` of that length or more;
    ``docs_longer``; ``docs_within, tokens_within`` up to it; ``share_within`` of all documents; ``truncated_tokens``
    that remain if longer documents are cut there; ``lost_tokens`` that this cuts off.
    """
    rows = settle(histogram.withColumn("tokens", F.col("length") * F.col("docs")).withColumn("range", F.floor(F.col("length") / RANGE)))
    beyond = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    zero = lambda c: F.coalesce(c, F.lit(0))
    # One row per range of lengths.
    ranges = rows.groupBy("range").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    ranges = ranges.select(
        F.col("range").alias("of"),
        zero(F.sum("d").over(beyond)).alias("docs_beyond"),
        zero(F.sum("t").over(beyond)).alias("tokens_beyond"),
        F.sum("d").over(every).alias("all_docs"),
        F.sum("t").over(every).alias("all_tokens"),
    )
    inside = Window.partitionBy("range").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("d", F.sum("docs").over(inside)).withColumn("t", F.sum("tokens").over(inside))
    joined = summed.join(settle(ranges), F.col("range") == F.col("of"))
    docs_from, tokens_from = F.col("d") + F.col("docs_beyond"), F.col("t") + F.col("tokens_beyond")
    longer, within = docs_from - F.col("docs"), F.col("all_tokens") - tokens_from + F.col("tokens")
    kept = within + F.col("length") * longer
    return joined.select(
        F.col("length").alias("context_limit"),
        "docs",
        "tokens",
        docs_from.alias("docs_from"),
        tokens_from.alias("tokens_from"),
        longer.alias("docs_longer"),
        (F.col("all_docs") - longer).alias("docs_within"),
        within.alias("tokens_within"),
        ((F.col("all_docs") - longer) / F.col("all_docs")).alias("share_within"),
        kept.alias("truncated_tokens"),
        (F.col("all_tokens") - kept).alias("lost_tokens"),
    )


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """One row ``length``: the smallest length that holds at least the share ``q`` of the documents whole."""
    return sums.filter(F.col("share_within") >= q).agg(F.min("context_limit").alias("length"))


def totals_at(sums: DataFrame, limit: int) -> DataFrame:
    """One row ``docs_longer, truncated_tokens`` for any context limit, also one that no document has."""
    below = F.struct("context_limit", "docs_longer", "tokens_within")
    at = sums.agg(F.max(F.when(F.col("context_limit") <= limit, below)).alias("x"), F.max("docs_from").alias("n"))
    longer = F.coalesce("x.docs_longer", "n", F.lit(0))
    return at.select(longer.alias("docs_longer"), (F.coalesce("x.tokens_within", F.lit(0)) + limit * longer).alias("truncated_tokens"))
