"""Sequence packing."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tunetable.functions.tokens import first_n
from tunetable.operators.ordering import running_totals
from tunetable.operators.skew import with_group_stats


def _list_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def best_fit_bins(sizes: Sequence[int], length: int) -> list[list[int]]:
    """Rows of each bin, largest rows first, each into the fullest bin that still holds it.

    Among equally full bins the one that got there first is used; equal rows keep their order.
    """
    bins: list[list[int]] = []
    open_at: dict[int, deque[int]] = defaultdict(deque)  # free space -> bins
    spaces: list[int] = []  # free spaces in use, ascending
    for row in np.argsort(-np.asarray(sizes), kind="stable").tolist():
        size = int(sizes[row])
        at = bisect_left(spaces, size)
        if at < len(spaces):
            space = spaces[at]
            target = open_at[space].popleft()
            if not open_at[space]:
                spaces.pop(at)
        else:
            space, target = length, len(bins)
            bins.append([])
        bins[target].append(row)
        left = space - size
        if left > 0:
            if not open_at[left]:
                insort(spaces, left)
            open_at[left].append(target)
    return bins


def _bfd_folder(length: int, lists: list[str], keys: list[str], schema: pa.Schema, order: str):
    def fold(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by(order)
        sizes = pc.list_value_length(batch[lists[0]]).to_numpy()
        bins = best_fit_bins(sizes, length)
        rows = pa.array([r for b in bins for r in b], pa.int64())
        bounds = np.cumsum([0] + [int(sizes[b].sum()) for b in bins], dtype=np.int32)
        out = {k: pa.array([batch[k][0].as_py()] * len(bins), schema.field(k).type) for k in keys}
        for c in lists:
            values = pc.list_flatten(batch[c].take(rows)).combine_chunks()
            out[c] = pa.ListArray.from_arrays(pa.array(bounds), values)
        out["seq_lengths"] = pa.array([sizes[b].tolist() for b in bins], pa.list_(pa.int32()))
        return pa.table({n: out[n].cast(schema.field(n).type) for n in schema.names})

    return fold


def pack_bfd(df: DataFrame, key: str, length: int, batch_rows: int = 1000, keys: Sequence[str] = ()) -> DataFrame:
    """Pack whole sequences (cut to ``length``) into rows of at most ``length`` tokens.

    The fit is sequential, so it runs in batches of about ``batch_rows`` rows
    drawn by a hash of ``key``; a large group of ``keys`` becomes many batches.
    Lists must be parallel. ``seq_lengths`` tells where each sequence ends.
    """
    lists, keys = _list_columns(df), list(keys)
    df = df.select(*keys, key, *[first_n(F.col(c), length).alias(c) for c in lists]).filter(F.size(lists[0]) > 0)
    if keys:
        df = with_group_stats(df, keys, {"_total": F.count("*")})
        rows = F.col("_total")
    else:
        rows = df.agg(F.count("*")).scalar()
    slots = F.greatest(F.ceil(rows / F.lit(batch_rows)), F.lit(1))
    df = df.withColumn("_slot", F.pmod(F.xxhash64(key), slots)).drop("_total")
    out = T.StructType(
        [df.schema[k] for k in keys]
        + [df.schema[c] for c in lists]
        + [T.StructField("seq_lengths", T.ArrayType(T.IntegerType()))]
    )
    fold = _bfd_folder(length, lists, keys, to_arrow_schema(out), key)
    return df.groupBy(*keys, "_slot").applyInArrow(fold, out)


def pack_wrapped(df: DataFrame, key: str, length: int, keys: Sequence[str] = ()) -> DataFrame:
    """Concatenate all rows in ``key`` order and cut every ``length`` tokens.

    Each row finds its place from a running total and is cut in place, so only
    pieces of at most ``length`` tokens are grouped. NULL keys are keys like any
    other; rows that share a key follow each other in the order of their lists.
    """
    lists, keys = _list_columns(df), list(keys)
    rows = df.select(*keys, key, *lists).filter(F.size(lists[0]) > 0).withColumn("_n", F.size(lists[0]))
    # The rows themselves are placed: a key may be NULL or repeated, so nothing is joined by it.
    placed = running_totals(rows, [key, *lists], {"_start": F.col("_n")}, keys)
    return joined_pieces(cut_in_place(placed, "_start", length, lists, keys), lists, keys)


def cut_in_place(placed: DataFrame, start: str, length: int, lists: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Pieces ``chunk, offset`` and lists of rows whose first token stands at ``start`` of the stream of tokens."""
    start, n = F.col(start), F.size(lists[0])
    chunks = F.sequence(F.floor(start / length), F.floor((start + n - 1) / length))

    def piece(chunk: Column) -> Column:
        skip = F.greatest(chunk * length - start, F.lit(0)).cast("int")
        room = (F.least((chunk + 1) * length, start + n) - F.greatest(chunk * length, start)).cast("int")
        return F.struct(
            chunk.cast("long").alias("chunk"),
            F.greatest(start - chunk * length, F.lit(0)).cast("long").alias("offset"),
            *[F.slice(c, skip + 1, room).alias(c) for c in lists],
        )

    return placed.select(*keys, F.explode(F.transform(chunks, piece)).alias("p")).select(*keys, "p.*")


def joined_pieces(pieces: DataFrame, lists: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The chunks of the pieces. A chunk has at most as many pieces as tokens."""
    whole = F.array_sort(F.collect_list(F.struct("offset", *lists)))
    return (
        pieces.groupBy(*keys, "chunk")
        .agg(whole.alias("_w"))
        .select(*keys, "chunk", *[F.flatten(F.col(f"_w.{c}")).alias(c) for c in lists])
    )


def concat_batches(df: DataFrame, batch: str, order: str, lists: Sequence[str]) -> DataFrame:
    """One row per batch of bounded size: its lists in order, without padding."""
    rows = F.array_sort(F.collect_list(F.struct(order, *lists)))
    joined = df.groupBy(batch).agg(rows.alias("_w"))
    return joined.select(
        batch,
        *[F.flatten(F.col(f"_w.{c}")).alias(c) for c in lists],
        F.transform("_w", lambda x: F.size(x[lists[0]])).alias("seq_lengths"),
    )
