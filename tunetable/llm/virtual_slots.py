"""Sharding by fixed virtual slots. DataFrame functions only.

Records are hashed into thousands of slots. The bytes of each slot are summed, and a stored,
versioned map says which shard a slot belongs to. Rebalancing writes a new version that moves
as few slots as it needs; records are never hashed anew.

Scale: the map and the slot totals have ``slots`` rows whatever the data size, so they are read
on the driver and broadcast. Rows are numbered inside their slot; the numbers of the slots before
it in the same shard are added, so no task orders a whole shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunetable.session import scratch_path, settle

SLOTS = 4096


def slot_of(*keys: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def byte_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; NULL has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def first_map(sizes: Mapping[int, int], shards: int, slots: int = SLOTS) -> list[int]:
    """Shard of each slot: largest slots first, each to the lightest shard. Sizes end at most the largest slot apart."""
    loads = [(0, 0, s) for s in range(shards)]
    out = [0] * slots
    for slot in sorted(range(slots), key=lambda i: (-sizes.get(i, 0), i)):
        load, held, shard = heapq.heappop(loads)
        out[slot] = shard
        heapq.heappush(loads, (load + sizes.get(slot, 0), held + 1, shard))
    return out


def rebalanced(old: Sequence[int], sizes: Mapping[int, int], shards: int, tolerance: float = 0.01) -> list[int]:
    """An edited map: slots move from the heaviest to the lightest shard until those are within
    ``tolerance`` of the mean of each other, or no move helps. New shards start empty; slots of
    shards that are gone move first. Other slots stay where they are."""
    out = list(old)
    loads = [0] * shards
    for slot, shard in enumerate(out):
        if shard < shards:
            loads[shard] += sizes.get(slot, 0)
    for slot in sorted((i for i, s in enumerate(out) if s >= shards), key=lambda i: (-sizes.get(i, 0), i)):
        out[slot] = min(range(shards), key=lambda s: (loads[s], s))
        loads[out[slot]] += sizes.get(slot, 0)
    members: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(out):
        members[shard].append((sizes.get(slot, 0), slot))
    allowed = tolerance * sum(loads) / shards
    for _ in range(len(out)):
        high, low = max(range(shards), key=lambda s: (loads[s], -s)), min(range(shards), key=lambda s: (loads[s], s))
        gap = loads[high] - loads[low]
        fit = [m for m in members[high] if 0 < m[0] < gap]
        if gap <= allowed or not fit:
            break
        best = min(fit, key=lambda m: (abs(gap - 2 * m[0]), m[1]))
        members[high].remove(best)
        members[low].append(best)
        out[best[1]] = low
        loads[high] -= best[0]
        loads[low] += best[0]
    return out


def store_map(spark: SparkSession, shard_of_slot: Sequence[int], version: int, path: str) -> DataFrame:
    """Write one version ``version, slot, shard`` into its own folder of the map at ``path``; returns that version.

    A write that is repeated replaces itself.
    """
    listed = F.split(F.lit(",".join(map(str, shard_of_slot))), ",")
    rows = spark.range(len(shard_of_slot)).select(
        F.col("id").cast("int").alias("slot"), F.get(listed, F.col("id").cast("int")).cast("int").alias("shard")
    )
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")
    return read_map(spark, path, version)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the newest by default."""
    table = spark.read.schema("slot int, shard int, version int").parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.filter(F.col("version") == version).select("version", "slot", "shard")


def _newest(spark: SparkSession, path: str) -> tuple[int, list[int]] | None:
    """Number and shards of the newest stored version, if there is one."""
    try:
        rows = read_map(spark, path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return (rows[0]["version"], [r["shard"] for r in sorted(rows, key=lambda r: r["slot"])]) if rows else None


def slot_totals(rows: DataFrame) -> DataFrame:
    """``slot, bytes, rows`` of ``virtual_slot, size`` rows; at most one row per slot."""
    return rows.groupBy(F.col("virtual_slot").alias("slot")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def built_map(rows: DataFrame, shards: int, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """The map for ``virtual_slot, size`` rows, stored and read back.

    Where ``path`` holds a map already, its newest version is edited as far as the sizes and
    the number of shards ask for, and stored as the next version; else a first version is made.
    """
    sizes = {r["slot"]: r["bytes"] for r in slot_totals(rows).collect()}  # bounded by slots
    spark = rows.sparkSession
    old = _newest(spark, path) if path else None
    if old and len(old[1]) != slots:
        raise ValueError(f"the stored map has {len(old[1])} slots, not {slots}")
    shard_of_slot = rebalanced(old[1], sizes, shards) if old else first_map(sizes, shards, slots)
    return store_map(spark, shard_of_slot, old[0] + 1 if old else 1, path or scratch_path(spark, "slot-map"))


def _spread_copies(rows: DataFrame, keys: Sequence[str], slots: int) -> DataFrame:
    """Equal rows that hold more than a slot's fair share of the bytes get a slot each by their stored place ``_place``.

    Fewer than ``slots`` keys can hold that much, so they are broadcast.
    """
    total = rows.agg(F.sum("size")).scalar()
    heavy = rows.groupBy(*[F.col(k).alias(f"_h_{k}") for k in keys]).agg(F.sum("size").alias("_b"), F.count("*").alias("_c"))
    heavy = heavy.filter((F.col("_c") > 1) & (F.col("_b").cast("double") * slots > total)).drop("_b", "_c").withColumn("_heavy", F.lit(True))
    same = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    found = rows.join(F.broadcast(heavy), same, "left")
    own = F.when(F.col("_heavy"), slot_of(F.col("virtual_slot"), F.col("_place"), slots=slots)).otherwise(F.col("virtual_slot"))
    return found.withColumn("virtual_slot", own).drop("_heavy", "_place", *[f"_h_{k}" for k in keys])


def sharded(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """The input rows with ``size, virtual_slot, shard, map_version``; like-named input columns give way.

    Shard sizes end near equal in bytes. A NULL key or text is a value like any other; equal rows
    share a slot. The texts are read twice and not shuffled. With ``path`` the map is kept there: a later call
    edits the newest version and stores the next.
    """
    slotted = lambda f: f.withColumn("virtual_slot", slot_of(F.col(key), F.col(text), slots=slots)).withColumn("size", byte_size(F.col(text)))
    table = built_map(slotted(df.select(key, text)).select("virtual_slot", "size"), shards, slots, path)
    entry = "_entry"
    while entry in df.columns:
        entry = f"_{entry}"
    table = table.select(F.struct("slot", "shard", "version").alias(entry))
    joined = slotted(df).join(F.broadcast(table), F.col("virtual_slot") == F.col(f"{entry}.slot"))
    return joined.withColumns({"shard": F.col(f"{entry}.shard"), "map_version": F.col(f"{entry}.version")}).drop(entry)


def numbered(rows: DataFrame, shards: int, slots: int = SLOTS, order: Sequence[str] = ()) -> DataFrame:
    """``virtual_slot, size, ...`` rows with ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Rows equal in ``order`` share a slot unless they hold more than a slot's fair share of the
    bytes; then they are spread, so copies in any number leave the shards near equal.
    """
    rows = settle(rows.withColumn("_place", F.monotonically_increasing_id()) if order else rows)
    rows = _spread_copies(rows, order, slots) if order else rows
    table = built_map(rows, shards, slots)
    earlier = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_totals(rows).join(F.broadcast(table), "slot").select(
        F.col("slot").alias("_slot"), "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*order)) - 1
    placed = rows.withColumn("_at", place.cast("long"))
    return placed.join(F.broadcast(starts), F.col("virtual_slot") == F.col("_slot")).withColumn("slot", F.col("_start") + F.col("_at")).drop("_slot", "_start", "_at")
