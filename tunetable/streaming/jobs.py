"""Structured Streaming jobs. The stateless parts are the batch expressions, unchanged."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tunetable.functions.render import append_end
from tunetable.functions.tokens import first_n, hashed_ids
from tunetable.operators.ordering import running_totals
from tunetable.operators.pack import cut_in_place, joined_pieces
from tunetable.session import scratch_path

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of files, be it one file or a folder of part files."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # Written as a pattern: the file source takes a plain path for a folder.
    return read_stream(spark, f"{path[:-1]}[{path[-1]}]", schema)


def run_available(
    stream: DataFrame,
    mode: str,
    stateful: bool = False,
    path: str | None = None,
    checkpoint: str | None = None,
    per_batch: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> DataFrame:
    """Process what is there and read back what was written, with the batch it came from.

    Each micro-batch is passed through ``per_batch`` and overwrites its own folder, so a
    batch repeated after a failure leaves one copy.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-state")
    shape = per_batch(spark.createDataFrame([], stream.schema)).schema
    schema = T.StructType([*shape.fields, T.StructField("batch_id", T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        per_batch(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    _drain(stream, mode, stateful, checkpoint, write)
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/batch_id=*")


def _drain(stream: DataFrame, mode: str, stateful: bool, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    spark = stream.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    if stateful:
        spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()
    finally:
        if stateful:
            spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def in_arrivals(rows: DataFrame, arrival: str, count: int, job: Callable[[DataFrame, str, str], DataFrame]) -> DataFrame:
    """Let the rows of arrival 0, 1, ... come in one after the other, each as a micro-batch of its own.

    ``job(stream, path, checkpoint)`` drains the stream and is called again after each arrival with the
    same folders, like a job that is started every hour. Returns what the last call gave.
    """
    spark = rows.sparkSession
    folder, path, checkpoint = (scratch_path(spark, f"stream-{n}") for n in ("in", "out", "state"))
    schema = rows.drop(arrival).schema
    for k in range(count):
        rows.filter(F.col(arrival) == k).drop(arrival).write.mode("append").parquet(folder)
        out = job(spark.readStream.schema(schema).parquet(folder), path, checkpoint)
    return out


def latest(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last update of each key: the final state."""
    rest = [c for c in updates.columns if c not in (*keys, "batch_id")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_r")).select(*keys, "_r.*")


def prepare_text(df: DataFrame, text: str, end_marker: str, length: int) -> DataFrame:
    """End marker, ids and truncation; works on tables and streams alike."""
    return df.withColumn(text, append_end(F.col(text), end_marker)).withColumn("input_ids", first_n(hashed_ids(F.col(text)), length))


def moments_stream(df: DataFrame, key: str, value: str) -> DataFrame:
    """Running count, mean and sample std per key, in built-in state."""
    return df.groupBy(key).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def completion_log(df: DataFrame, ts: str, keys: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """One entry per key even if logged again within the delay."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_metrics(df: DataFrame, ts: str, name: str, value: str, width: str, slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Mean per name in tumbling or sliding windows of event time."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = df.withWatermark(ts, delay).groupBy(w, name).agg(F.count("*").alias("n"), F.avg(value).alias("value"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), name, "n", "value")


def window_sums(batch: DataFrame, ts: str, name: str, value: str, width: str, slide: str | None = None) -> DataFrame:
    """Partial sums of a micro-batch. They merge exactly, so no row is ever late and no state is kept."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return batch.groupBy(w.alias("w"), name).agg(F.count("*").alias("n"), F.count(value).alias("values"), F.sum(value).alias("total"))


def merge_window_sums(sums: DataFrame, name: str) -> DataFrame:
    """Rows and mean per window and name over all micro-batches."""
    out = sums.groupBy("w", name).agg(F.sum("n").alias("n"), (F.sum("total") / F.nullif(F.sum("values"), F.lit(0))).alias("value"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), name, "n", "value")


_WINDOW_ROWS = "kind string, name string, start_ms long, lane int, n long, vals long, total double, id long, value double"


class _Windows(StatefulProcessor):
    """Sums of one window of event time. A timer at its end closes it; rows that come later are handed on as late."""

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "n long, vals long, total double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        name, start, lane = key
        end = start + self.width_ms
        if end <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                yield pd.DataFrame(
                    {"kind": "late", "name": name, "start_ms": start, "lane": lane, "n": 1, "vals": part["value"].notna().astype("int64"), "total": 0.0, "id": part["id"], "value": part["value"]}
                )
            return
        n, vals, total = self.sums.get() if self.sums.exists() else (0, 0, 0.0)
        if not self.sums.exists():
            self.handle.registerTimer(end)
        for part in rows:
            n, vals, total = n + len(part), vals + int(part["value"].notna().sum()), total + float(part["value"].sum())
        self.sums.update((n, vals, total))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        name, start, lane = key
        n, vals, total = self.sums.get()
        self.sums.clear()
        yield pd.DataFrame({"kind": ["window"], "name": [name], "start_ms": [start], "lane": [lane], "n": [n], "vals": [vals], "total": [total], "id": [None], "value": [None]})

    def close(self) -> None:
        pass


def windows_with_late_rows(
    df: DataFrame, ts: str, name: str, value: str, row_id: str, width_s: int, slide_s: int | None = None, delay: str = "10 minutes", lanes: int = 8
) -> DataFrame:
    """Sums of event-time windows that the watermark has passed, and the rows that came after that.

    The state of a window is three numbers for each of ``lanes``, which split a hot window over tasks; a timer at the
    window's end emits and frees it. A row is late for a window that ended at or before the watermark, which is the largest event time of earlier
    micro-batches less ``delay``; it is emitted as it is and changes no window. ``closed_windows`` and ``late_rows`` read
    the two kinds apart. Rows without an event time are left out.
    """
    slide_s = slide_s or width_s
    clock = F.unix_micros(ts)
    last = F.floor(clock / F.lit(slide_s * 1_000_000)) * slide_s
    first = F.floor((clock / F.lit(1_000_000) - width_s) / F.lit(slide_s)) * slide_s + slide_s
    lane = F.pmod(F.xxhash64(row_id), F.lit(lanes)).cast("int")
    rows = df.filter(F.col(ts).isNotNull()).withWatermark(ts, delay)
    # The event time itself goes no further: the engine would drop late rows before the operator sees them.
    keyed = rows.select(
        F.col(name).alias("name"),
        F.explode(F.sequence(first.cast("long"), last.cast("long"), F.lit(slide_s).cast("long"))).alias("start_s"),
        lane.alias("lane"),
        F.col(row_id).cast("long").alias("id"),
        F.col(value).cast("double").alias("value"),
    ).withColumn("start_ms", F.col("start_s") * 1000)
    return keyed.groupBy("name", "start_ms", "lane").transformWithStateInPandas(
        _Windows(width_s * 1000), outputStructType=_WINDOW_ROWS, outputMode="Append", timeMode="EventTime"
    )


def closed_windows(out: DataFrame) -> DataFrame:
    """``name, start_s, n, value`` of the windows that the watermark has passed: their rows and mean value."""
    sums = out.filter("kind = 'window'").groupBy("name", "start_ms").agg(*[F.sum(c).alias(c) for c in ("n", "vals", "total")])
    return sums.select("name", (F.col("start_ms") / 1000).cast("long").alias("start_s"), "n", F.try_divide("total", "vals").alias("value"))


def late_rows(out: DataFrame) -> DataFrame:
    """``name, start_s, id, value`` of the rows that came after their window was closed."""
    return out.filter("kind = 'late'").select("name", (F.col("start_ms") / 1000).cast("long").alias("start_s"), "id", "value")


class _OnceInAWhile(StatefulProcessor):
    """The entries of one lane of keys: of each key one is logged, what follows within its time to live is a repeat."""

    def __init__(self, ttl_us: int, key_names: Sequence[str]):
        self.ttl_us, self.key_names = ttl_us, list(key_names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "keys array<array<string>>, us array<long>")

    def _live(self, limit: int) -> dict[tuple[str, ...], int]:
        """Time of the last entry of each key, without those that ended by ``limit``."""
        keys, times = self.last.get() if self.last.exists() else ([], [])
        return {tuple(k): us for k, us in zip(keys, times, strict=True) if us + self.ttl_us > limit}

    def _keep(self, last: dict[tuple[str, ...], int]) -> None:
        if last:
            self.last.update(([list(k) for k in last], list(last.values())))
        else:
            self.last.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(rows), ignore_index=True).sort_values(["us", "no_id", "id"])
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        last, kinds = self._live(limit), []
        for k, us in zip(zip(*[part[n].tolist() for n in self.key_names], strict=True), part["us"].tolist(), strict=True):
            if us < limit:
                kinds.append("late")
            elif k in last and us < last[k] + self.ttl_us:
                kinds.append("repeat")
            else:
                kinds.append("logged")
                last[k] = us
        self._keep(last)
        if "logged" in kinds:
            # In whole milliseconds; by then all entries of this micro-batch have ended, and only late rows could come between.
            self.handle.registerTimer(-(-(max(last.values()) + self.ttl_us) // 1000))
        out = part.assign(kind=kinds)
        out = out[out["kind"] != "repeat"][[*self.key_names, "kind", "us", "no_id", "id"]]
        if len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Entries that were logged since have a timer of their own.
        self._keep(self._live(expiredTimerInfo.getExpiryTimeInMs() * 1000))
        yield from ()

    def close(self) -> None:
        pass


def expiring_log(df: DataFrame, ts: str, keys: Sequence[str], row_id: str, ttl_s: int, delay: str = "1 hour", lanes: int = 256) -> DataFrame:
    """``keys, kind, us, id``: one entry of a key, and none again until ``ttl_s`` of event time later.

    Entries of a micro-batch are taken by event time, then id; the time of an entry is in microseconds. The keys are dealt over ``lanes``, whose
    state is the time of the last entry of each key, read and written once a micro-batch, not once a key;
    a timer frees what the watermark has passed the end of. A row older than the watermark (the largest event time
    of earlier micro-batches less ``delay``) is of kind ``late`` and not logged. Rows without an event time are left out. The rows
    of one lane in one micro-batch are sorted in one task. Keys are numbers, strings or dates, kept as strings meanwhile;
    a stream keeps its number of lanes.
    """
    rows = df.filter(F.col(ts).isNotNull()).withWatermark(ts, delay)
    names = [f"k{i}" for i in range(len(keys))]
    # Nothing reaches pandas as NULL, which would turn a whole column into floating numbers.
    said = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")).alias(n) for k, n in zip(keys, names, strict=True)]
    at, row_id = F.unix_micros(ts).alias("us"), F.col(row_id).cast("long")
    lane = F.pmod(F.xxhash64(*keys), F.lit(lanes)).cast("int").alias("lane")
    dealt = rows.select(lane, *said, at, row_id.isNull().alias("no_id"), F.coalesce(row_id, F.lit(0).cast("long")).alias("id"))
    out = dealt.groupBy("lane").transformWithStateInPandas(
        _OnceInAWhile(ttl_s * 1_000_000, names),
        outputStructType=", ".join([*[f"{n} string" for n in names], "kind string, us long, no_id boolean, id long"]),
        outputMode="Append",
        timeMode="EventTime",
    )
    own = [F.when(F.col(n) != "", F.substring(n, 2, 2**31 - 1)).cast(rows.schema[k].dataType).alias(k) for k, n in zip(keys, names, strict=True)]
    return out.select(*own, "kind", "us", F.when(~F.col("no_id"), F.col("id")).alias("id"))


class _BestRows(StatefulProcessor):
    """The ``capacity`` best rows of a key so far."""

    def __init__(self, capacity: int, key_names: Sequence[str]):
        self.capacity, self.key_names = capacity, list(key_names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getListState("best", "score double, id long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame(list(self.best.get()) if self.best.exists() else [], columns=["score", "id"])
        for part in rows:
            both = pd.concat([kept, part[["score", "id"]]]) if len(kept) else part[["score", "id"]]
            kept = both.sort_values(["score", "id"], ascending=[False, True]).head(self.capacity)
        pairs = [(float(s), int(i)) for s, i in kept.itertuples(index=False)]
        self.best.put(pairs)
        out = pd.DataFrame(pairs, columns=["score", "id"])
        yield out.assign(**dict(zip(self.key_names, key, strict=True)))[[*self.key_names, "score", "id"]]

    def close(self) -> None:
        pass


def best_rows_stream(df: DataFrame, key: str, score: Column, row_id: Column, capacity: int, lanes: int = 16) -> DataFrame:
    """Best rows per key and lane; lanes split a hot key over tasks, ``merge_lanes`` joins them."""
    lane = F.pmod(F.xxhash64(row_id), F.lit(lanes)).cast("int")
    rows = df.select(F.col(key).alias("key"), lane.alias("lane"), score.alias("score"), row_id.alias("id"))
    keys = rows.select("key").schema["key"]
    out = T.StructType(
        [keys, T.StructField("lane", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("id", T.LongType())]
    )
    return rows.groupBy("key", "lane").transformWithStateInPandas(
        _BestRows(capacity, ["key", "lane"]), outputStructType=out, outputMode="Update", timeMode="None"
    )


def merge_lanes(updates: DataFrame, capacity: int) -> DataFrame:
    """Final buffer per key from the last update of each lane."""
    last = updates.groupBy("key", "lane").agg(F.max("batch_id").alias("batch_id"))
    rows = updates.join(last, ["key", "lane", "batch_id"])
    w = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= capacity).select("key", "score", "id")


class _Packer(StatefulProcessor):
    """Cuts a key's tokens every ``length``; the remainder waits in state."""

    def __init__(self, length: int, order: Sequence[str]):
        self.length, self.order = length, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rest = handle.getValueState("rest", "ids array<int>, chunk long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ids, chunk = self.rest.get() if self.rest.exists() else ([], 0)
        rest, chunk = np.asarray(ids, dtype=np.int32), int(chunk)
        part = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable")
        joined = np.concatenate([rest, *[np.asarray(x, dtype=np.int32) for x in part["ids"]]])
        full = len(joined) // self.length
        rest = joined[full * self.length :]
        if full:
            cut = [joined[i * self.length : (i + 1) * self.length].tolist() for i in range(full)]
            yield pd.DataFrame({"lane": key[0], "chunk": range(chunk, chunk + full), "ids": cut, "is_full": True})
            chunk += full
        self.rest.update((rest.tolist(), chunk))
        if len(rest):
            yield pd.DataFrame({"lane": [key[0]], "chunk": [chunk], "ids": [rest.tolist()], "is_full": [False]})

    def close(self) -> None:
        pass


def pack_stream(df: DataFrame, lane: Column, ids: str, length: int, order: Sequence[str]) -> DataFrame:
    """Wrapped packing that carries the tail of a micro-batch into the next.

    One lane is cut by one task, so ``lane`` should spread the rows; a lane's rows of a
    micro-batch follow each other by ``order``. The tail so far is also emitted, marked
    as not full; ``packed_so_far`` keeps the last one.
    """
    out = "lane int, chunk long, ids array<int>, is_full boolean"
    return (
        df.select(lane.cast("int").alias("lane"), *order, F.col(ids).alias("ids"))
        .groupBy("lane")
        .transformWithStateInPandas(_Packer(length, order), outputStructType=out, outputMode="Append", timeMode="None")
    )


def packed_so_far(updates: DataFrame) -> DataFrame:
    """Full chunks, and the last tail of each lane if nothing followed it."""
    last = F.max_by(F.struct("ids", "is_full"), F.struct(F.col("is_full"), F.col("batch_id")))
    return updates.groupBy("lane", "chunk").agg(last.alias("_r")).select("lane", "chunk", "_r.*")


def pack_arrivals(stream: DataFrame, order: Sequence[str], ids: str, length: int, path: str, checkpoint: str) -> DataFrame:
    """``chunk, ids``: wrapped packing of a whole stream in one order of tokens, by micro-batch, then ``order``.

    The state is a ledger with the number of tokens of each micro-batch, written beside its pieces. A
    micro-batch starts where the ledger of those before it ends, finds its rows' places by running totals and cuts them in
    place, so all tasks cut and no lane holds a share of the rows. A chunk may get pieces of several micro-batches; they are
    joined when it is read, and the last one grows until it is full. A repeated micro-batch overwrites its own pieces and entry.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*order, F.col(ids).alias("ids")).filter(F.size("ids") > 0)
        entries = spark.read.schema("tokens long, batch_id long").option("basePath", f"{path}/ledger")
        known = entries.parquet(f"{path}/ledger/batch_id=*").filter(F.col("batch_id") < batch_id) if batch_id else None
        start = (known.agg(F.sum("tokens")).first()[0] or 0) if batch_id else 0
        placed = running_totals(rows, [*order, "ids"], {"_start": F.size("ids").cast("long")})
        pieces = cut_in_place(placed.withColumn("_start", F.col("_start") + F.lit(start)), "_start", length, ["ids"])
        pieces.write.mode("overwrite").parquet(f"{path}/pieces/batch_id={batch_id}")
        rows.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("long").alias("tokens")).write.mode("overwrite").parquet(f"{path}/ledger/batch_id={batch_id}")

    _drain(stream, "append", False, checkpoint, write)
    ids_type = stream.schema[ids].dataType.simpleString()
    pieces = spark.read.schema(f"chunk long, offset long, ids {ids_type}, batch_id long").option("basePath", f"{path}/pieces")
    return joined_pieces(pieces.parquet(f"{path}/pieces/batch_id=*").drop("batch_id"), ["ids"])
