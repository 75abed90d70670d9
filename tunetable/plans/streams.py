"""Streaming jobs over the given tables, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunetable.functions.tokens import hashed_ids
from tunetable.plans.inputs import num, show_ids, sql_hashed, sql_ids, sql_num
from tunetable.plans.registry import query
from tunetable.session import settle
from tunetable.sources.scan import table
from tunetable.streaming import jobs as J

# Lanes of the streamed packing; each is cut by one task.
LANES = 64


@query(
    f"""WITH t AS (SELECT conv_id, turn, CASE WHEN ends_with(text, '<eos>') THEN text ELSE text || '<eos>' END AS text FROM conversations)
    SELECT conv_id, turn, {sql_ids(sql_hashed('text') + '[1:64]')} AS input_ids FROM t"""
)
def stream_prepared_turns(spark, sf):
    prepared = J.prepare_text(J.table_stream(spark, sf, "conversations"), "text", "<eos>", 64)
    out = J.run_available(prepared.select("conv_id", "turn", "input_ids"), "append")
    return out.select("conv_id", "turn", show_ids(F.col("input_ids")).alias("input_ids"))


@query(f"SELECT event_type, count(value) AS count, {sql_num('avg(value)', 9)} AS mean, {sql_num('stddev_samp(value)')} AS std FROM events GROUP BY event_type")
def stream_moments(spark, sf):
    updates = J.run_available(J.moments_stream(J.table_stream(spark, sf, "events"), "event_type", "value"), "update")
    final = J.latest(updates, ["event_type"])
    return final.select("event_type", "count", num(F.col("mean"), 9).alias("mean"), num(F.col("std")).alias("std"))


def _events(spark, sf):
    """The event stream with its clock read as UTC, whatever the session's zone."""
    events = J.table_stream(spark, sf, "events")
    return events.withColumn("ts", F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("Z"))))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_completion_log(spark, sf):
    events = _events(spark, sf).select("ts", "user_id", "event_type")
    # Each batch logs its entries once and the batches are merged at the end: no state, no late rows.
    once = lambda df: df.select("user_id", "event_type").distinct()
    return once(J.run_available(events, "append", per_batch=once))


def _windows(spark, sf, width, slide=None):
    sums = J.run_available(_events(spark, sf), "append", per_batch=lambda b: J.window_sums(b, "ts", "event_type", "value", width, slide))
    final = J.merge_window_sums(sums, "event_type")
    shown = [F.unix_timestamp(c).alias(f"{c}_s") for c in ("start", "end")]
    return final.select(*shown, "event_type", "n", num(F.col("value"), 9).alias("value"))


@query(
    f"""WITH w AS (SELECT event_type, value, time_bucket(INTERVAL 6 HOUR, ts) AS s FROM events)
    SELECT CAST(epoch(s) AS BIGINT) AS start_s, CAST(epoch(s) + 21600 AS BIGINT) AS end_s, event_type, count(*) AS n, {sql_num('avg(value)', 9)} AS value FROM w GROUP BY s, event_type"""
)
def stream_tumbling_metrics(spark, sf):
    return _windows(spark, sf, "6 hours")


@query(
    f"""WITH w AS (SELECT event_type, value, time_bucket(INTERVAL 6 HOUR, ts) - to_hours(CAST(k * 6 AS INTEGER)) AS s FROM events, (SELECT unnest(range(4)) AS k))
    SELECT CAST(epoch(s) AS BIGINT) AS start_s, CAST(epoch(s) + 86400 AS BIGINT) AS end_s, event_type, count(*) AS n, {sql_num('avg(value)', 9)} AS value FROM w GROUP BY s, event_type"""
)
def stream_sliding_metrics(spark, sf):
    return _windows(spark, sf, "24 hours", "6 hours")


@query(
    "SELECT event_type AS key, value AS score, event_id AS id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 50"
)
def stream_replay_buffer(spark, sf):
    events = J.table_stream(spark, sf, "events")
    stream = J.best_rows_stream(events, "event_type", F.col("value"), F.col("event_id"), 50, lanes=8)
    return J.merge_lanes(J.run_available(stream, "update", stateful=True), 50)


@query(
    f"""WITH i AS (SELECT CAST(conv_id % {LANES} AS INTEGER) AS lane, {sql_hashed('text')} AS ids FROM conversations),
    t AS (SELECT lane, sum(len(ids)) AS n, sum(list_sum(ids)) AS id_sum FROM i GROUP BY 1)
    SELECT lane, CAST(ceil(n / 128.0) AS BIGINT) AS chunks, CAST(n // 128 AS BIGINT) AS full_chunks, CAST(n AS BIGINT) AS tokens, CAST(id_sum AS BIGINT) AS id_sum FROM t"""
)
def stream_packed_chunks(spark, sf):
    turns = J.table_stream(spark, sf, "conversations").select("conv_id", "turn", hashed_ids(F.col("text")).alias("ids"))
    updates = J.run_available(J.pack_stream(turns, F.col("conv_id") % LANES, "ids", 128, ["conv_id", "turn"]), "append", stateful=True)
    packed = J.packed_so_far(updates)
    return packed.groupBy("lane").agg(
        F.count("*").alias("chunks"), F.count_if("is_full").alias("full_chunks"), F.sum(F.size("ids")).alias("tokens"),
        F.sum(F.aggregate("ids", F.lit(0).cast("long"), lambda s, x: s + x)).alias("id_sum"),
    )


# --- streams in the order of arrival -----------------------------------------
# The tables come in as a few arrivals: events by their time, some of them one or two arrivals
# later than the others of their time.

ARRIVALS = 3
DELAY_S = 3 * 86_400
WINDOW_S = 6 * 3_600
TTL_S = 36 * 3_600


def _arriving_events(spark, sf):
    events = table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    # Whole days and the time of the day, so that no session zone matters.
    day = F.unix_date(F.to_date("ts"))
    second = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.extract(F.lit("SECOND"), F.col("ts")).cast("decimal(18,6)")
    us = day.cast("long") * 86_400_000_000 + (second * 1_000_000).cast("long")
    events = events.withColumn("day", day).withColumn("ts", F.timestamp_micros(us))
    ends = events.agg(F.struct(F.min("day").alias("a"), F.max("day").alias("b"))).scalar()
    span = ends["b"] - ends["a"] + 1
    delay = F.when(F.col("event_id") % 7 == 3, 1).otherwise(0) + F.when(F.col("event_id") % 41 == 5, 1).otherwise(0)
    arrival = F.least(F.floor((F.col("day") - ends["a"]) * ARRIVALS / span) + delay, F.lit(ARRIVALS - 1))
    return settle(events.withColumn("arrival", arrival.cast("int")).drop("day"))


_SQL_ARRIVALS = f"""span AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) - min(CAST(ts AS DATE)) + 1 AS n FROM events),
    ev AS (SELECT event_id, event_type, user_id, value, epoch_us(ts) AS us,
      least((CAST(ts AS DATE) - span.a) * {ARRIVALS} // span.n + CASE WHEN event_id % 7 = 3 THEN 1 ELSE 0 END + CASE WHEN event_id % 41 = 5 THEN 1 ELSE 0 END, {ARRIVALS - 1}) AS arrival FROM events, span),
    wm AS (SELECT arrival, coalesce(max(max(us) // 1000) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY_S * 1000}, 0) AS w FROM ev GROUP BY arrival),
    fin AS (SELECT max(us) // 1000 - {DELAY_S * 1000} AS w FROM ev)"""


@query(
    f"""WITH {_SQL_ARRIVALS}, p AS (SELECT ev.*, us // {WINDOW_S * 1_000_000} * {WINDOW_S} AS start_s, w FROM ev JOIN wm USING (arrival)),
    l AS (SELECT *, (start_s + {WINDOW_S}) * 1000 <= w AS late FROM p)
    SELECT 'late' AS kind, event_type, start_s, event_id, 1 AS n, {sql_num('value')} AS value FROM l WHERE late
    UNION ALL SELECT 'window', event_type, start_s, NULL, count(*), {sql_num('avg(value)')} FROM l, fin WHERE NOT late AND (start_s + {WINDOW_S}) * 1000 <= fin.w GROUP BY event_type, start_s"""
)
def stream_windows_with_late(spark, sf):
    """Windows closed by the watermark, and the rows that came too late for theirs."""

    def job(stream, path, checkpoint):
        out = J.windows_with_late_rows(stream, "ts", "event_type", "value", "event_id", WINDOW_S, delay=f"{DELAY_S} seconds")
        return J.run_available(out, "append", True, path, checkpoint)

    out = J.in_arrivals(_arriving_events(spark, sf), "arrival", ARRIVALS, job)
    late = J.late_rows(out).select(F.lit("late").alias("kind"), "name", "start_s", F.col("id").alias("event_id"), F.lit(1).cast("long").alias("n"), "value")
    windows = J.closed_windows(out).select(F.lit("window").alias("kind"), "name", "start_s", F.lit(None).cast("long").alias("event_id"), "n", "value")
    return late.unionByName(windows).withColumn("value", num(F.col("value"))).withColumnRenamed("name", "event_type")


@query(
    f"""WITH RECURSIVE {_SQL_ARRIVALS},
    l AS (SELECT ev.*, us < w * 1000 AS late FROM ev JOIN wm USING (arrival)),
    o AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY arrival, us, event_id) AS r FROM l WHERE NOT late),
    g AS (SELECT user_id, event_type, event_id, us, r FROM o WHERE r = 1
      UNION ALL SELECT g.user_id, g.event_type, arg_min(o.event_id, o.r), arg_min(o.us, o.r), min(o.r) FROM g
      JOIN o ON o.user_id = g.user_id AND o.event_type = g.event_type AND o.r > g.r AND o.us >= g.us + {TTL_S * 1_000_000} GROUP BY g.user_id, g.event_type, g.r)
    SELECT 'logged' AS kind, user_id, event_type, event_id, us FROM g UNION ALL SELECT 'late', user_id, event_type, event_id, us FROM l WHERE late"""
)
def stream_log_with_expiry(spark, sf):
    """One log entry of a user and type in 36 hours; what came after the watermark."""

    def job(stream, path, checkpoint):
        out = J.expiring_log(stream, "ts", ["user_id", "event_type"], "event_id", TTL_S, f"{DELAY_S} seconds")
        return J.run_available(out, "append", True, path, checkpoint)

    out = J.in_arrivals(_arriving_events(spark, sf), "arrival", ARRIVALS, job)
    return out.select("kind", "user_id", "event_type", F.col("id").alias("event_id"), "us")


@query(
    f"""WITH t AS (SELECT (conv_id * 7 + turn) % 4 AS arrival, conv_id, turn, {sql_hashed('text')} AS ids FROM conversations),
    s AS (SELECT ids, sum(len(ids)) OVER (ORDER BY arrival, conv_id, turn) - len(ids) AS beg FROM t WHERE len(ids) > 0),
    e AS (SELECT beg + generate_subscripts(ids, 1) - 1 AS ix, unnest(ids) AS id FROM s)
    SELECT CAST(ix // 128 AS BIGINT) AS chunk, CAST(count(*) AS INTEGER) AS n, {sql_ids('list(id ORDER BY ix)')} AS ids FROM e GROUP BY 1"""
)
def stream_wrapped_packing(spark, sf):
    """Every chunk of a stream of turns, in the order of arrival, conversation and turn."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text", ((F.col("conv_id") * 7 + F.col("turn")) % 4).alias("arrival"))

    def job(stream, path, checkpoint):
        ids = stream.select("conv_id", "turn", hashed_ids(F.col("text")).alias("ids"))
        return J.pack_arrivals(ids, ["conv_id", "turn"], "ids", 128, path, checkpoint)

    packed = J.in_arrivals(turns, "arrival", 4, job)
    return packed.select("chunk", F.size("ids").alias("n"), show_ids(F.col("ids")).alias("ids"))
