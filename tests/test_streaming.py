"""Streams over several micro-batches end where the batch job ends."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tunetable.streaming import jobs


@pytest.fixture
def folder(spark, tmp_path):
    """A folder of small files; ``add`` writes one more."""

    class Folder:
        path = str(tmp_path / "in")
        n = 0

        def add(self, rows, ddl):
            df = spark.createDataFrame(rows, ddl)
            df.coalesce(1).write.mode("append").parquet(self.path)
            self.schema = df.schema

        def stream(self):
            return jobs.read_stream(spark, self.path, self.schema, files_per_batch=1)

    return Folder()


START = datetime(2024, 1, 1)


def test_moments(folder):
    for k in range(3):
        folder.add([("a", float(k)), ("b", 1.0), ("a", 5.0)], "key string, v double")
    updates = jobs.run_available(jobs.moments_stream(folder.stream(), "key", "v"), "update")
    assert updates.select("batch_id").distinct().count() == 3
    got = {r.key: (r["count"], r["mean"]) for r in jobs.latest(updates, ["key"]).collect()}
    assert got == {"a": (6, 3.0), "b": (3, 1.0)}


def test_completion_log_drops_repeats(folder):
    for _ in range(2):
        folder.add([(START, 1, "p"), (START, 1, "q"), (START, 2, "p")], "ts timestamp, step long, prompt_id string")
    out = jobs.run_available(jobs.completion_log(folder.stream(), "ts", ["step", "prompt_id"]), "append")
    assert sorted((r.step, r.prompt_id) for r in out.collect()) == [(1, "p"), (1, "q"), (2, "p")]


def test_windows(folder):
    for k in range(3):
        folder.add([(START + timedelta(hours=k), "m", float(k)), (START + timedelta(hours=k, minutes=5), "m", 4.0)], "ts timestamp, name string, v double")
    updates = jobs.run_available(jobs.windowed_metrics(folder.stream(), "ts", "name", "v", "2 hours"), "update")
    final = jobs.latest(updates, ["start", "end", "name"]).orderBy("start").collect()
    assert [(r.n, r.value) for r in final] == [(4, 2.25), (2, 3.0)]


def test_best_rows(folder):
    rows = [("a" if i % 3 else "b", float((i * 37) % 101), i) for i in range(90)]
    for k in range(3):
        folder.add(rows[k * 30 : k * 30 + 30], "key string, score double, id long")
    stream = jobs.best_rows_stream(folder.stream(), "key", F.col("score"), F.col("id"), 5, lanes=3)
    got = jobs.merge_lanes(jobs.run_available(stream, "update", stateful=True), 5).collect()
    for key in "ab":
        best = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2]))[:5]
        assert sorted((r.score, r.id) for r in got if r.key == key) == sorted((s, i) for _, s, i in best)


def test_packing_carries_over(folder):
    seqs = [[i] * (i % 5) for i in range(40)]
    for k in range(4):
        folder.add([(i % 2, i, seqs[i]) for i in reversed(range(k * 10, k * 10 + 10))], "lane int, i int, ids array<int>")
    updates = jobs.run_available(jobs.pack_stream(folder.stream(), F.col("lane"), "ids", 7, ["i"]), "append", stateful=True)
    packed = jobs.packed_so_far(updates).orderBy("lane", "chunk").collect()
    for lane in (0, 1):
        mine = [r for r in packed if r.lane == lane]
        assert [r.chunk for r in mine] == list(range(len(mine)))
        assert all(r.is_full and len(r.ids) == 7 for r in mine[:-1])
        assert [t for r in mine for t in r.ids] == [t for i in range(lane, 40, 2) for t in seqs[i]]


def test_a_restarted_stream_continues(folder, spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: jobs.run_available(jobs.prepare_text(folder.stream(), "text", "!", 3).select("k", "input_ids"), "append", path=out, checkpoint=state)
    folder.add([(1, "a b c d")], "k int, text string")
    assert run().count() == 1
    folder.add([(2, "e!")], "k int, text string")
    got = {r.k: len(r.input_ids) for r in run().collect()}
    assert got == {1: 3, 2: 2}


def test_late_rows_are_counted(folder):
    for k in (5, 0, 9, 2):
        folder.add([(START + timedelta(hours=k), "m", float(k)), (START + timedelta(hours=k), "n", None)], "ts timestamp, name string, v double")
    sums = jobs.run_available(folder.stream(), "append", per_batch=lambda b: jobs.window_sums(b, "ts", "name", "v", "6 hours"))
    final = jobs.merge_window_sums(sums, "name").orderBy("name", "start").collect()
    assert [(r.name, r.n, r.value) for r in final] == [("m", 3, 7 / 3), ("m", 1, 9.0), ("n", 3, None), ("n", 1, None)]


def at(hours):
    return START + timedelta(hours=hours)


def arriving(spark, batches, ddl):
    rows = [(k, *r) for k, rows in enumerate(batches) for r in rows]
    return spark.createDataFrame(rows, "arrival int, " + ddl)


def test_windows_close_and_late_rows_stand_aside(spark):
    """Tumbling windows of two hours, an hour's delay; a row at the window's end belongs to the next window."""
    batches = [
        [(1, at(0), "a", 1.0), (2, at(1.5), "a", None), (3, at(2), "a", 5.0), (4, None, "a", 7.0)],
        [(5, at(0.5), "a", 3.0), (6, at(4), "b", 1.0)],  # watermark 1 h: the first window is open; after this 3 h
        [(7, at(1.9), "a", 9.0), (8, at(2.5), "a", 6.0), (9, at(3), None, 2.0)],  # 7 is late, 8 is not
        [],
        [(10, at(5), "a", 8.0), (11, at(0), None, None)],
    ]
    rows = arriving(spark, batches, "id long, ts timestamp, name string, value double")

    def job(stream, path, checkpoint):
        out = jobs.windows_with_late_rows(stream, "ts", "name", "value", "id", 7200, delay="1 hour", lanes=2)
        return jobs.run_available(out, "append", True, path, checkpoint)

    out = jobs.in_arrivals(rows, "arrival", 5, job)
    start = int(rows.filter("id = 1").select(F.unix_timestamp("ts")).first()[0])
    hour = lambda r: (r.start_s - start) // 3600
    windows = sorted((str(r.name), hour(r), r.n, r.value) for r in jobs.closed_windows(out).select(F.col("name").alias("name"), "start_s", "n", "value").collect())
    assert [w[1:] for w in windows] == [(2, 1, 2.0), (0, 3, 2.0), (2, 2, 5.5)] and windows[0][0] == "None"
    assert sorted((hour(r), r.id, r.value) for r in jobs.late_rows(out).collect()) == [(0, 7, 9.0), (0, 11, None)]


def test_sliding_windows_with_late_rows(spark):
    batches = [[(1, at(0.5), 1.0), (2, at(5), 2.0)], [(3, at(2.5), 4.0), (4, at(9), 1.0)]]
    rows = arriving(spark, batches, "id long, ts timestamp, value double").withColumn("name", F.lit("m"))

    def job(stream, path, checkpoint):
        out = jobs.windows_with_late_rows(stream, "ts", "name", "value", "id", 4 * 3600, 2 * 3600, delay="1 hour", lanes=1)
        return jobs.run_available(out, "append", True, path, checkpoint)

    out = jobs.in_arrivals(rows, "arrival", 2, job)
    start = int(rows.filter("id = 1").select(F.unix_timestamp("ts")).first()[0]) - 1800
    windows = {(r.start_s - start) // 3600: (r.n, r.value) for r in jobs.closed_windows(out).collect()}
    # The watermark is 4 h in the second micro-batch: row 3 is late for the window from 0 to 4 h only.
    assert windows == {-2: (1, 1.0), 0: (1, 1.0), 2: (2, 3.0), 4: (1, 2.0)}
    assert [((r.start_s - start) // 3600, r.id) for r in jobs.late_rows(out).collect()] == [(0, 3)]


def test_log_with_expiring_entries(spark):
    rng = __import__("random").Random(5)
    events = [(i, at(rng.randrange(0, 400) / 4), f"u{rng.randrange(4)}") for i in range(240)]
    batches = [[], [], [], []]
    for e in events:
        batches[min(3, int((e[1] - START).total_seconds() // 90_000) + rng.choice([0, 0, 0, 1, 2]))].append(e)
    batches[0].append((999, None, "u0"))
    ttl, delay = timedelta(hours=10), timedelta(hours=6)
    want, mark, last = [], None, {}
    for batch in batches:
        for i, ts, u in sorted((e for e in batch if e[1]), key=lambda e: (e[1], e[0])):
            if mark is not None and ts < mark - delay:
                want.append(("late", u, i))
            elif u not in last or ts >= last[u] + ttl:
                want.append(("logged", u, i))
                last[u] = ts
        mark = max([e[1] for e in batch if e[1]] + ([mark] if mark else []))

    def job(stream, path, checkpoint):
        return jobs.run_available(jobs.expiring_log(stream, "ts", ["u"], "id", 36_000, "6 hours"), "append", True, path, checkpoint)

    out = jobs.in_arrivals(arriving(spark, batches, "id long, ts timestamp, u string"), "arrival", 4, job)
    assert sorted((r.kind, r.u, r.id) for r in out.collect()) == sorted(want)
    assert {k for k, _, _ in want} == {"late", "logged"}


def test_log_keeps_its_state_by_lane(spark):
    """Hundreds of keys, some NULL or empty, take one state entry a lane and not one a key."""
    keys = [(None if k % 50 == 7 else k + 2**53, [None, "", "a=", "b"][k % 4]) for k in range(300)]
    batches = [[(2**53 + 1000 * b + i, at(10 * b), *k) for i, k in enumerate(keys) if (i + b) % 3] for b in range(2)]
    batches[1] += [(None, at(50), *keys[0]), (5, at(50), *keys[0]), (6, at(-1), *keys[1])]
    want, last = [], {}
    for b, batch in enumerate(batches):
        for i, ts, *k in sorted(batch, key=lambda r: (r[1], r[0] is None, r[0] or 0)):
            if b and ts < at(0) - timedelta(seconds=1):
                want.append(("late", *k, i))
            elif tuple(k) not in last or ts >= last[tuple(k)] + timedelta(hours=20):
                want.append(("logged", *k, i))
                last[tuple(k)] = ts
    seen = []

    def job(stream, path, checkpoint):
        seen.append(checkpoint)
        out = jobs.expiring_log(stream, "ts", ["u", "v"], "id", 72_000, "1 second", lanes=3)
        return jobs.run_available(out, "append", True, path, checkpoint)

    out = jobs.in_arrivals(arriving(spark, batches, "id long, ts timestamp, u long, v string"), "arrival", 2, job)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema][:2] == [("u", "bigint"), ("v", "string")]
    assert sorted(map(str, ((r.kind, r.u, r.v, r.id) for r in out.collect()))) == sorted(map(str, want))
    state = spark.read.format("statestore").option("stateVarName", "last").load(seen[-1])
    assert 0 < state.count() <= 3


def test_packing_in_one_order_of_tokens(spark):
    """Empty and NULL lists, repeated keys, an empty micro-batch and chunks over several of them."""
    batches = [[(i, [100 * k + i] * (i % 4)) for i in reversed(range(9))] + [(3, [7]), (None, [8]), (4, None)] for k in range(3)] + [[], [(1, [5])]]
    rows = arriving(spark, batches, "i int, ids array<int>")
    got = jobs.in_arrivals(rows, "arrival", 5, lambda stream, path, checkpoint: jobs.pack_arrivals(stream, ["i"], "ids", 5, path, checkpoint))
    tokens = [t for batch in batches for _, ids in sorted(batch, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or [])) for t in ids or []]
    packed = sorted((r.chunk, r.ids) for r in got.collect())
    assert [c for c, _ in packed] == list(range(len(packed)))
    assert [t for _, ids in packed for t in ids] == tokens and all(len(ids) == 5 for _, ids in packed[:-1])


STREAMS = ("stream_prepared_turns", "stream_moments", "stream_completion_log", "stream_tumbling_metrics", "stream_sliding_metrics", "stream_replay_buffer", "stream_packed_chunks",
           "stream_wrapped_packing")


def test_queries_read_folders_in_several_batches(spark, tmp_path, monkeypatch):
    """A table may be a folder of unsorted part files, read one per micro-batch."""
    import __spark_entry__ as entry
    from check import rows_of
    from tests.conftest import SF

    for name in ("events", "conversations"):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        df.repartition(3, F.rand(4)).write.parquet(str(tmp_path / f"{name}.parquet"))
    whole, read = jobs.read_stream, jobs.read_stream
    monkeypatch.setattr(jobs, "read_stream", lambda *a, **k: read(*a, **k, files_per_batch=1))
    queries = entry.queries()
    for name in STREAMS:
        parts = queries[name](spark, str(tmp_path))
        with monkeypatch.context() as m:
            m.setattr(jobs, "read_stream", whole)
            once = queries[name](spark, SF)
        assert rows_of(parts.columns, parts.collect()) == rows_of(once.columns, once.collect()), name
