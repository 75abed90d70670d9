import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.llm.data import awkward, documents, prose
from tunetable.llm import fair_mix as fm
from tunetable.llm import virtual_slots as vs
from tunetable.llm.text import word_count


def fill(sizes, weights=(3, 1, 2), share=Fraction(3, 2), epochs=2):
    """Targets by repeated capping."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, capped = share * sum(sizes.values()), {}
    while len(capped) < len(names):
        rest = budget - sum(capped.values())
        open_ = {s: w for s, w in weight.items() if s not in capped}
        targets = {s: rest * w / sum(open_.values()) for s, w in open_.items()}
        over = {s: Fraction(epochs * sizes[s]) for s, t in targets.items() if t > epochs * sizes[s]}
        if not over:
            return {**capped, **targets}
        capped |= over
    return capped


def mixed(spark, rows):
    docs = documents(spark, rows).select("doc_id", "source", word_count(F.col("text")).alias("size"), F.lit(1).alias("row"))
    return fm.served(docs).collect()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken(spark, seed):
    rng = random.Random(seed)
    rows = awkward(seed) + [(1000 + i, prose(rng, rng.randrange(0, 300)), rng.choice(["a", "b", "B", "ü", None, "huge", "huge", "huge"])) for i in range(120)]
    rows += [(2000, "", "blank"), (2000, None, "blank")]
    got = mixed(spark, rows)
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = fill(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1
    key = lambda r: tuple(map(str, r))
    again = fm.served(documents(spark, rows[::-1]).repartition(7).select("doc_id", "source", word_count(F.col("text")).alias("size"), F.lit(1).alias("row"))).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_served_in_order_of_finish(spark):
    rng = random.Random(8)
    got = mixed(spark, [(i, prose(rng, 20), f"s{i % 3}") for i in range(90)])
    by_source = defaultdict(list)
    for r in got:
        by_source[r["source"]].append((r["finish"], r["taken"], r["size"]))
    for rows in by_source.values():
        epochs = [t / n for _, t, n in sorted(rows)]
        assert epochs == sorted(epochs, reverse=True)  # earlier finish, never fewer words


def test_mixed_documents(spark):
    rows = awkward()
    df = documents(spark, rows)
    mix = fm.mixed_documents(df)
    assert mix.columns == df.columns
    copies = Counter(r["doc_id"] for r in mix.collect())
    held = Counter(i for i, _, _ in rows)
    assert copies and all(n <= 2 * held[i] for i, n in copies.items())
    assert 100 not in copies and 102 not in copies
    assert fm.mixed_documents(documents(spark, [])).count() == 0 and mixed(spark, []) == []


def test_slots_are_gapless_and_sizes_near(spark):
    rng = random.Random(1)
    rows = awkward() + [(1000 + i, prose(rng, rng.randrange(300)), "s") for i in range(600)]
    df = documents(spark, rows).select(
        "doc_id", vs.byte_size(F.col("text")).alias("size"), vs.slot_of(F.col("doc_id"), F.col("text")).alias("virtual_slot"), F.crc32(F.col("text").cast("binary")).alias("c")
    )
    got = vs.numbered(df, 16, order=["doc_id", "c"]).collect()
    assert len(got) == len(rows)
    shards, loads = defaultdict(list), Counter()
    for r in got:
        shards[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in shards.values())
    assert sum(loads.values()) == sum(len((t or "").encode()) + 1 for _, t, _ in rows)
    assert max(loads.values()) - min(loads.values()) <= max(_slot_sizes(got).values())


def _slot_sizes(rows):
    out = Counter()
    for r in rows:
        out[r["virtual_slot"]] += r["size"]
    return out


def test_rebalancing_moves_little(spark, tmp_path):
    rng = random.Random(3)
    sizes = {i: rng.randrange(1, 1000) for i in range(512)}
    old = vs.first_map(sizes, 8, 512)
    grown = vs.rebalanced(old, sizes, 9)
    load = lambda m, n: [sum(sizes[i] for i in range(512) if m[i] == s) for s in range(n)]
    assert max(load(grown, 9)) - min(load(grown, 9)) <= 0.02 * sum(sizes.values()) / 9
    moved = [i for i in range(512) if old[i] != grown[i]]
    assert len(moved) <= 512 // 9 + 40 and sum(grown[i] != 8 for i in moved) <= 8
    assert vs.rebalanced(old, sizes, 8) == old
    shrunk = vs.rebalanced(grown, sizes, 8)
    assert set(shrunk) == set(range(8))
    path = str(tmp_path / "map")
    vs.store_map(spark, old, 1, path)
    newest = vs.store_map(spark, grown, 2, path)
    assert [r["shard"] for r in newest.orderBy("slot").collect()] == grown
    assert [r["shard"] for r in vs.read_map(spark, path, 1).orderBy("slot").collect()] == old
    assert vs.read_map(spark, path).first()["version"] == 2


def test_sharded_keeps_columns(spark):
    rows = awkward()
    df = documents(spark, rows, extra=False)
    out = vs.sharded(df, 4)
    assert out.columns == [*df.columns, "virtual_slot", "size", "shard", "map_version"]
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(i) for i, _, _ in rows)
    assert vs.sharded(documents(spark, rows), 4).count() == len(rows)
    assert vs.sharded(documents(spark, []), 4).count() == 0


def test_a_stored_map_is_edited_by_version(spark, tmp_path):
    path = str(tmp_path / "map")
    docs = documents(spark, [(i, "x" * (1 + i * 7 % 50), "s") for i in range(300)]).withColumn("_slot", F.lit("clash")).withColumn("_entry", F.lit("clash"))
    runs = [sorted((r["doc_id"], r["shard"], r["map_version"]) for r in vs.sharded(docs, n, path=path).collect()) for n in (4, 4, 5, 5)]
    assert [len(r) for r in runs] == [300] * 4 and [{v for _, _, v in r} for r in runs] == [{1}, {2}, {3}, {4}]
    shards = [[s for _, s, _ in r] for r in runs]
    assert shards[0] == shards[1] and shards[2] == shards[3]
    moved = [(a, b) for a, b in zip(shards[1], shards[2], strict=True) if a != b]
    assert 0 < len(moved) < 90 and sum(b != 4 for _, b in moved) <= 5
    again = vs.store_map(spark, [0] * vs.SLOTS, 2, path)  # a repeated write replaces itself
    assert again.count() == vs.SLOTS and vs.read_map(spark, path).first()["version"] == 4


@pytest.mark.parametrize("copies", [1000, 1])
def test_shards_stay_near_equal_with_repeated_rows(spark, copies):
    rows = [(1, "hot " * 10, "s")] * copies + [(None, "also", None)] * copies + [(i, "t" * 40, "s") for i in range(10, 4010)]
    df = documents(spark, rows).select("doc_id", vs.byte_size(F.col("text")).alias("size"), vs.slot_of(F.col("doc_id"), F.col("text")).alias("virtual_slot"))
    got = vs.numbered(df, 16, order=["doc_id", "size"]).collect()
    loads = [sum(r["size"] for r in got if r["shard"] == s) for s in range(16)]
    assert len(got) == len(rows) and max(loads) - min(loads) <= 0.01 * sum(loads) / 16 + 41
    for s in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
