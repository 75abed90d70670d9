"""Packing: golden cases and properties."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tunetable.operators.pack import best_fit_bins, concat_batches, pack_bfd, pack_wrapped

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def table(spark, seqs):
    rows = [(i, s, [1] * len(s)) for i, s in enumerate(seqs)]
    return spark.createDataFrame(rows, "id long, input_ids array<int>, attention_mask array<int>")


def runs(*sizes):
    out, n = [], 1
    for s in sizes:
        out.append(list(range(n, n + s)))
        n += s
    return out


@pytest.mark.parametrize(
    ("length", "seqs", "rows", "lengths"),
    [
        (6, runs(2, 5, 4), [[3, 4, 5, 6, 7], [8, 9, 10, 11, 1, 2]], [[5], [4, 2]]),
        (3, runs(7, 1, 1), [[1, 2, 3], [8, 9]], [[3], [1, 1]]),
        (10, runs(6, 6, 3, 3, 1), [[1, 2, 3, 4, 5, 6, 13, 14, 15, 19], [7, 8, 9, 10, 11, 12, 16, 17, 18]], [[6, 3, 1], [6, 3]]),
    ],
)
def test_best_fit(spark, length, seqs, rows, lengths):
    got = pack_bfd(table(spark, seqs), "id", length).collect()
    assert sorted((r.input_ids, r.seq_lengths) for r in got) == sorted(zip(rows, lengths))
    assert all(r.attention_mask == [1] * len(r.input_ids) for r in got)


def test_wrapped(spark):
    got = pack_wrapped(table(spark, runs(1, 9, 0, 2, 5)), "id", 4).orderBy("chunk").collect()
    assert [r.input_ids for r in got] == [[1, 2, 3, 4], [5, 6, 7, 8], [9, 10, 11, 12], [13, 14, 15, 16], [17]]
    assert [len(r.attention_mask) for r in got] == [4, 4, 4, 4, 1]


SEQS = st.lists(st.integers(0, 12), min_size=1, max_size=40)


@given(SEQS, st.integers(1, 10))
def test_best_fit_bins_properties(sizes, length):
    sizes = [min(s, length) for s in sizes if s]
    bins = best_fit_bins(sizes, length) if sizes else []
    assert sorted(r for b in bins for r in b) == list(range(len(sizes)))
    loads = [sum(sizes[r] for r in b) for b in bins]
    assert all(x <= length for x in loads)
    # First-fit bound: no two bins could have been one.
    assert all(a + b > length for i, a in enumerate(loads) for b in loads[i + 1 :])


@FEW
@given(SEQS, st.integers(1, 10), st.booleans())
def test_packing_keeps_every_token(spark, sizes, length, grouped):
    seqs = runs(*sizes)
    df = table(spark, seqs).drop("attention_mask").withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(1))
    keys = ["g"] if grouped else []
    df = df.select("id", *keys, "input_ids")
    wrapped = pack_wrapped(df, "id", length, keys).orderBy(*keys, "chunk").collect()
    best = pack_bfd(df, "id", length, batch_rows=7, keys=keys).collect()
    assert sorted(t for r in wrapped for t in r.input_ids) == [t for s in seqs for t in s]
    assert sorted(t for r in best for t in r.input_ids) == sorted(t for s in seqs for t in s[:length])
    parts = [[r for r in wrapped if r.g == g] for g in (0, 1)] if grouped else [wrapped]
    assert all(len(r.input_ids) == length for part in parts for r in part[:-1])
    assert all(sum(r.seq_lengths) == len(r.input_ids) <= length for r in best)
    starts = {s[0]: s[:length] for s in seqs if s}
    for r in best:
        at = 0
        for n in r.seq_lengths:
            assert r.input_ids[at : at + n] == starts[r.input_ids[at]]
            at += n


def test_wrapped_keeps_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, 1, [1, 2]), (None, 1, [3]), ("a", 5, [4, 5, 6]), ("a", None, [7]), (None, 2, [])], "g string, id long, x array<int>")
    got = pack_wrapped(df, "id", 2, ["g"]).collect()
    assert sorted(t for r in got for t in r.x) == [1, 2, 3, 4, 5, 6, 7]
    assert [r.x for r in sorted(got, key=lambda r: (str(r.g), r.chunk))] == [[1, 2], [3], [7, 4], [5, 6]]


def test_wrapped_with_a_split_hot_group(spark):
    df = spark.range(60).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), F.array(F.col("id").cast("int"), F.col("id").cast("int")).alias("x"))
    got = pack_wrapped(df, "id", 4, ["g"]).filter("g = 0").orderBy("chunk").collect()
    hot = [i for i in range(60) if i % 3 == 0]
    assert [t for r in got for t in r.x] == [t for i in hot for t in (i, i)]
    assert all(len(r.x) == 4 for r in got)


def test_concat_batches(spark):
    df = table(spark, runs(2, 1, 3)).withColumn("b", F.lit(0))
    row = concat_batches(df, "b", "id", ["input_ids"]).first()
    assert (row.input_ids, row.seq_lengths) == ([1, 2, 3, 4, 5, 6], [2, 1, 3])
