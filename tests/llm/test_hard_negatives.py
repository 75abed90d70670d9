import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunetable.llm import hard_negatives as hn

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(c, T.StringType()) for c in ("key", "q", "v", "block", "slice", "rank")],
    ]
)


def table(spark, rows):
    data = [(i, None if v is None else [None if x is None else float(x) for x in v], c, "a", "b", None, "d", "e", "f") for i, v, c in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def brute(rows, step, positives=5, negatives=5, low=80, high=100):
    sound = {}
    for i, v, c in rows:
        if i is not None and v is not None and len(v) and c is not None and all(x is not None and math.isfinite(x) for x in v):
            sound.setdefault(i, (c, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(int).tolist()))
    out = []
    for a, (c, q) in sound.items():
        if a % step:
            continue
        scores = [(-sum(map(lambda x, y: x * y, q, r)), i, d) for i, (d, r) in sound.items() if i != a]
        for p, j, _ in sorted(s for s in scores if s[2] == c)[:positives]:
            fits = sorted((s, i) for s, i, d in scores if d != c and low * -p <= 100 * -s <= high * -p)
            out += [(a, j, k + 1, i, -p, -s) for k, (s, i) in enumerate(fits[:negatives])]
    return sorted(out)


def run(spark, rows, step, **options):
    return sorted(tuple(r) for r in hn.mine(table(spark, rows), F.col("vec_id") % step == 0, **options).collect())


def clustered(seed, n, dim=8, groups=5, noise=0.15):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    return [(i, centres[i % groups] + noise * rng.normal(size=dim), int(rng.integers(4))) for i in range(n)]


@pytest.mark.parametrize("block, slice_rows", [(8192, 8192), (7, 50)])
def test_matches_brute_force(spark, block, slice_rows):
    rows = clustered(1, 300)
    want = brute(rows, 10)
    assert want and run(spark, rows, 10, block=block, slice_rows=slice_rows) == want


def test_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(0, 3, size=3) / 4, i % 2) for i in range(200)]
    assert run(spark, rows, 25, block=3, slice_rows=40) == brute(rows, 25)


def test_a_third_of_the_rows_are_one_vector(spark):
    rows = clustered(3, 200) + [(1000 + i, [0.5] * 8, i % 3) for i in range(100)]
    assert run(spark, rows, 20, slice_rows=60) == brute(rows, 20)


def test_rows_that_take_no_part(spark):
    rows = clustered(4, 80)
    odd = [(90, None, 1), (100, [1.0] * 7 + [None], 1), (110, [math.nan] * 8, 2), (120, [math.inf] * 8, 0), (130, [0.1] * 8, None), (None, [0.3] * 8, 1), (140, [], 0)]
    assert run(spark, rows + odd, 10) == brute(rows, 10)
    other = [(150, [1.0, 2.0], 1)]  # another length than most
    assert run(spark, rows + odd + other, 10) == brute(rows, 10)


def test_repeated_rows_count_once(spark):
    rows = clustered(5, 60)
    assert run(spark, rows + [rows[10]] * 30 + [rows[7]] * 5, 10) == brute(rows, 10)


def test_few_rows(spark):
    one = [(0, [1.0, 0.0], 1)]
    for rows in ([], one, one + [(1, [1.0, 0.0], 1)], one + [(1, [1.0, 0.0], 2)], one + [(1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2)], [(0, [0.0], 1), (1, [1.0], 1), (2, [-1.0], 2)]):
        assert run(spark, rows, 10) == brute(rows, 10)


def test_negative_and_zero_scores(spark):
    rng = np.random.default_rng(6)
    rows = [(i, -abs(rng.normal(size=4)) if i % 5 else abs(rng.normal(size=4)), i % 3) for i in range(60)] + [(100 + i, [0.0] * 4, i % 3) for i in range(6)]
    assert run(spark, rows, 5) == brute(rows, 5)


def test_tree_spans_and_is_shallow():
    rng = np.random.default_rng(7)
    a = np.floor(256 * rng.normal(size=(120, 6)))
    for depth in (1, 3, 16):
        parent, edge = hn.spanning_tree(a, depth)
        assert (parent == -1).sum() == 1
        for v in range(120):
            steps, w = 0, v
            while parent[w] >= 0:
                w, steps = parent[w], steps + 1
            assert steps <= depth
            if parent[v] >= 0:
                assert edge[v] == pytest.approx(np.linalg.norm(a[v] - a[parent[v]]))


def test_bounds_hold_and_save_work():
    """Bounds never lose a row of a window, and on close anchors most rows are not scored again."""
    rng = np.random.default_rng(8)
    a = np.floor(256 * (rng.normal(size=16) + 0.02 * rng.normal(size=(40, 16))))
    c = np.floor(256 * rng.normal(size=(3000, 16)))
    parent, edge = hn.spanning_tree(a)
    low, high = 500_000, 600_000
    scored = 0

    def wanted(v, lo, hi):
        s = c @ a[v]
        assert (lo <= s).all() and (s <= hi).all()
        return (hi >= low) & (lo <= high)

    for v, rows, scores in hn.walk(a, parent, edge, c, wanted):
        s = c @ a[v]
        assert (scores == s[rows]).all()
        assert set(np.flatnonzero((s >= low) & (s <= high))) <= set(rows.tolist())
        scored += len(rows)
    assert scored < 0.3 * a.shape[0] * len(c)


def test_entry_out_of_range(spark):
    with pytest.raises(Exception, match="beyond|too large"):
        run(spark, [(0, [1e12, 0.0], 1), (1, [1.0, 0.0], 1)], 10)
    with pytest.raises(Exception, match="too large"):
        run(spark, [(0, [8e6] * 4, 1), (1, [8e6] * 4, 1)], 10)
