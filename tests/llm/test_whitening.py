import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF
from tunetable.llm import queries, whitening

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(c, T.StringType()) for c in ("key", "n", "whitened", "v", "i")],
    ]
)


def table(spark, vectors, parts=3):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], (i or 0) % 3, "a", "b", None, "d", "e") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def whole(vectors):
    return np.floor(64 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000


def check(got, vectors, components=32):
    """Rows against the eigenvectors of numpy, component by component, up to their sign."""
    x = whole([v for _, v in vectors])
    n, d = x.shape
    y = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, d)
    assert len(got) == n * k
    at = {}
    for r in got:
        at.setdefault(r["component"], {})[r["key"]] = r
    sums = [int(s) for s in x.sum(axis=0)]
    for (i, _), row in zip(vectors, x.tolist(), strict=True):
        want = sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        assert {int(at[c][i]["deviation"]) for c in at} == {want} and at[1][i]["n"] == n
    white = np.array([[at[c + 1][i]["whitened"] if at[c + 1][i]["whitened"] is not None else math.nan for c in range(k)] for i, _ in vectors])
    varied = values[:k] > values[0] * 1e-20
    for c in range(k):
        explained = {at[c + 1][i]["explained"] for i, _ in vectors}
        assert len(explained) == 1 and explained.pop() == pytest.approx(max(values[c], 0) / values.sum() if values.sum() else 0, rel=1e-9, abs=1e-15)
    spread = white[:, varied[:k] & ~np.isnan(white[0])]
    cov = (spread - spread.mean(axis=0)).T @ (spread - spread.mean(axis=0)) / n
    assert np.abs(cov - np.eye(cov.shape[0])).max(initial=0) < 1e-9
    assert 0 <= got[0]["identity_error"] < 1e-9
    return white, y, values, axes


def test_matches_eigenvectors(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, v) for i, v in enumerate((rng.normal(size=(300, 12)) * np.linspace(0.2, 3, 12)) @ rng.normal(size=(12, 12)))]
    got = whitening.by_component(whitening.whitened(table(spark, vectors), components=8)).collect()
    white, y, values, axes = check(got, vectors, 8)
    for c in range(8):
        want = y @ axes[:, c] / math.sqrt(values[c])
        assert min(np.abs(white[:, c] - want).max(), np.abs(white[:, c] + want).max()) < 1e-8


def test_badly_conditioned(spark):
    """Deviations from 10^5 down to 1 unit: one Cholesky factor of the Gram matrix would lose the small ones."""
    rng = np.random.default_rng(2)
    scales = np.array([2000, 300, 20, 1, 0.1, 0.05])
    vectors = [(i, v) for i, v in enumerate(rng.normal(size=(400, 6)) * scales)]
    got = whitening.by_component(whitening.whitened(table(spark, vectors))).collect()
    white, y, values, axes = check(got, vectors)
    for c in range(6):
        want = y @ axes[:, c] / math.sqrt(values[c])
        assert min(np.abs(white[:, c] - want).max(), np.abs(white[:, c] + want).max()) < 1e-6


def test_directions_without_variance(spark):
    rng = np.random.default_rng(3)
    low = rng.integers(-40, 40, size=(80, 3)) / 64
    vectors = [(i, [*v, v[0] + v[1], 0.5, 2 * v[2]]) for i, v in enumerate(low)]
    got = whitening.by_component(whitening.whitened(table(spark, vectors))).collect()
    check(got, vectors)
    assert {r["component"] for r in got if r["whitened"] is None} == {4, 5, 6} and {r["explained"] for r in got if r["component"] > 3} == {0.0}


@pytest.mark.parametrize("rows", [1, 2, 5])
def test_fewer_rows_than_dimensions(spark, rows):
    rng = np.random.default_rng(4)
    vectors = [(i, v) for i, v in enumerate(rng.normal(size=(rows, 7)))]
    got = whitening.by_component(whitening.whitened(table(spark, vectors))).collect()
    assert len(got) == 7 * rows
    assert len({r["component"] for r in got if r["whitened"] is not None}) == rows - 1


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(5)
    sound = [(i, v) for i, v in enumerate(rng.normal(size=(50, 5)))]
    odd = [(60, None), (61, [1, None, 2, 3, 4]), (62, [math.nan, 0, 0, 0, 0]), (63, [math.inf, 0, 0, 0, 0]), (64, []), (65, [1, 2]), (66, [-math.inf] * 5)]
    got = whitening.by_component(whitening.whitened(table(spark, sound + odd))).collect()
    check(got, sound)


def test_repeated_rows_and_null_keys(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, v) for i, v in enumerate(rng.normal(size=(30, 4)))]
    again = vectors + [vectors[3]] * 15 + [(None, vectors[0][1])]
    got = whitening.whitened(table(spark, again)).collect()
    assert len(got) == 46 and {r["n"] for r in got} == {46} and sum(r["key"] is None for r in got) == 1
    assert len({r["deviation"] for r in got if r["key"] == 3}) == 1
    named = [(100 + k, v) for k, (_, v) in enumerate(again)]
    check(whitening.by_component(whitening.whitened(table(spark, named))).collect(), named)


def test_deviation_beyond_64_bits():
    x = whole([[1.0, -2.0], [3.0, 5.0], [0.25, 0.5]])
    n, sums = 10**13 + 7, [7 * 10**18 + 3, 10**19 + 9]
    want = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
    assert whitening.Centred(n, sums).deviation(x) == want and max(want) > 2**63


def test_entry_out_of_range(spark):
    with pytest.raises(Exception, match="beyond"):
        whitening.whitened(table(spark, [(0, [1e20, 1]), (1, [1, 2])])).collect()


def test_empty_table(spark):
    for rows in ([], [(1, None), (2, [])]):
        out = whitening.by_component(whitening.whitened(table(spark, rows, 1)))
        assert out.columns == ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = queries.op12_whitening(spark, SF)
    assert got.select("n", "deviation", "component").dtypes == [("n", "bigint"), ("deviation", "bigint"), ("component", "int")]
    vectors = [(r["vec_id"], r["embedding"]) for r in rows]
    white, y, values, axes = check(got.withColumnRenamed("vec_id", "key").collect(), vectors)
    for c in range(32):
        want = y @ axes[:, c] / math.sqrt(values[c])
        assert min(np.abs(white[:, c] - want).max(), np.abs(white[:, c] + want).max()) < 1e-6


def test_factor_is_the_centred_rows(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(90, 6)) * [30, 9, 3, 1, 0.5, 0.2]
    x = whole(vectors)
    centred = whitening.Centred(len(x), [int(s) for s in x.sum(axis=0)])
    found = whitening.factor(table(spark, list(enumerate(vectors))).select(F.col("embedding").alias("v")), 6, centred)
    y = x - x.mean(axis=0)
    assert np.allclose(found.T @ found, y.T @ y, rtol=1e-12, atol=1e-6)
