"""Embedding whitening by shifted CholeskyQR.

The centred rows A are orthogonalised by distributed passes. A pass adds up the Gram matrix of the rows
so far, Q = A R^-1 by a triangular solve; its Cholesky factor, shifted in the first pass so that it exists for any
matrix, multiplies R. When Q is orthonormal (or has zero directions, for data of lower rank), an SVD of the
small factor gives the principal directions and their variances.

Scale: every pass is one scan of the vectors in Arrow batches, without a shuffle of rows: a task sends
one d x d matrix, Spark adds them up by entry, and d x d numbers reach the driver, whatever the
number of rows. Three Gram passes serve well-conditioned data. A pass has no state, so
a lost task is run again; copies of a vector, in any number, are rows like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.llm.vectors import scaled, sound_rows

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Gram passes at most, and how far from orthonormal the rows may be at the end.
PASSES, CLOSE = 6, 1e-13
# A direction with less than this share of the largest deviation (times d) has no variance but rounding.
NO_VARIANCE = 16 * np.finfo(np.float64).eps
# Entries beyond this many units are an error, so that sums of squares stay exact in 64 bits.
_MOST = 1 << 24

_TOTALS = "dim int, n long, sums array<long>"
_GRAM = "i int, row array<double>"


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, pa.RecordBatch, np.ndarray]]:
    """For each batch: which rows take part, the batch, and their whole numbers."""
    for batch in batches:
        lengths, owner, values = sound_rows(batch.column("v"))
        fits = lengths == dim
        if fits.any():
            yield fits, batch, scaled(values[fits[owner]], SCALE, _MOST).reshape(-1, dim) + SHIFT


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and sums of the task's vectors, by length."""
    found: dict[int, list] = {}
    for batch in batches:
        lengths, owner, values = sound_rows(batch.column("v"))
        for dim in np.unique(lengths[lengths > 0]).tolist():
            fits = lengths == dim
            x = scaled(values[fits[owner]], SCALE, _MOST).reshape(-1, dim) + SHIFT
            entry = found.setdefault(dim, [0, np.zeros(dim, np.int64)])
            entry[0] += len(x)
            entry[1] += x.sum(axis=0)
    if found:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array([n for n, _ in found.values()], pa.int64()), pa.array([s.tolist() for _, s in found.values()], pa.list_(pa.int64()))],
            ["dim", "n", "sums"],
        )


class Centred:
    """Rows minus their mean, from exact totals. The whole part of the mean goes first, so that nothing is rounded but the last step."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of ``(n * x - S) ** 2``, exact for any ``n``."""
        y = x - self.base
        if len(y) and int(np.abs(y).max()) * self.n * len(self.rest) >= 1 << 62:
            y = y.astype(object)
        n, square = self.n, sum(int(r) ** 2 for r in self.rest.tolist())
        cross = (y * self.rest).sum(axis=1).tolist()
        return [n * n * s - 2 * n * c + square for s, c in zip((y * y).sum(axis=1).tolist(), cross, strict=True)]


def _gram(rows: DataFrame, dim: int, width: int, turned) -> np.ndarray:
    """The Gram matrix of ``turned`` rows, below it their sums: (width + 1) x width numbers added up by Spark."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for _, _, x in _matrices(batches, dim):
            q = turned(x)
            total[:-1] += q.T @ q
            total[-1] += q.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    parts = rows.mapInArrow(task, _GRAM).select("i", F.posexplode("row").alias("j", "value"))
    out = np.zeros((width + 1, width))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[r["i"], r["j"]] = r["value"]
    return out


def _solved(centred: Centred, r: np.ndarray):
    return lambda x: np.linalg.solve(r.T, centred.rows(x).T).T


def factor(rows: DataFrame, dim: int, centred: Centred) -> np.ndarray:
    """A matrix F with FᵀF = AᵀA for the centred rows A, by shifted CholeskyQR."""
    r, size, unit = np.eye(dim), centred.n * dim + dim * (dim + 1), np.finfo(np.float64).eps / 2
    gram = _gram(rows, dim, dim, _solved(centred, r))[:-1]
    for k in range(PASSES):
        w, u = np.linalg.eigh((gram + gram.T) / 2)
        if k and np.abs(w * (w - 1)).max() <= CLOSE * dim:
            break
        shift = 0.0 if k and w[0] > 0.5 else 11 * size * unit * max(w[-1], np.finfo(np.float64).tiny)
        r = np.linalg.cholesky((gram + gram.T) / 2 + shift * np.eye(dim)).T @ r
        gram = _gram(rows, dim, dim, _solved(centred, r))[:-1]
    w, u = np.linalg.eigh((gram + gram.T) / 2)
    return (u * np.sqrt(np.maximum(w, 0))) @ u.T @ r  # A = Q R, where QᵀQ is the last Gram matrix


def whitened(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector that takes part: ``key, n, deviation, whitened, explained, identity_error``.

    Vectors that are NULL or hold a NULL or non-finite entry are left out, as are empty ones and
    those of another length than most vectors have (of two equally frequent ones the longer counts). An entry c
    counts as ``floor(64 c) + 1000000``; one beyond 2^18 is an error. ``deviation`` is a decimal(38, 0); ``whitened`` and ``explained``
    are arrays over the components by falling variance. A direction without variance (constant or
    dependent dimensions, fewer vectors than dimensions) has NULL in ``whitened`` and 0 in
    ``explained`` and is left out of ``identity_error``. Equal vectors, repeated rows and NULL keys are rows like any other.
    An empty table gives an empty result. Other columns, of any name, are not looked at.
    """
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("v"))
    out = "key " + rows.schema["key"].dataType.simpleString() + ", deviation string, whitened array<double>"
    totals = rows.select("v").mapInArrow(_totals, _TOTALS)
    top = totals.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if top is None:
        empty = rows.filter(F.lit(False))
        return empty.select(
            "key", *[F.lit(None).cast(t).alias(c) for c, t in (("n", "long"), ("deviation", "decimal(38,0)"), ("whitened", "array<double>"), ("explained", "array<double>"), ("identity_error", "double"))]
        )
    dim, n = top["dim"], top["n"]
    sums = totals.filter(F.col("dim") == dim).select(F.posexplode("sums").alias("j", "s")).groupBy("j").agg(F.sum("s").alias("s")).collect()
    centred = Centred(n, [r["s"] for r in sorted(sums, key=lambda r: r["j"])])

    vectors = rows.select("v")
    _, sigma, right = np.linalg.svd(factor(vectors, dim, centred))
    varied = int((sigma > sigma[0] * NO_VARIANCE * dim).sum())
    count = min(components, dim)
    used = min(count, varied)
    variance = sigma**2 / n
    explained = [float(v / variance.sum()) if i < used else 0.0 for i, v in enumerate(variance[:count])]
    turn = right[:used].T / np.sqrt(variance[:used])

    error = 0.0
    if used:
        mean = _gram(vectors, dim, used, lambda x: centred.rows(x) @ turn)[-1] / n
        spread = _gram(vectors, dim, used, lambda x: centred.rows(x) @ turn - mean)[:-1] / n
        error = float(np.abs(spread - np.eye(used)).max())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fits, batch, x in _matrices(batches, dim):
            white = centred.rows(x) @ turn
            none = [None] * (count - used)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").filter(pa.array(fits)), pa.array(map(str, centred.deviation(x)), pa.string()), pa.array([r + none for r in white.tolist()], pa.list_(pa.float64()))],
                ["key", "deviation", "whitened"],
            )

    return rows.mapInArrow(task, out).select(
        "key",
        F.lit(n).cast("long").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened",
        F.lit(explained).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def by_component(white: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    listed: Column = F.posexplode("whitened").alias("i", "white")
    return white.select("key", "n", "deviation", "explained", "identity_error", listed).select(
        "key",
        (F.col("i") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("white").alias("whitened"),
        F.get("explained", F.col("i")).alias("explained"),
        "identity_error",
    )
