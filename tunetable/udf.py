"""User functions: rewards, formatting, group filters, judges and scorers.

A user function is a column builder where possible. Python functions run on Arrow
batches, one call per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnReward = Callable[..., Column]
BatchReward = Callable[..., Sequence[float | None]]


class RewardRegistry:
    """Rewards by name."""

    def __init__(self) -> None:
        self._columns: dict[str, tuple[ColumnReward, tuple[str, ...]]] = {}

    def add_column(self, name: str, build: ColumnReward, *inputs: str) -> None:
        """A reward built from columns."""
        self._columns[name] = (build, inputs)

    def add_batch(self, name: str, score: BatchReward, *inputs: str) -> None:
        """A Python reward: called with one list per input, returns a score or None per row."""

        @F.pandas_udf(T.DoubleType())
        def udf(*series: pd.Series) -> pd.Series:
            scores = score(*[s.tolist() for s in series])
            return pd.Series([None if x is None else float(x) for x in scores], dtype="Float64")

        udf_annotated = udf
        self._columns[name] = (lambda *cols: udf_annotated(*cols), inputs)

    def names(self) -> list[str]:
        return list(self._columns)

    def score(self, df: DataFrame, *names: str) -> DataFrame:
        """One nullable column per reward."""
        wanted = names or tuple(self._columns)
        unknown = [n for n in wanted if n not in self._columns]
        if unknown:
            raise ValueError(f"unknown rewards {unknown}; known: {sorted(self._columns)}")
        built = {n: self._columns[n][0](*[F.col(c) for c in self._columns[n][1]]) for n in wanted}
        return df.withColumns(built)


def format_rows(df: DataFrame, build: Callable[[Mapping[str, Column]], Column], out: str = "text") -> DataFrame:
    """Text built from the row's columns."""
    return df.withColumn(out, build({c: F.col(c) for c in df.columns}))


def format_rows_python(df: DataFrame, fmt: Callable[[dict], str], inputs: Sequence[str], out: str = "text") -> DataFrame:
    """Text from a Python function of one example."""

    @F.pandas_udf(T.StringType())
    def udf(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([fmt(r) for r in rows.to_dict("records")], dtype=object)

    return df.withColumn(out, udf(F.struct(*inputs)))


def group_scores(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    completion: str,
    reward: str,
    score: Callable[[list[str], list[float]], Sequence[float]],
    out: str = "filter_score",
) -> DataFrame:
    """Filter scores from a function of whole groups.

    The function sees a group at once, so a group must fit a task; for larger ones use a
    column score with ``keep_best``.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])

    def per_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        scores = score(rows[completion].tolist(), rows[reward].tolist())
        return rows.assign(**{out: [float(s) for s in scores]})

    return df.groupBy(*keys).applyInPandas(per_group, schema)


def _judged(df: DataFrame, make_judge: Callable[[], Callable], inputs: Sequence[str], out: str, returns: T.DataType) -> DataFrame:
    dtype = "Int32" if isinstance(returns, T.IntegerType) else object

    @F.pandas_udf(returns)
    def udf(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        judge = make_judge()
        for columns in batches:
            given = [[list(x) if hasattr(x, "__len__") and not isinstance(x, str) else x for x in c] for c in columns]
            yield pd.Series(judge(*given), dtype=dtype)

    return df.withColumn(out, udf(*inputs))


def judge_rows(
    df: DataFrame,
    make_judge: Callable[[], Callable[[list, list], Sequence[int]]],
    prompt: str,
    completions: str,
    out: str = "verdict",
) -> DataFrame:
    """Verdicts of a judge made once per task; ``completions`` is a text or a list of candidates."""
    return _judged(df, make_judge, [prompt, completions], out, T.IntegerType())


def rank_rows(
    df: DataFrame,
    make_judge: Callable[[], Callable[[list, list], Sequence[Sequence[int]]]],
    prompt: str,
    completions: str,
    out: str = "ranks",
) -> DataFrame:
    """Ranks of any number of candidates: their 0-based places in the list, the best first."""
    return _judged(df, make_judge, [prompt, completions], out, T.ArrayType(T.IntegerType()))


def binary_rows(
    df: DataFrame,
    make_judge: Callable[[], Callable[..., Sequence[int]]],
    prompt: str,
    completion: str,
    gold: str | None = None,
    out: str = "satisfied",
) -> DataFrame:
    """Whether a completion satisfies a constraint: 1, 0, or -1 if the judge failed. A gold completion may be given."""
    return _judged(df, make_judge, [prompt, completion, *([gold] if gold else [])], out, T.IntegerType())


def apply_scorers(df: DataFrame, scorers: Mapping[str, Callable[[Column, Column], Column]], prompt: str, completion: str) -> DataFrame:
    """Named scorers in one struct column; a scorer may be a column builder or a pandas UDF."""
    built = [f(F.col(prompt), F.col(completion)).alias(n) for n, f in scorers.items()]
    return df.withColumn("scores", F.struct(*built))
