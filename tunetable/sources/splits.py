"""Train/test splits. The same rows always land on the same side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.operators.ordering import first_in_order

_SLOTS = 1 << 40


def hash_slot(key: str | Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(_SLOTS))


def fraction_split(df: DataFrame, slot: Column, test_size: float, slots: int = _SLOTS) -> tuple[DataFrame, DataFrame]:
    """Split by a row's slot in ``[0, slots)``, by default a ``hash_slot``: no shuffle, no count."""
    test = slot < F.lit(round(test_size * slots))
    return df.filter(~test), df.filter(test)


def sized_split(df: DataFrame, key: str, train_size: int, order: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Split off exactly ``train_size`` rows, the first by ``order`` (a hash) and key."""
    tagged = df.withColumn("_order", F.xxhash64(key) if order is None else order)
    train = first_in_order(tagged, train_size, "_order", key)
    tagged = tagged.withColumn("_train", train)
    return tagged.filter("_train").drop("_order", "_train"), tagged.filter("NOT _train").drop("_order", "_train")


def _rows(df: DataFrame) -> Column:
    """Number of rows, counted when the result is computed."""
    return df.agg(F.count("*")).scalar()


def ordered_split(df: DataFrame, key: str, test_size: float) -> tuple[DataFrame, DataFrame]:
    """Unshuffled split: the last ``ceil(test_size * n)`` rows by key are the test set."""
    n = _rows(df)
    tagged = df.withColumn("_train", first_in_order(df, n - F.ceil(F.lit(test_size) * n), key))
    return tagged.filter("_train").drop("_train"), tagged.filter("NOT _train").drop("_train")


def tail_split(df: DataFrame, key: str, eval_rows: int) -> tuple[DataFrame, DataFrame]:
    """The last ``eval_rows`` rows by key are the evaluation set."""
    tagged = df.withColumn("_train", first_in_order(df, _rows(df) - eval_rows, key))
    return tagged.filter("_train").drop("_train"), tagged.filter("NOT _train").drop("_train")


def percent_slice(df: DataFrame, key: str, start: float, stop: float) -> DataFrame:
    """Rows from ``start`` to ``stop`` per cent by key, rounded to whole rows."""
    n = _rows(df)
    lo, hi = (F.floor(F.lit(float(p)) * n / 100 + 0.5) for p in (start, stop))
    return df.filter(first_in_order(df, hi, key) & ~first_in_order(df, lo, key))
