"""Prepared datasets and the completion log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def save_prepared(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_prepared(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_completions(df: DataFrame, path: str, rewards: Sequence[str] = ()) -> None:
    """Log completions, one folder per step.

    The rows of a step replace what the log holds of that step, so a step or job that is repeated leaves
    one copy; other steps stay. Call it with all rows of a step at once.
    """
    cols = ["step", "prompt", "completion", *rewards, "advantage"]
    writer = df.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("step").parquet(path)
