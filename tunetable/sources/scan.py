"""Scans, mixtures and tolerant log reading."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetable.session import INPUT_PARTITIONS


def scan(spark: SparkSession, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Read a table, keeping the named columns."""
    df = spark.read.format(fmt).options(**options).load(path)
    return df.select(*columns) if columns else df


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One of the given Parquet tables."""
    return scan(spark, f"{sf_dir}/{name}.parquet", columns=columns or None)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread the rows over as many partitions as the session's ``tunetable.input.partitions`` names.

    For tables of few files and work that is heavy per row. Unset, as on a cluster, the
    table's own splits stay and nothing is shuffled; the size of the table never decides.
    """
    parts = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(parts), *keys) if parts else df


@dataclass(frozen=True)
class DatasetSpec:
    """One member of a mixture."""

    path: str
    name: str
    fmt: str = "parquet"
    columns: Sequence[str | Column] = ()
    options: dict = field(default_factory=dict)

    def load(self, spark: SparkSession) -> DataFrame:
        df = scan(spark, self.path, self.fmt, **self.options)
        return df.select(*self.columns) if self.columns else df


def mixture(spark: SparkSession, specs: Sequence[DatasetSpec]) -> DataFrame:
    """Concatenate datasets by column name, marking each row with its source."""
    if not specs:
        raise ValueError("a mixture needs at least one dataset")
    parts = [s.load(spark).withColumn("source_name", F.lit(s.name)) for s in specs]
    return reduce(DataFrame.unionByName, parts)


def parse_log(lines: DataFrame, schema: str, line: str = "line", corrupt: str = "bad_line") -> DataFrame:
    """Parse JSON log lines; a line that does not parse is kept in ``corrupt``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = F.from_json(line, f"{schema}, {corrupt} STRING", options)
    kept = [c for c in lines.columns if c != line]
    return lines.select(*kept, parsed.alias("_r")).select(*kept, "_r.*")


def scan_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read JSON-lines logs with the file each line came from."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))
    return parse_log(lines.filter(F.trim("line") != ""), schema)


def log_report(records: DataFrame, key: str, failed: Column, passed: Column, corrupt: str = "bad_line") -> DataFrame:
    """Pass and fail counts per log."""
    bad = F.col(corrupt).isNotNull()
    tally = lambda cond: F.count_if(~bad & F.coalesce(cond, F.lit(False)))
    return records.groupBy(key).agg(
        tally(passed).alias("passed"), tally(failed).alias("failed"), F.count_if(bad).alias("bad_lines"),
        F.count("*").alias("total"),
    )
