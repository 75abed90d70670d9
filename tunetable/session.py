"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
INPUT_PARTITIONS = "tunetable.input.partitions"


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "tunetable") -> SparkSession:
    """A session for tests and benchmarks. Clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    # The test tables are single files, which would be one task each.
    spark.conf.set(INPUT_PARTITIONS, str(partitions))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, else a fresh one in local mode."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root
    root = spark.conf.get("tunetable.scratch", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tunetable-")
    spark.conf.set("tunetable.scratch", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the shared folder and read them from there.

    For rows that are read several times, and wherever a later step depends on which
    partition a row fell into: a recomputed range shuffle may cut elsewhere.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
