"""Scans, mixtures, logs, sinks and user functions."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tunetable import udf
from tunetable.operators import density
from tunetable.session import scratch_path, scratch_root
from tunetable.sources import scan, sinks


def test_scan_prunes_columns(spark):
    df = scan.table(spark, SF, "documents", "doc_id")
    assert "ReadSchema: struct<doc_id:bigint>" in df._jdf.queryExecution().toString()


def test_mixture(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k int, t string").write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([("b", 2)], "t string, k int").write.json(str(tmp_path / "y"))
    specs = [scan.DatasetSpec(str(tmp_path / "x"), "x", columns=("k", "t")), scan.DatasetSpec(str(tmp_path / "y"), "y", "json", ("t", "k"))]
    rows = {(r.k, r.t, r.source_name) for r in scan.mixture(spark, specs).collect()}
    assert rows == {(1, "a", "x"), (2, "b", "y")}
    with pytest.raises(ValueError):
        scan.mixture(spark, [])


def test_log_report(spark, tmp_path):
    for name, lines in {"a": ['{"outcome":"passed"}', "oops", ""], "b": ['{"outcome":"failed"}', '{"outcome":"passed"}']}.items():
        (tmp_path / f"{name}.log").write_text("\n".join(lines))
    records = scan.scan_log(spark, str(tmp_path), "outcome STRING")
    out = scan.log_report(records, "file", F.col("outcome") == "failed", F.col("outcome") == "passed")
    got = {r.file[-5]: (r.passed, r.failed, r.bad_lines, r.total) for r in out.collect()}
    assert got == {"a": (1, 0, 1, 2), "b": (1, 1, 0, 2)}


def test_completion_sink_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for step in (1, 2):
        df = spark.createDataFrame([(step, "p", "c", 1.0, 0.5)], "step int, prompt string, completion string, r double, advantage double")
        sinks.append_completions(df, path, ["r"])
    assert sorted(r.step for r in spark.read.parquet(path).collect()) == [1, 2]


def test_scratch_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(scratch_root(spark).rstrip("/"))
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or scratch_root(spark) == named


def test_registry(spark):
    registry = udf.RewardRegistry()
    registry.add_column("n", lambda c: F.length(c).cast("double"), "text")
    registry.add_batch("even", lambda xs: [None if len(x) % 2 else 1.0 for x in xs], "text")
    rows = registry.score(spark.createDataFrame([("ab",), ("abc",)], "text string")).orderBy("text").collect()
    assert [(r.n, r.even) for r in rows] == [(2.0, 1.0), (3.0, None)]
    with pytest.raises(ValueError):
        registry.score(spark.range(1), "nope")


def test_group_scores_see_whole_groups(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("g"), "id", F.lit("t").alias("c"), F.col("id").cast("double").alias("r"))
    rows = udf.group_scores(df, ["g"], "id", "c", "r", lambda t, r: [sum(r)] * len(t)).collect()
    assert {(r.id, r.filter_score) for r in rows} == {(i, 20.0 + 5 * (i % 2)) for i in range(10)}


def test_density_classifier_separates(spark):
    df = spark.range(200).select("id", (F.col("id") % 2 == 0).alias("good"))
    df = df.withColumn("e", F.array((F.col("id") % 2).cast("float"), (F.col("id") % 7).cast("float")))
    model = density.fit_density(density.sample_per_class(df, "good", F.xxhash64("id"), 50), "good", "e")
    rows = density.class_accuracy(density.density_probability(df, model, "e", "p"), "good", "p").collect()
    assert all(r.accuracy == 1.0 for r in rows)


def test_no_stray_names():
    import __spark_entry__ as entry
    from tunetable import plans

    assert all(n.replace("_", "").isalnum() and not n.startswith("op") for n in plans.QUERIES)
    json.dumps(entry.oracle_sql())


def test_inputs_are_spread_by_the_setting_alone(spark):
    df = spark.range(10)
    before = spark.conf.get("tunetable.input.partitions")
    try:
        spark.conf.set("tunetable.input.partitions", "3")
        assert scan.spread(df, "id").rdd.getNumPartitions() == 3
        spark.conf.unset("tunetable.input.partitions")
        assert scan.spread(df, "id") is df
    finally:
        spark.conf.set("tunetable.input.partitions", before)


def test_a_repeated_step_is_logged_once(spark, tmp_path):
    from tunetable.sources.sinks import append_completions

    path = str(tmp_path / "log")
    rows = lambda steps, tag: spark.createDataFrame([(k, f"p{i}", tag, 0.5) for k in steps for i in range(3)], "step int, prompt string, completion string, advantage double")
    for steps, tag in (([1, 2], "first"), ([3], "first"), ([2, 3], "again"), ([2, 3], "again")):
        append_completions(rows(steps, tag), path)
    got = sorted((r.step, r.completion) for r in spark.read.parquet(path).collect())
    assert got == [(1, "first")] * 3 + [(2, "again")] * 3 + [(3, "again")] * 3
