"""Tables written once per version of their input."""

from pyspark.sql import functions as F

from tunetable.sources import stored as S


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_built_once_and_found_again(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(100).select((F.col("id") % 7).alias("k"), "id").write.parquet(path)
    calls = lambda: S.stored(spark.read.parquet(path).withColumn("v", F.col("id") * 2), ["k"], ["k", "id"])
    known = lambda: len(S._KNOWN[spark.sparkContext.applicationId])
    first = calls()
    before = known()
    again = calls()
    assert known() == before and sorted(again.collect()) == sorted(first.collect())
    other = S.stored(spark.read.parquet(path).withColumn("v", F.col("id") * 3), ["k"], ["k", "id"])
    assert known() == before + 1 and other.agg(F.sum("v")).first()[0] == 3 * sum(range(100))
    spark.range(100, 110).select((F.col("id") % 7).alias("k"), "id").write.mode("append").parquet(path)
    assert calls().count() == 110 and known() == before + 2


def test_readers_do_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(1000).select((F.col("id") % 50).alias("k"), "id").write.parquet(path)
    table = S.stored(spark.read.parquet(path), ["k"], ["k", "id"])
    sums = table.groupBy("k", "id").agg(F.count("*").alias("n")).groupBy("k").agg(F.sum("n").alias("n"))
    assert "Exchange" not in plan_of(sums) and sums.agg(F.sum("n")).first()[0] == 1000
    other = table.groupBy("k").agg(F.max("id").alias("m")).hint("merge")
    assert "Exchange" not in plan_of(table.join(other, "k"))


def test_empty_input(spark):
    df = S.stored(spark.createDataFrame([], "k int, v int"), ["k"], ["k"])
    assert df.columns == ["k", "v"] and df.count() == 0
