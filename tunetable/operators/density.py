"""Density-ratio classifier on prompt embeddings."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_per_class(df: DataFrame, label: str, draw: Column, n: int) -> DataFrame:
    """Up to ``n`` rows of each of the two classes, by a hash."""
    tagged = df.withColumn("_d", draw)
    side = lambda good: tagged.filter(F.col(label) if good else ~F.col(label)).orderBy("_d").limit(n)
    return side(True).unionByName(side(False)).drop("_d")


def fit_density(sample: DataFrame, label: str, embedding: str) -> LogisticRegressionModel:
    """Class-balanced logistic fit on a sample of bounded size."""
    counts = sample.agg(F.count_if(F.col(label)).alias("g"), F.count_if(~F.col(label)).alias("b")).first()
    total = counts.g + counts.b
    weight = F.when(F.col(label), total / (2.0 * max(counts.g, 1))).otherwise(total / (2.0 * max(counts.b, 1)))
    rows = sample.select(
        array_to_vector(F.col(embedding).cast("array<double>")).alias("features"),
        F.col(label).cast("double").alias("label"),
        weight.alias("w"),
    )
    return LogisticRegression(weightCol="w", regParam=1.0 / max(total, 1), maxIter=100).fit(rows)


def density_probability(df: DataFrame, model: LogisticRegressionModel, embedding: str, out: str) -> DataFrame:
    """Probability that a prompt comes from the good side."""
    features = df.withColumn("features", array_to_vector(F.col(embedding).cast("array<double>")))
    scored = model.transform(features).withColumn(out, vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def class_accuracy(scored: DataFrame, label: str, probability: str) -> DataFrame:
    right = (F.col(probability) > 0.5) == F.col(label)
    return scored.groupBy(label).agg(F.count("*").alias("n"), F.avg(right.cast("double")).alias("accuracy"))
