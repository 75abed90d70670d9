"""Distributions held in one row against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunetable.functions import distributions as D


def test_half_shares(spark):
    rng = random.Random(3)
    texts = [[rng.choice("abcdeéz") * rng.choice([1, 2]) for _ in range(n)] for n in (1, 2, 3, 7, 40, 41, 500)]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(texts)], "i int, w array<string>")
    for r in rows.select("i", D.half_shares(F.col("w")).alias("h")).collect():
        w = texts[r.i]
        cut = (len(w) + 1) // 2
        a, b = Counter(w[:cut]), Counter(w[cut:])
        assert [(x.token, x.p, x.q) for x in r.h] == [(t, a[t] / cut, b[t] / (len(w) - cut) if len(w) > cut else 0.0) for t in sorted(a | b)]


def test_half_shares_of_a_long_row_stay_linear(spark):
    """A filter on the generated rows must not move the count of words into a lambda."""
    rows = spark.createDataFrame([(" ".join(str(i % 5000) for i in range(60_000)),)], "t string")
    words = F.split("t", " ")
    out = rows.select(D.half_shares(words).alias("h")).select(F.inline_outer("h")).filter("p > 0 AND q > 0")
    assert out.count() == 5000


ENTRY = "array<struct<token:string,p:double,q:double,shared:boolean>>"


def test_merged_terms(spark):
    entries = [("b", 0.5, 0.0, True), ("a", 0.2, 0.0, False), ("b", 0.0, 0.4, True), ("c", 0.0, 0.6, False), ("d", 0.3, 0.0, False)]
    df = spark.createDataFrame([(entries,), ([],), ([("x", 0.1, 0.0, False)],)], f"e {ENTRY}").coalesce(1).withColumn("e", D.merged(F.col("e")))
    got = df.select("e", D.matched_divergence(F.col("e"), 0.5).alias("m"), D.unmatched_gap(F.col("e"), True).alias("cut"), D.unmatched_gap(F.col("e"), False).alias("all")).collect()
    assert [tuple(x) for x in got[0].e] == [("a", 0.2, 0.0, False), ("b", 0.5, 0.4, True), ("c", 0.0, 0.6, False), ("d", 0.3, 0.0, False)]
    import math

    assert got[0].m == pytest.approx(0.25 * math.log(0.5 / 0.45) + 0.2 * math.log(0.4 / 0.45))
    assert got[0].cut == pytest.approx(0.3) and got[0].all == pytest.approx(0.5)
    assert (got[1].m, got[1].cut, got[1].all) == (None, None, 0.0)
    assert (got[2].m, got[2].cut, got[2].all) == (None, None, 0.1)
