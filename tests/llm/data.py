"""Small awkward tables: NULLs, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

from pyspark.sql import types as T

ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def prose(rng, n, vocabulary=400):
    return " ".join(ALPHABET[rng.randrange(26)] + ALPHABET[rng.randrange(26)] + str(rng.randrange(vocabulary // 26 + 1)).replace("0", "o") for _ in range(n))


def documents(spark, rows, extra=True):
    """``(doc_id, text, source)`` rows as a table that also has columns named like results and helpers."""
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
    more = [("kept", T.StringType()), ("size", T.StringType()), ("shard", T.StringType()), ("row", T.StringType()), ("fingerprint", T.StringType())] if extra else []
    schema = T.StructType([T.StructField(n, t) for n, t in fields + more])
    data = [(i, t, None if s is None else "en", s, None if t is None else len(t)) + tuple("x" for _ in more) for i, t, s in rows]
    return spark.createDataFrame(data, schema)


def awkward(seed=1, n=60):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(1, 120)), f"s{i % 4}") for i in range(n)]
    rows += [(100, None, "s0"), (101, "", None), (102, " \n\t ", "s1"), (None, prose(rng, 40), None), (103, prose(rng, 9000), "s2")]
    rows += [rows[3], rows[3], (104, rows[5][1], "s3"), (105, rows[5][1], "s3"), (106, "é ß 漢字 🙂 " * 9, "ü")]
    return rows
