"""Line dedup: lines that many documents hold are dropped from all of them.

A line's key is the line without blanks at both ends and with A-Z lower-cased. Keys are exploded and
hashed to 128 bits, the documents of every hash are counted, and the lines of the hashes
above the limit go; the others are joined again in their order.

Scale: three scans of the texts, of which two shuffle hashes only. The count is combined
before the shuffle, one row a key and task, so a line that every document holds costs no
more than any other. A document's lines meet the common keys as one row for each different key with the places
where it stands; hot keys are spread by their counts. The places go back to the texts by a hash
of the whole text, so copies of one text share one list, and a text with any number of copies is
spread too. Nothing is collected, and no table is assumed to be small.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.functions.binding import let
from tunetable.llm.text import BLANKS, whole
from tunetable.operators.skew import join_unique
from tunetable.session import settle

# Keys of at least so many code points, found in at least so many documents, are dropped.
LEAST_DOCS = 10
LEAST_CHARS = 1


def ascii_lower(value: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    plain = F.length(value) == F.octet_length(value)
    return F.when(plain, F.lower(value)).otherwise(F.translate(value, string.ascii_uppercase, string.ascii_lowercase))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(whole(text), "\n")


def _two_hashes(value: Column, names: tuple[str, str]) -> list[Column]:
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])]


def common_keys(texts: DataFrame, least_docs: int, least_chars: int) -> DataFrame:
    """``k1, k2, docs``: the hashed keys found in at least ``least_docs`` of the rows' ``text``."""
    keys = F.array_distinct(F.transform(_lines(F.col("text")), line_key))
    held = texts.select(F.explode(keys).alias("key")).filter(F.length("key") >= least_chars)
    return held.select(*_two_hashes(F.col("key"), ("k1", "k2"))).groupBy("k1", "k2").agg(F.count("*").alias("docs")).filter(F.col("docs") >= least_docs)


def _places(text: Column) -> Column:
    """One ``k1, k2, at`` for each different key of a text: where its lines stand, from 0."""
    hashed = F.transform(
        F.transform(_lines(text), line_key),
        lambda k, i: F.struct(F.xxhash64(k).alias("k1"), F.xxhash64(F.lit(1), k).alias("k2"), i.alias("i")),
    )
    other = lambda x, y: (x["k1"] != y["k1"]) | (x["k2"] != y["k2"])

    def runs(order: Column) -> Column:
        first = F.filter(
            F.transform(order, lambda x, j: F.when((j == 0) | F.coalesce(other(x, F.get(order, j - 1)), F.lit(True)), j)), lambda j: j.isNotNull()
        )

        def cut(starts: Column) -> Column:
            end = lambda r: F.coalesce(F.get(starts, r + 1), F.size(order))
            return F.transform(
                starts,
                lambda s, r: F.struct(
                    F.get(order, s)["k1"].alias("k1"),
                    F.get(order, s)["k2"].alias("k2"),
                    F.transform(F.slice(order, s + 1, end(r) - s), lambda x: x["i"]).alias("at"),
                ),
            )

        return let(first, cut)

    return let(F.array_sort(hashed), runs)


def without_common_lines(df: DataFrame, text: str = "text", least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per input row: ``row`` (the input as a struct), ``kept_text``, ``n_lines``, ``n_dropped``.

    Every input row is a document: a repeated row counts, and is cleaned, like any other. A
    NULL or empty text is one empty line, whose key is empty and never dropped (with
    ``least_chars`` of 1 or more), so it stays an empty text. A text that loses all lines
    becomes empty. An empty table gives an empty result. Columns of any name may
    stand beside the named one; a NULL in them changes nothing.
    """
    docs = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    # Stored, so that its size is known to the joins and the texts are not counted again.
    common = settle(common_keys(docs.select("text"), least_docs, least_chars))
    held = docs.select(*_two_hashes(whole(F.col("text")), ("t1", "t2")), F.inline(_places(F.col("text"))))
    hits = join_unique(held, common, ["k1", "k2"], "docs", ["docs"]).filter("docs IS NOT NULL")
    # Every copy of a text brings the same places, so the rows over the places are the copies.
    gone = settle(
        hits.select("t1", "t2", F.explode("at").alias("i"))
        .groupBy("t1", "t2")
        .agg(F.collect_set("i").alias("gone"), F.count("*").alias("rows"))
        .withColumn("copies", (F.col("rows") / F.size("gone")).cast("long"))
        .drop("rows")
    )
    keyed = docs.select("row", "text", *_two_hashes(whole(F.col("text")), ("t1", "t2")))
    marked = join_unique(keyed, gone, ["t1", "t2"], "copies", ["gone"])
    lines = _lines(F.col("text"))
    left = lambda x: F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("gone"))
    kept = let(lines, lambda x: F.array_join(F.transform(left(x), lambda i: F.get(x, i)), "\n"))
    return marked.select(
        "row",
        F.when(F.col("gone").isNull(), whole(F.col("text"))).otherwise(kept).alias("kept_text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
