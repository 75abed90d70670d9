"""Quality rules: per-text measures and cross-document line frequency. DataFrame functions only.

Lines are normalised (lower case, digits to 0, blanks to one space) and hashed. For each
host, a line's documents are counted; lines above the limit are removed, and a document
that loses too much of itself is rejected.

Copies of one document count once: a document is told apart by the set of all its
normalised lines. So a line that stands beside ever new text is boilerplate, whatever other
common lines stand there too, and one that always comes with the same text is part of a copied
document, which is the matter of near-duplicate detection, not of this rule.

Scale: two scans of the texts. Between them only hashes are shuffled, combined before the
shuffle: a host's different documents by their whole line sets, then its lines with their
counts, so neither a hot host, a hot line nor a much copied document meets in one
task. The lines above the limit come back as one row per host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.functions.binding import let
from tunetable.llm.text import BLANK_RUN, BLANKS, short_hash, whole, words
from tunetable.session import settle

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# A line is removed if more than this many documents of its host hold it ...
LINE_DOCS = 20
# ... and more than this share of the host's documents.
LINE_SHARE = 0.01
# A document that keeps less than this share of its words is depleted.
MIN_LEFT = 0.3


def normal_line(line: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), BLANK_RUN, " "), F.lit(BLANKS))


def line_hash(line: Column) -> Column:
    """Hash of the normalised line; NULL for a line without a word."""
    return let(normal_line(line), lambda n: F.when(n != "", short_hash(n)))


def _lines(text: Column) -> Column:
    return F.split(whole(text), "\n")


def _common_lines(docs: DataFrame, line_docs: int, line_share: float) -> DataFrame:
    """``host, common``: for each host the hashes of its lines above the limit."""
    hashes = F.array_sort(F.array_distinct(F.array_compact(F.transform(_lines(F.col("text")), line_hash))))
    # Different documents of a host. The whole set is the key, so no two of them fall together.
    different = docs.select("host", hashes.alias("hashes")).distinct()
    held = different.select("host", F.posexplode("hashes").alias("i", "line"))
    # Every document has one first line, so these add up to the host's number of different documents.
    leads = F.sum((F.col("i") == 0).cast("long")).alias("leads")
    counted = settle(held.groupBy("host", "line").agg(F.count("*").alias("docs"), leads))
    hosts = counted.groupBy("host").agg(F.sum("leads").alias("host_docs")).withColumnRenamed("host", "of")
    above = (
        counted.filter(F.col("docs") > line_docs)
        .join(hosts, F.col("host").eqNullSafe(F.col("of")))
        .filter(F.col("docs") > F.lit(line_share) * F.col("host_docs"))
    )
    # Stored, so that its size is known when Spark chooses how to join it with the texts. A host has
    # at most 1 / line_share times as many such lines as its documents have lines on average.
    return settle(above.groupBy("host").agg(F.collect_set("line").alias("common")))


def _repeated_words(keys: Column) -> Column:
    """Words covered by windows whose key occurs twice or more. O(n log n) in the text's length."""

    def covered(order: Column) -> Column:
        same = lambda x, i: F.coalesce(x["k"] == F.get(order, i)["k"], F.lit(False))
        at = F.array_sort(F.transform(F.filter(order, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))
        fresh = lambda a: F.transform(a, lambda p, j: F.coalesce(F.least(F.lit(WINDOW), p - F.get(a, j - 1)), F.lit(WINDOW)))
        return F.aggregate(let(at, fresh), F.lit(0).cast("long"), lambda s, x: s + x)

    order = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(let(order, covered))


def judge(
    df: DataFrame,
    text: str = "text",
    host: str = "source",
    line_docs: int = LINE_DOCS,
    line_share: float = LINE_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """One row per input row: ``row`` (the input as a struct) and the measures and verdicts.

    ``clean_text`` is the text without the lines above the limit (the text itself, NULL
    included, if it has none). A NULL text is empty and fails the base rules; a NULL host
    is a host like any other. Repeated rows get the same verdict and count once. An empty
    table gives an empty result. Columns of any name may stand beside the named two.
    """
    docs = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).alias("text"), F.col(host).cast("string").alias("host"))
    common = _common_lines(docs.select("host", "text"), line_docs, line_share).withColumnRenamed("host", "of")
    joined = docs.join(common, F.col("host").eqNullSafe(F.col("of")), "left").drop("of")

    body = whole(F.col("text"))
    measured = joined.withColumns(
        {
            "words": words(F.col("text")),
            "word_chars": F.length(F.regexp_replace(body, BLANK_RUN, "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": let(
                F.filter(_lines(body), lambda x: F.btrim(x, F.lit(BLANKS)) != ""), lambda x: F.size(x) - F.size(F.array_distinct(x))
            ).cast("long"),
        }
    )
    hashed = measured.select(
        *[c for c in measured.columns if c != "words"],
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    window = lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])
    keys = F.when(F.col("n_words") > WINDOW, F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW), window))
    keyed = hashed.withColumn("keys", F.coalesce(keys, F.array().cast("array<bigint>"))).drop("hashes")
    base = keyed.withColumn("n_repeat_words", _repeated_words(F.col("keys"))).drop("keys")
    base = base.withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    )

    # Lines are hashed again only for hosts that have common lines at all.
    lines = F.transform(_lines(body), lambda x: F.struct(x.alias("line"), line_hash(x).alias("hash")))
    base = base.withColumn("lines", F.when(F.col("common").isNotNull(), lines))
    gone = F.array_intersect(F.transform("lines", lambda x: x["hash"]), "common")
    base = base.withColumn("gone", gone).withColumn(
        "left_lines",
        F.when(
            F.size("gone") > 0,
            F.filter("lines", lambda x: ~F.coalesce(F.array_contains("gone", x["hash"]), F.lit(False))),
        ),
    )
    clean = F.when(F.col("left_lines").isNull(), F.col("text")).otherwise(F.array_join(F.transform("left_lines", lambda x: x["line"]), "\n"))
    done = base.withColumn("clean_text", clean).withColumns(
        {
            "n_common_lines": F.when(F.col("left_lines").isNull(), F.lit(0)).otherwise(F.size("lines") - F.size("left_lines")).cast("long"),
            "words_left": F.when(F.col("left_lines").isNull(), F.col("n_words")).otherwise(F.size(words(F.col("clean_text"))).cast("long")),
        }
    )
    kept = ~F.col("base_failed") & (F.col("words_left") >= F.lit(min_left) * F.col("n_words"))
    return done.withColumn("kept", kept).select(
        "row", "clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_common_lines", "words_left"
    )


def clean_documents(df: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The kept documents, with the columns of the input and without their common lines."""
    judged = judge(df, text, host, **limits)
    out = F.struct(*[(F.col("clean_text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in df.columns])
    # Not a filter: the optimizer would copy the verdict's whole expression below the projections.
    return judged.select(F.inline(F.when(F.col("kept"), F.array(out))))
