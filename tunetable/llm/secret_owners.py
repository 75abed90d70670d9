"""Secret scans judged by corpus-wide ownership. DataFrame functions only.

Candidates are found by pattern in every whole text, and their values hashed. Over the
whole corpus each hash's distinct repositories and owners are counted: a value that several owners
hold is a copied example, and so is one that a single owner carries through most of many repositories;
one that belongs to one owner and few of its repositories looks live. Patterned kinds are
always reported; a free-form high-entropy token (kind ``token``) is reported only if it looks live
and does not touch a patterned span.

Scale: the texts are scanned once; what is stored and shuffled are offsets and hashes of candidates, never
texts or values. Ownership is counted in steps that are combined before each shuffle, so
a value that a third of the corpus copies is a few rows, and the hits of such a value are served
from a broadcast of the heaviest values (fewer than 10,000) and so stay spread. Offsets and overlaps come
from running values over a text's own hits, so a long text costs n log n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetable.llm.text import whole
from tunetable.operators.skew import join_unique
from tunetable.session import settle

# Kinds in the order in which spans of the same start are listed: pattern, group of the value, its least length.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("token", r"[A-Za-z0-9+/_-]{24,}", 0, 24),
)
FREE_FORM = "token"
# A value held by more owners than this is an example.
LIVE_OWNERS = 1
# So is one in more than one repository and in more than this share of its owner's repositories.
LIVE_SHARE = 0.5

SPAN = ("kind", "start", "end", "value", "owners", "repositories", "live")
_HIT = "array<struct<kind:int,i:int,gap:int,size:int,good:boolean,value:bigint>>"


def _mixed(value: Column) -> Column:
    """Free-form tokens must mix digits with both cases."""
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def _hits(text: Column, at: int) -> Column:
    """Leftmost non-overlapping matches of a kind, each with the length of the gap before it."""
    kind, pattern, group, least = KINDS[at]
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )

    def hit(x: Column, i: Column) -> Column:
        good = F.length(x["value"]) >= least
        if kind == FREE_FORM:
            good = good & _mixed(x["value"])
        return F.struct(
            F.lit(at).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("size"), good.alias("good"), F.xxhash64(x["value"]).alias("value")
        )

    whole_hits = F.transform(F.filter(found, lambda x: x["hit"].isNotNull()), hit)
    return F.when(text.rlike(pattern), whole_hits).otherwise(F.array().cast(_HIT)).cast(_HIT)


def scan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: Sequence[str] = ("source", "lang"),
    live_owners: int = LIVE_OWNERS,
    live_share: float = LIVE_SHARE,
) -> DataFrame:
    """``<key>, spans`` for every row; ``spans`` lists ``kind, start, end, value, owners, repositories, live`` by
    start, then kind (code points, end exclusive; ``value`` is a hash).

    NULL and empty texts have no spans. NULL owners and repositories count as one each, apart from empty ones. Repeated
    rows are repeated in the result and count once. An empty table gives an empty result.
    """
    body = whole(F.col(text))
    rows = df.select(
        F.col(key).alias("key"),
        F.col(owner).cast("string").alias("owner"),
        # NULL has a hash of its own.
        F.xxhash64(*[F.concat(F.lit("="), F.col(c).cast("string")) for c in repository], *[F.col(c).isNull() for c in repository]).alias("repository"),
        F.concat(*[_hits(body, k) for k in range(len(KINDS))]).alias("hits"),
    )
    # Stored, so that texts are scanned once and a row's number stays what it is.
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()))
    hits = rows.select("row", "owner", "repository", F.inline("hits"))
    earlier = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("size")).over(earlier)
    placed = hits.withColumn("end", end).filter("good").withColumn("start", F.col("end") - F.col("size"))

    # ``rows`` counts the hits of a value, so that those of a widely copied one can be spread.
    held = hits.filter("good").groupBy("value", "owner", "repository").agg(F.count("*").alias("rows"))
    owned = held.groupBy("value", "owner").agg(F.count("*").alias("repositories"), F.sum("rows").alias("rows"))
    counted = owned.groupBy("value").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("rows").alias("rows"), F.min("owner").alias("owner")
    )
    # The repositories of each owner, with or without candidates. Values of a hot owner are spread.
    holdings = rows.groupBy("owner", "repository").agg(F.count("*").alias("documents")).groupBy("owner")
    holdings = settle(holdings.agg(F.count("*").alias("held"), F.sum("documents").alias("documents")))
    counted = join_unique(settle(counted), holdings, ["owner"], "documents", ["held"])
    few = (F.col("repositories") <= 1) | (F.col("repositories") <= F.col("held") * F.lit(live_share))
    counted = settle(counted.withColumn("live", (F.col("owners") <= live_owners) & few))
    judged = join_unique(placed.select("row", "kind", "start", "end", "value"), counted, ["value"], "rows", ["owners", "repositories", "live"])

    # A free-form token touches a patterned span if one that starts no later reaches it, or the next one starts inside it.
    patterned = F.col("kind") < len(KINDS) - 1
    up = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reach, following = F.max(F.when(patterned, F.col("end"))).over(up), F.min(F.when(patterned, F.col("start"))).over(down)
    touches = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False))
    kept = judged.withColumn("touches", touches).filter(patterned | (F.col("live") & ~F.col("touches")))

    name = F.get(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("kind"))
    span = F.struct("start", F.col("kind").alias("place"), name.alias("kind"), "end", "value", "owners", "repositories", "live")
    found = kept.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("found"))
    out = rows.select("key", "row").join(found, "row", "left")
    spans = F.transform(F.coalesce("found", F.array().cast(found.schema["found"].dataType)), lambda x: F.struct(*[x[c].alias(c) for c in SPAN]))
    return out.select(F.col("key").alias(key), spans.alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(*kinds))
