"""Joins by key and alignment of two tokenisations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.functions.distributions import cut_gap, matched_divergence, merged, sorted_gap, unmatched_gap
from tunetable.functions.objectives import divergence_term, running_sum
from tunetable.functions.render import common_prefix_length
from tunetable.operators.ordering import rank_within
from tunetable.operators.skew import join_unique, with_group_stats


def attach(df: DataFrame, other: DataFrame, keys: Sequence[str], complete: bool = True) -> DataFrame:
    """Columns of ``other`` beside those of ``df``, by key.

    With ``complete`` a row without a partner is an error rather than a lost row.
    """
    if not complete:
        return df.join(other, list(keys))
    out = df.join(other.withColumn("_there", F.lit(True)), list(keys), "left")
    found = F.when(F.col("_there"), True).otherwise(F.raise_error(F.lit("no matching row for a key")).cast("boolean"))
    return out.filter(found).drop("_there")


def pair_models(first: DataFrame, second: DataFrame, key: str, text: str, names: tuple[str, str]) -> DataFrame:
    """Completions of two models side by side."""
    side = lambda df, n: df.select(key, F.col(text).alias(n))
    return side(first, names[0]).join(side(second, names[1]), key)


def map_vocabularies(student: DataFrame, teacher: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(matched, student only, teacher only)`` of two ``(token, id)`` tables."""
    s = student.select("token", F.col("id").alias("student_id"))
    t = teacher.select("token", F.col("id").alias("teacher_id"))
    return s.join(t, "token"), s.join(t, "token", "left_anti"), t.join(s, "token", "left_anti")


def first_teacher_ids(matched: DataFrame) -> DataFrame:
    """The lowest teacher id per student id."""
    return matched.groupBy("student_id").agg(F.min("teacher_id").alias("teacher_id"))


def alignment_groups(student: DataFrame, teacher: DataFrame, seq: str) -> DataFrame:
    """Group number of every position on both sides: ``(seq, side, pos, group)``.

    Inputs are ``(seq, pos, piece)``. A boundary is a text length where pieces of both
    sides end and the texts so far are equal; what follows the last boundary is one group.
    A sequence becomes one row, so one shuffle brings both sides together.
    """
    part = lambda df, side: df.select(seq, F.lit(side).alias("side"), F.struct("pos", "piece").alias("p"))
    of = lambda side: F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("p")))).alias(side)
    rows = part(student, "student").unionByName(part(teacher, "teacher")).groupBy(seq).agg(of("student"), of("teacher"))
    text = lambda side: F.array_join(F.transform(side, lambda x: x.piece), "")
    rows = rows.withColumns({"_s": _ends("student"), "_t": _ends("teacher"), "_same": common_prefix_length(text("student"), text("teacher"))})
    shared = F.filter(F.array_intersect("_s", "_t"), lambda e: (e > 0) & (e <= F.col("_same")))
    rows = rows.withColumn("_shared", shared)

    def placed(side: str, ends: str) -> Column:
        group = lambda i: _count_below(F.col("_shared"), F.get(ends, i)).alias("group")
        return F.transform(side, lambda x, i: F.struct(F.lit(side).alias("side"), x.pos.alias("pos"), group(i)))

    return rows.select(seq, F.inline(F.concat(placed("student", "_s"), placed("teacher", "_t"))))


def _ends(side: str) -> Column:
    """Text length up to and including each piece."""
    widths = F.transform(side, lambda x: F.length(x.piece).cast("double"))
    return F.transform(running_sum(widths), lambda e: e.cast("long"))


def _count_below(ascending: Column, bound: Column) -> Column:
    """How many entries are below the bound, found by halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(ascending) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(ascending).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s.low + s.high) / 2).cast("int")
        below = (s.low < s.high) & (F.get(ascending, mid) < bound)
        return F.struct(F.when(below, mid + 1).otherwise(s.low).alias("low"), F.when(below, s.high).otherwise(F.greatest(s.low, F.least(mid, s.high))).alias("high"))

    return F.aggregate(steps, start, halve, lambda s: s.low.cast("long"))


def merge_group_logps(logps: DataFrame, groups: DataFrame, seq: str, value: str) -> DataFrame:
    """Sum of the log-probs in each alignment group."""
    return logps.join(groups, [seq, "pos"]).groupBy(seq, "group").agg(F.sum(value).alias(value))


def merge_group_distributions(dists: DataFrame, groups: DataFrame, seq: str, p: str) -> DataFrame:
    """Distributions multiplied within a group and made to sum to one again.

    Long form ``(seq, pos, token, p)``; every position of a group lists the same tokens.
    """
    eps = 1e-8
    merged = (
        dists.join(groups, [seq, "pos"])
        .groupBy(seq, "group", "token")
        .agg(F.sum(F.log(F.greatest(p, F.lit(eps)))).alias("_l"), F.count("*").alias("_n"), F.max(p).alias("_one"))
    )
    weight = F.when(F.col("_n") > 1, F.exp("_l")).otherwise(F.col("_one"))
    merged = merged.withColumn("_w", weight)
    scaled = F.when(F.col("_m") > 1, F.col("_w") / F.col("_z")).otherwise(F.col("_w"))
    whole = with_group_stats(merged, [seq, "group"], {"_z": F.sum("_w"), "_m": F.max("_n")})
    return whole.select(seq, "group", "token", scaled.alias(p))


def sorted_l1(student: DataFrame, teacher: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """L1 distance per key between two distributions sorted descending, the shorter filled with 0."""
    return _sorted_sides(student, teacher, keys, value).select(*keys, sorted_gap(F.col("_a"), F.col("_b")).alias("l1"))


def _sorted_sides(student: DataFrame, teacher: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key: the probabilities of both sides. A NULL key is a key like any other."""
    none = F.lit(None).cast("double")
    sides = student.select(*keys, F.col(value).alias("_a"), none.alias("_b"), F.lit(True).alias("_s")).unionByName(
        teacher.select(*keys, none.alias("_a"), F.col(value).alias("_b"), F.lit(False).alias("_s"))
    )
    return sides.groupBy(*keys).agg(*[F.collect_list(c).alias(c) for c in ("_a", "_b")], F.bool_or("_s").alias("_s"))


def rank_aligned_loss(student: DataFrame, teacher: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Total sorted L1 over the number of positions."""
    rows = _sorted_sides(student, teacher, keys, value)
    return rows.agg((F.sum(sorted_gap(F.col("_a"), F.col("_b"))) / F.nullif(F.count_if("_s"), F.lit(0))).alias("loss"))


def rank_aligned_loss_of_pairs(both: DataFrame, keys: Sequence[str], p: str, q: str) -> DataFrame:
    """The same from one table of both sides, where a token that one side lacks has 0 there."""
    listed = [F.collect_list(F.when(F.col(c) > 0, F.col(c))).alias(n) for c, n in ((p, "_a"), (q, "_b"))]
    rows = both.groupBy(*keys).agg(*listed)
    positions = F.count_if(F.size("_a") > 0)
    return rows.agg((F.sum(sorted_gap(F.col("_a"), F.col("_b"))) / F.nullif(positions, F.lit(0))).alias("loss"))


def divergence_by_position(dists: DataFrame, keys: Sequence[str], student: str, teacher: str, beta: float) -> DataFrame:
    """Generalised Jensen-Shannon divergence per position of ``(keys, token, p, q)``."""
    term = divergence_term(F.coalesce(student, F.lit(0.0)), F.coalesce(teacher, F.lit(0.0)), beta)
    return dists.groupBy(*keys).agg(F.sum(term).alias("divergence"))


def divergence_of_pairs(both: DataFrame, again: DataFrame, key: str, row: str, beta: float) -> DataFrame:
    """The same from ``(key, row, token, p, q)``, where a token that one side lacks has 0 there and ``row`` numbers the positions.

    A key with one position is summed as it is, without a join of the sides. ``again`` is the same of all keys that are NULL or have
    several positions, and may hold others; its sides are joined by key and token, which pairs all of a key's and none of a NULL key.
    """
    single = F.min("_low") == F.max("_high")
    total = lambda p, q: F.sum(divergence_term(p, q, beta)).alias("divergence")
    rows = both.withColumns({"_low": F.col(row), "_high": F.col(row)}).groupBy(key).agg(total(F.col("p"), F.col("q")), single.alias("_one"))
    side = lambda c, place: again.filter(F.col(c) > 0).select(key, "token", c, F.col(row).alias(place))
    pairs = side("p", "_s").join(side("q", "_t"), [key, "token"], "full_outer").withColumns({"_low": F.least("_s", "_t"), "_high": F.greatest("_s", "_t")})
    joined = pairs.groupBy(key).agg(total(F.coalesce("p", F.lit(0.0)), F.coalesce("q", F.lit(0.0))), single.alias("_one"))
    whole = F.col("_one") & F.col(key).isNotNull()
    return rows.filter(whole).unionByName(joined.filter(~whole)).drop("_one")


def hybrid_loss(
    student: DataFrame,
    teacher: DataFrame,
    vocabulary: DataFrame,
    keys: Sequence[str],
    beta: float = 0.5,
    weights: tuple[float, float] | None = None,
    teacher_tokens: Column | None = None,
    matched_tokens: Column | None = None,
    dense: bool = False,
) -> DataFrame:
    """Divergence on shared tokens plus sorted L1 on the others.

    ``student`` and ``teacher`` are ``(keys, token, p)`` with only tokens of positive
    probability on the teacher side, so a position compares only the teacher's ``k``
    tokens with the student's best ``k``. ``vocabulary`` is ``(token, n, shared)`` over
    the tokens of both, ``n`` saying how frequent a token is. Without ``weights`` the
    matched share of the teacher's vocabulary decides.

    With ``dense`` the teacher lists all tokens of its vocabulary at every position: nothing is cut to
    the teacher's ``k``, the shorter side is filled with 0, and sums are divided by the number of positions.
    """
    keys = list(keys)
    none, of = F.lit(0.0), F.col("p").cast("double")
    sides = student.select(*keys, "token", of.alias("p"), none.alias("q"), F.lit(True).alias("_s")).unionByName(
        teacher.select(*keys, "token", none.alias("p"), of.alias("q"), F.lit(False).alias("_s"))
    )
    return _hybrid(sides, vocabulary, keys, beta, weights, teacher_tokens, matched_tokens, dense)


def hybrid_loss_of_pairs(
    both: DataFrame,
    vocabulary: DataFrame,
    keys: Sequence[str],
    beta: float = 0.5,
    weights: tuple[float, float] | None = None,
    teacher_tokens: Column | None = None,
    matched_tokens: Column | None = None,
    vocabulary_total: Column | None = None,
    again: DataFrame | None = None,
    row: str | None = None,
) -> DataFrame:
    """The same from ``(keys, token, p, q)``, where a token that one side lacks has 0 there.

    With ``row``, a column that numbers the positions, a key with one position has nothing to merge: its tokens go without their
    names, and only those of one side are listed. ``again`` is then the same of all keys that have several, and may hold others.
    """
    sided = both.withColumn("_s", F.col("p") > 0)
    if row is None:
        return _hybrid(sided, vocabulary, list(keys), beta, weights, teacher_tokens, matched_tokens, False, vocabulary_total)
    single = (F.min(row) == F.max(row)).alias("_one")
    rest = _merged_terms(_flagged(again.withColumn("_s", F.col("p") > 0), vocabulary, vocabulary_total), keys, beta, False, single).filter(~F.col("_one"))
    p, q, eps = F.col("p"), F.col("q"), F.lit(1e-8)
    own = lambda c: F.collect_list(F.when(~F.col("shared") & (c > 0), c))
    term = F.when(F.col("shared") & (q > 0), divergence_term(F.greatest(p, eps), F.greatest(q, eps), beta))
    sums = _flagged(sided, vocabulary, vocabulary_total).groupBy(*keys).agg(
        F.bool_or("_s").alias("_s"), F.sum(term).alias("m"), own(p).alias("_a"), own(q).alias("_b"), single
    )
    terms = sums.filter("_one").select("_s", "m", cut_gap(F.col("_a"), F.col("_b")).alias("u"))
    return _mean_terms(terms.unionByName(rest.drop("_one")), False, weights, teacher_tokens, matched_tokens)


def _flagged(rows: DataFrame, vocabulary: DataFrame, total: Column | None) -> DataFrame:
    return join_unique(rows, vocabulary, ["token"], "n", ["shared"], total=total).fillna(False, ["shared"])


def _merged_terms(flagged: DataFrame, keys: Sequence[str], beta: float, dense: bool, *more: Column) -> DataFrame:
    """A position becomes one row, in which its tokens are merged, compared and ranked."""
    entries = F.collect_list(F.struct("token", "p", "q", "shared"))
    rows = flagged.groupBy(*keys).agg(entries.alias("_e"), F.bool_or("_s").alias("_s"), *more).withColumn("_e", merged(F.col("_e")))
    kept = [c for c in rows.columns if c not in (*keys, "_e")]
    return rows.select(*kept, matched_divergence(F.col("_e"), beta).alias("m"), unmatched_gap(F.col("_e"), not dense).alias("u"))


def _hybrid(sides, vocabulary, keys, beta, weights, teacher_tokens, matched_tokens, dense, vocabulary_total=None) -> DataFrame:
    terms = _merged_terms(_flagged(sides, vocabulary, vocabulary_total), keys, beta, dense)
    return _mean_terms(terms, dense, weights, teacher_tokens, matched_tokens)


def _mean_terms(terms: DataFrame, dense: bool, weights, teacher_tokens, matched_tokens) -> DataFrame:
    # A dense sum is over all positions; otherwise a position without the term does not count.
    mean = lambda c: F.try_divide(F.sum(c), F.count_if("_s")) if dense else F.avg(c)
    out = terms.agg(*[F.coalesce(mean(c), F.lit(0.0)).alias(n) for c, n in (("m", "matched_loss"), ("u", "unmatched_loss"))])
    return _weighted(out, weights, teacher_tokens, matched_tokens)


def hybrid_loss_of_rows(df: DataFrame, entries: Column, beta: float, weights: tuple[float, float]) -> DataFrame:
    """The dense comparison where a row already holds a position's ``p, q, shared`` entries: no shuffle of rows."""
    terms = df.select(entries.alias("_e")).select(matched_divergence(F.col("_e"), beta).alias("m"), unmatched_gap(F.col("_e"), False).alias("u"))
    mean = lambda c: F.coalesce(F.try_divide(F.sum(c), F.count("*")), F.lit(0.0))
    return _weighted(terms.agg(mean("m").alias("matched_loss"), mean("u").alias("unmatched_loss")), weights, None, None)


def _weighted(out: DataFrame, weights: tuple[float, float] | None, teacher_tokens: Column | None, matched_tokens: Column | None) -> DataFrame:
    share = F.lit(float(weights[0])) if weights else matched_tokens / F.greatest(teacher_tokens, F.lit(1))
    rest = F.lit(float(weights[1])) if weights else 1 - share
    return out.withColumn("loss", share * F.col("matched_loss") + rest * F.col("unmatched_loss"))


def fill_tail(dists: DataFrame, keys: Sequence[str], order: str, vocab_size: int | Column) -> DataFrame:
    """Log-prob of each absent id in a partial distribution, stored once per position.

    Ids out of range are dropped, and of a repeated id the first is kept. ``tail_logp``
    is NULL where no mass or no id is left.
    """
    ranged = dists.filter((F.col("token_id") >= 0) & (F.col("token_id") < vocab_size))
    kept = ranged.groupBy(*keys, "token_id").agg(F.min_by("logp", order).alias("logp"))
    mass = F.least(F.sum(F.exp("logp")), F.lit(1.0))
    tails = kept.groupBy(*keys).agg(mass.alias("mass"), F.count("*").alias("n_ids"))
    size = F.lit(vocab_size) if isinstance(vocab_size, int) else vocab_size
    left = (1 - F.col("mass")) / F.nullif(size - F.col("n_ids"), F.lit(0))
    return tails.withColumn("tail_logp", F.when(left > 0, F.log(left)))


def rank_pairs(df: DataFrame, batch: str, first: Column, second: Column, order: str) -> DataFrame:
    """Two columns sorted independently within a batch and paired by rank."""
    side = lambda c, out: rank_within(df.select(batch, order, c.alias(out)), [batch], [out, order], "_rank").drop(order)
    other = side(second, "second").withColumnsRenamed({batch: "_batch", "_rank": "_same"})
    paired = side(first, "first").join(other, F.col(batch).eqNullSafe(F.col("_batch")) & (F.col("_rank") == F.col("_same")))
    return paired.drop("_batch", "_same").withColumnRenamed("_rank", "rank")
