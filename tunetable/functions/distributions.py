"""Distributions as arrays of one row: counts, merging by token, and comparisons by rank.

Work is linear in the arrays after one sort, so a long row costs in proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunetable.functions.binding import let
from tunetable.functions.objectives import array_sum, divergence_term


def _firsts(order: Column, same, make) -> Column:
    """``make(entry, place)`` for each entry that is not the ``same`` as the one before."""
    first = lambda x, j: (j == 0) | ~same(x, F.get(order, j - 1))
    return F.filter(F.transform(order, lambda x, j: F.when(first(x, j), make(x, j))), lambda x: x.isNotNull())


def half_shares(words: Column) -> Column:
    """``token, p, q`` by token: its share of the first half of the words, the longer one, and of the second.

    Everything that an element needs is bound inside, so the optimizer cannot move a costly expression into a lambda.
    """
    share = lambda n, size: F.coalesce(F.try_divide(n, size), F.lit(0.0))

    def shares(w: Column) -> Column:
        def scaled(size: Column) -> Column:
            entry = lambda x: F.struct(x["token"].alias("token"), share(x["a"], size["a"]).alias("p"), share(x["b"], size["b"]).alias("q"))
            return F.transform(_half_counts(w), entry)

        first = F.ceil(F.size(w) / 2).cast("double")
        return let(F.struct(first.alias("a"), (F.size(w) - first).alias("b")), scaled)

    return let(words, shares)


def _half_counts(words: Column) -> Column:
    """``token, a, b`` by token: how often it stands in the first half of the words and in the second."""
    token = lambda x, y: x["token"].eqNullSafe(y["token"])
    both = lambda x, y: token(x, y) & (x["late"] == y["late"])

    def marked(w: Column) -> Column:
        return F.sort_array(F.transform(w, lambda t, i: F.struct(t.alias("token"), (i * 2 >= F.size(w)).alias("late"))))

    def runs(order: Column) -> Column:
        def sized(starts: Column) -> Column:
            end = lambda r: F.coalesce(F.get(starts, r + 1), F.size(order))
            entry = lambda j: F.get(order, j)
            return F.transform(starts, lambda j, r: F.struct(entry(j)["token"].alias("token"), entry(j)["late"].alias("late"), (end(r) - j).alias("n")))

        return let(_firsts(order, both, lambda x, j: j), sized)

    def joined(run: Column) -> Column:
        after = lambda j: F.get(run, j + 1)
        late = lambda x, j: F.when(x["late"], x["n"]).when(after(j)["token"].eqNullSafe(x["token"]) & after(j).isNotNull(), after(j)["n"]).otherwise(0)
        return _firsts(run, token, lambda x, j: F.struct(x["token"].alias("token"), F.when(x["late"], 0).otherwise(x["n"]).alias("a"), late(x, j).alias("b")))

    return let(let(let(words, marked), runs), joined)


def merged(entries: Column) -> Column:
    """``token, p, q, shared`` entries with those of one token added up. A side lists a token once."""
    token = lambda x, y: x["token"].eqNullSafe(y["token"])

    def added(order: Column) -> Column:
        other = lambda x, j, c: F.when(F.get(order, j + 1).isNotNull() & token(x, F.get(order, j + 1)), F.get(order, j + 1)[c]).otherwise(0.0)
        total = lambda x, j, c: (x[c] + other(x, j, c)).alias(c)
        return _firsts(order, token, lambda x, j: F.struct(x["token"].alias("token"), total(x, j, "p"), total(x, j, "q"), x["shared"].alias("shared")))

    return let(F.sort_array(entries), added)


def _falling(values: Column) -> Column:
    return F.sort_array(values, asc=False)


def sorted_gap(p: Column, q: Column) -> Column:
    """L1 distance of two lists of numbers sorted by falling value, the shorter filled with 0."""
    gap = lambda a, b: F.abs(F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0)))
    return array_sum(F.zip_with(_falling(p), _falling(q), gap))


def matched_divergence(entries: Column, beta: float, eps: float = 1e-8) -> Column:
    """Generalised divergence over the shared tokens that the teacher lists; NULL if there is none."""
    term = lambda x: divergence_term(F.greatest(x["p"], F.lit(eps)), F.greatest(x["q"], F.lit(eps)), beta)
    shared = F.filter(entries, lambda x: x["shared"] & (x["q"] > 0))
    return let(shared, lambda s: F.when(F.size(s) > 0, array_sum(F.transform(s, term))))


def unmatched_gap(entries: Column, cut: bool) -> Column:
    """Sorted L1 over the tokens of one side only. With ``cut`` the student's list ends where the teacher's
    does, and the gap is NULL if either is empty.
    """
    own = lambda side: F.transform(F.filter(entries, lambda x: ~x["shared"] & (x[side] > 0)), lambda x: x[side])
    if not cut:
        return sorted_gap(own("p"), own("q"))
    return cut_gap(own("p"), own("q"))


def cut_gap(p: Column, q: Column) -> Column:
    """Sorted L1 of ``q`` and as many of the largest of ``p``; NULL if either is empty."""
    pair = F.struct(_falling(p).alias("p"), q.alias("q"))
    gap = lambda s: F.when((F.size(s["p"]) > 0) & (F.size(s["q"]) > 0), sorted_gap(F.slice(s["p"], 1, F.size(s["q"])), s["q"]))
    return let(pair, gap)
