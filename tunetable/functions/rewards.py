"""Rule-based rewards and judge arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunetable.functions.binding import let

# Formats a reward checks, anchored at the start of the text.
THINK = r"(?s)\A<think>(?!.*<think>).*?</think>.*"
THINK_ANSWER = r"(?d)\A<think>.*?</think><answer>.*?</answer>$"
THINK_ANSWER_LINES = r"(?smd)\A<think>\n.*?\n</think>\n<answer>\n.*?\n</answer>$"
THINK_ANSWER_LOOSE = r"(?s)\A<think>.*?</think>.*?<answer>.*?</answer>"
REASONING_ENDS = ("</think>",)
BOX = "\\boxed{"

# Notation of answers: formulas between signs, spacing without a value, numbers in prose, quotients.
FORMULA = r"(?s)\$\$?[^$]+\$|\\\(.+?\\\)|\\\[.+?\\\]"
SPACING = r"\\left|\\right|\\[,;:! ()\[\]]|\^\{?\\circ\}?|[\s$]"
COMMAND_OR_FUNCTION = r"\\[A-Za-z]+|\b(?:sin|cos|tan|log|ln|exp|sqrt|pi|inf)\b"
NUMBER = r"[+-]?\d(?:[\d,]*\d)?(?:\.\d+)?(?:/\d+(?:\.\d+)?)?%?"
QUOTIENT = r"\A([+-]?)(\d*)(?:\.(\d*))?(?:/([+-]?)(\d+)(?:\.(\d*))?)?(\\?%)?\z"


def matches(text: Column, pattern: str) -> Column:
    return F.when(F.rlike(text, F.lit(pattern)), 1.0).otherwise(0.0)


def think_format(text: Column) -> Column:
    """1 if the text opens with one think block that closes."""
    return matches(text, THINK)


def overlong_penalty(n_tokens: Column, max_length: int, margin: int) -> Column:
    """0, then a linear fall to -1 over the last ``margin`` tokens."""
    return (
        F.when(n_tokens <= max_length - margin, 0.0)
        .when(n_tokens <= max_length, (F.lit(max_length - margin) - n_tokens) / F.lit(float(margin)))
        .otherwise(-1.0)
    )


def extract_answer(text: Column) -> Column:
    """Value of the last closed box, else of the last formula between signs; NULL without either."""
    return answer_value(F.coalesce(_last_boxed(text), _last_formula(text)))


def extract_gold(text: Column) -> Column:
    """Value of a gold answer, which may also be a bare expression or prose with a number; NULL if it holds none."""
    prose = F.rlike(F.regexp_replace(text, COMMAND_OR_FUNCTION, " "), F.lit(r"\p{L}{2}"))
    bare = F.when(prose, F.try_element_at(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0)), F.lit(-1))).otherwise(text)
    return answer_value(F.coalesce(_last_boxed(text), _last_formula(text), bare))


def answer_value(raw: Column) -> Column:
    """An answer written one way only: equal values are equal texts.

    Whole numbers, decimals, percentages and their quotients become reduced fractions, sets are sorted without
    repeats, tuples and intervals keep brackets and order; anything else is compared as normalised text.
    """
    bare = F.regexp_replace(raw, SPACING, "")
    bare = F.regexp_replace(bare, r"(?<=[\d}%])\\(?:text|mathrm|mbox)\{[^{}]*\}", "")
    bare = F.regexp_replace(bare, r"\\(?:text|mathrm|mbox)\{([^{}]*)\}", "$1")
    bare = F.regexp_replace(bare, r"(?<=\d),(?=\d{3}(?!\d))", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"\\[dt]frac", r"\\frac"), r"\\frac(\d)(\d)", r"\\frac{$1}{$2}")
    bare = F.regexp_replace(bare, r"\\frac\{([+-]?[\d.]+)\}\{([+-]?[\d.]+)\}", "$1/$2")
    bare = F.regexp_replace(F.lower(F.regexp_replace(bare, r"\.+\z", "")), r"\A[a-z]=(?!.*=)", "")

    def written(t: Column) -> Column:
        inner = F.regexp_replace(t, r"(?s)\A(?:\\\{|[(\[])(.*)(?:\\\}|[)\]])\z", "$1")
        items = F.split(inner, r",(?![^({]*[)}])")
        many = F.rlike(t, F.lit(r"(?s)\A\\\{.*\\\}\z")) | (F.size(items) > 1)
        ordered = F.rlike(t, F.lit(r"(?s)\A[(\[].*[)\]]\z"))
        parts = F.transform(F.when(many, items).otherwise(F.array(t)), _number)
        as_set = lambda p: F.concat(F.lit("{"), F.array_join(F.array_sort(F.array_distinct(p)), ","), F.lit("}"))
        in_order = lambda p: F.concat(F.left(t, F.lit(1)), F.array_join(p, ","), F.right(t, F.lit(1)))
        return let(parts, lambda p: F.when(~many, F.get(p, F.lit(0))).when(ordered, in_order(p)).otherwise(as_set(p)))

    return let(F.nullif(bare, F.lit("")), lambda t: F.when(t.isNotNull(), written(t)))


def _number(text: Column) -> Column:
    """A number as a reduced fraction ``a/b``; other text, zero divisors and over 18 digits stay as written."""
    plain = F.regexp_replace(text, r"(?s)\A[{(](.*)[})]\z", "$1")
    part = lambda t, i: F.regexp_extract(t, QUOTIENT, i)
    zeros = lambda digits: F.repeat(F.lit("0"), F.length(digits))

    def sides(t: Column) -> Column:
        divisor = F.concat(part(t, 5), part(t, 6))
        top = F.concat(part(t, 2), part(t, 3), zeros(part(t, 6)))
        bottom = F.concat(F.when(divisor == "", "1").otherwise(divisor), zeros(part(t, 3)), F.when(part(t, 7) == "", "").otherwise("00"))
        whole = lambda c: F.regexp_replace(c, r"\A0+(?=\d)", "")
        sign = F.when((part(t, 1) == "-") != (part(t, 4) == "-"), "-").otherwise("")
        return F.struct(whole(top).alias("top"), whole(bottom).alias("bottom"), sign.alias("sign"))

    def reduced(x: Column) -> Column:
        # A step of division with remainder at least halves a number in two; five steps a digit are enough.
        steps = F.sequence(F.lit(0), F.length(x.bottom) * 5)
        start = F.struct(x.top.try_cast("long").alias("a"), x.bottom.try_cast("long").alias("b"))
        step = lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), F.try_mod(s["a"], s["b"]).alias("b")))
        return let(
            F.aggregate(steps, start, step)["a"],
            lambda g: F.concat(F.when(x.top == "0", "").otherwise(x.sign), _quotient(x.top, g), F.lit("/"), _quotient(x.bottom, g)),
        )

    def number(t: Column) -> Column:
        exact = lambda x: (F.length(x.top) <= 18) & (F.length(x.bottom) <= 18) & (x.bottom != "0")
        return let(sides(t), lambda x: F.when(exact(x), reduced(x)).otherwise(t))

    return let(plain, lambda t: F.when(F.rlike(t, F.lit(QUOTIENT)) & F.rlike(t, F.lit(r"\A[+-]?\.?\d")), number(t)).otherwise(t))


def _quotient(digits: Column, divisor: Column) -> Column:
    """``digits div divisor`` as text."""
    return F.call_function("div", digits.try_cast("long"), divisor).cast("string")


def _last_formula(text: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(FORMULA), F.lit(0)), F.lit(-1))


def _last_boxed(text: Column) -> Column:
    """What the last box holds, to the brace that closes it at any depth; NULL without a closed box."""
    tail = F.substring_index(text, BOX, -1)
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at"))
    turn = lambda c: F.when(c == "{", 1).when(c == "}", -1).otherwise(0)
    step = lambda s, c: F.when(s["depth"] == 0, s).otherwise(
        F.struct((s["depth"] + turn(c)).alias("depth"), (s["at"] + F.lit(1)).alias("at"))
    )
    end = F.aggregate(F.regexp_extract_all(tail, F.lit("(?s)."), F.lit(0)), start, step)
    inside = let(end, lambda e: F.when(e["depth"] == 0, F.substr(tail, F.lit(1), e["at"] - 1)))
    return F.when(F.contains(text, F.lit(BOX)), inside)


def answer_accuracy(text: Column, gold: Column) -> Column:
    """1 or 0; NULL if the gold answer holds no value to compare with."""
    right = let(extract_gold(gold), lambda want: F.when(want.isNotNull(), F.coalesce(extract_answer(text) == want, F.lit(False))))
    return F.when(right, 1.0).when(~right, 0.0)


def reasoning_accuracy(text: Column, gold: Column, ends: Sequence[str] = REASONING_ENDS) -> Column:
    """Accuracy of what follows the reasoning; 0 if the reasoning never ends."""
    out = F.lit(0.0)
    for end in reversed(ends):
        rest = F.substring_index(text, end, -1)
        out = F.when(F.contains(text, F.lit(end)), answer_accuracy(rest, gold)).otherwise(out)
    return out


def distinct_chars(text: Column) -> Column:
    return F.size(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")))


def boxed_match(text: Column, truth: Column) -> Column:
    """Whether the first boxed expression equals the truth."""
    return F.when(F.regexp_extract(text, r"\\boxed\{(.*?)\}", 1) == truth, 1.0).otherwise(0.0)


def length_rank(length: Column, shortest: Column, longest: Column, correct: Column) -> Column:
    """Shorter is better within a batch; a wrong answer earns nothing."""
    share = F.lit(0.5) - (length - shortest) / F.nullif(longest - shortest, F.lit(0))
    return F.when(longest == shortest, 0.0).when(correct, share).otherwise(F.least(F.lit(0.0), share))


def for_task(task: Column, name: str, reward: Column) -> Column:
    """The reward on rows of its own task, NULL elsewhere."""
    return F.when(task == name, reward)


def starred_answer(text: Column, answer: Column) -> Column:
    """+0.6 for the right ``*yes*``/``*no*``, -1 for the wrong one, -0.5 for none."""
    guess = F.regexp_extract(F.lower(text), r"\*(yes|no)\*", 1)
    return F.when(guess == "", -0.5).when(guess == F.lower(answer), 0.6).otherwise(-1.0)


def query_reward(queries: Column, answer: Column, hits: Column, failed: Column) -> Column:
    """Reward of a tool trajectory: query count, query quality and evidence for the answer.

    ``queries`` are the SQL texts of the calls, ``hits`` whether any tool
    returned rows and ``failed`` whether any returned an error.
    """
    low = F.transform(queries, lambda q: F.lower(q))
    count = lambda test: F.size(F.filter(low, test)).cast("double")
    has_where = lambda q: F.contains(q, F.lit(" where "))
    quality = (
        F.when(F.size(low) > 3, -1.5).otherwise(0.0)
        - count(lambda q: F.contains(q, F.lit("limit 1")))
        - 0.5 * count(lambda q: ~has_where(q))
        + 0.4 * F.least(count(has_where), F.lit(3.0))
    )
    supported = (hits & (F.lower(answer) == "yes")) | (~hits & (F.lower(answer) == "no"))
    evidence = F.when(failed, -2.0).when(F.size(low) == 0, -1.5).when(supported, 2.0).otherwise(-1.5)
    return quality + evidence


def structure_reward(messages: Column) -> Column:
    """Call, response and other text in a trajectory; messages carry ``tool_calls``."""
    calls = lambda m: (m.role == "assistant") & F.coalesce(F.size(m.tool_calls) > 0, F.lit(False))
    tool = lambda m: m.role == "tool"
    said = lambda m: ~F.coalesce(F.trim(m.content), F.lit("")).isin("", "<think>")
    has_call, has_response = F.exists(messages, calls), F.exists(messages, tool)
    has_other = F.exists(messages, lambda m: ~calls(m) & ~tool(m) & said(m))
    return (
        F.when(has_call & has_response & has_other, 0.1)
        .when(has_call & has_response, 0.05)
        .when(has_call, -0.15)
        .otherwise(0.0)
    )


def binary_conjunction(votes: Column) -> Column:
    """-1 if any judge failed, 1 if all agree on 1, else 0; other votes are an error."""
    valid = F.forall(votes, lambda v: v.isin(-1, 0, 1))
    return (
        F.when(~valid, F.raise_error(F.lit("binary judgements are -1, 0 or 1")))
        .when(F.array_contains(votes, -1), -1)
        .when(F.forall(votes, lambda v: v == 1), 1)
        .otherwise(0)
    )


def ordered_pair(flip: Column, first: Column, second: Column) -> tuple[Column, Column]:
    """A pair as shown to the judge."""
    return F.when(flip, second).otherwise(first), F.when(flip, first).otherwise(second)


def unflip(rank: Column, flip: Column) -> Column:
    """The verdict on the original order; a failed verdict stays -1."""
    return F.when(rank == -1, -1).when(flip, F.lit(1) - rank).otherwise(rank)


def shown_order(candidates: Column, *keys: Column | str) -> Column:
    """A reproducible shuffle of the candidates' places, against a judge's bias for a position."""
    n = F.size(candidates)
    drawn = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.xxhash64(*keys, i).alias("h"), i.alias("i")))
    return F.when(n > 0, F.transform(F.array_sort(drawn), lambda x: x.i)).otherwise(F.array().cast("array<int>"))


def in_order(candidates: Column, order: Column) -> Column:
    return F.transform(order, lambda i: F.get(candidates, i))


def own_places(ranks: Column, order: Column) -> Column:
    """Ranks given to shuffled candidates, as places in the list before the shuffle."""
    return F.transform(ranks, lambda r: F.get(order, r))


def soft_preference(score0: Column, score1: Column, temperature: float = 1.0) -> Column:
    """Probability that the first of two is better."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp((score1 - score0) / F.lit(float(temperature))))


def missing_end_penalty(reward: Column, ids: Column, end: int, penalty: float) -> Column:
    return F.when(F.array_contains(ids, end), reward).otherwise(reward - F.lit(float(penalty)))


def weighted_sum(rewards: Sequence[Column], weights: Sequence[float]) -> Column:
    """Sum that skips NULL rewards; 0 if all are NULL."""
    terms = [F.coalesce(r, F.lit(0.0)) * F.lit(float(w)) for r, w in zip(rewards, weights, strict=True)]
    return sum(terms[1:], terms[0])
