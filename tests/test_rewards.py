"""Rewards, judges and objectives against plain formulas."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tests.conftest import SF
from tunetable import udf
from tunetable.functions import objectives as O
from tunetable.functions import rewards as R

VALID = ["<think>a</think>b", "<think>\na\n</think>\nb", "<think></think>", "<think>a</think>", "<think>a</think>b</think>"]
INVALID = [
    "a</think>b", "<think>a", "a", "x<think>a</think>", "<think><think>a</think>b", "<think>a</think><think>b", "</think><think>", "", "<THINK>a</THINK>"
]


@pytest.mark.parametrize(("text", "want"), [(t, 1.0) for t in VALID] + [(t, 0.0) for t in INVALID])
def test_think_format(one, text, want):
    assert one(x=R.think_format(F.lit(text))).x == want


def test_overlong(one):
    assert [one(x=R.overlong_penalty(F.lit(n), 100, 20)).x for n in (50, 80, 90, 100, 110)] == [0.0, 0.0, -0.5, -1.0, -1.0]


@pytest.mark.parametrize(
    ("text", "gold", "want"),
    [
        (r"so \boxed{\frac{1}{3}}", r"\frac{1}{3}", 1.0),
        (r"so \boxed{\frac{1}{2}}", r"\frac{1}{3}", 0.0),
        (r"\boxed{1} then \boxed{ 2 }", "$2$.", 1.0),
        ("anything", "  ", None),
    ],
)
def test_accuracy(one, text, gold, want):
    assert one(x=R.answer_accuracy(F.lit(text), F.lit(gold))).x == want


def test_reasoning(one):
    score = lambda t, ends=("</think>",): one(x=R.reasoning_accuracy(F.lit(t), F.lit("3"), ends)).x
    assert score(r"<think>\boxed{4}</think>\boxed{3}") == 1.0
    assert score(r"<think>\boxed{3}</think>\boxed{4}") == 0.0
    assert score(r"\boxed{3}") == 0.0
    # The first delimiter of the list that occurs decides, at its last occurrence.
    assert score(r"\boxed{4}</b>\boxed{3}</a>\boxed{4}", ("</b>", "</a>")) == 0.0
    assert score(r"</a>\boxed{4}</b>\boxed{3}", ("</b>", "</a>")) == 1.0


def test_starred(one):
    got = [one(x=R.starred_answer(F.lit(t), F.lit("Yes"))).x for t in ("I say *YES*", "*no*", "yes")]
    assert got == [0.6, -1.0, -0.5]


def test_structure(spark):
    ddl = "m array<struct<role:string,content:string,tool_calls:array<string>>>"
    call, reply, text = ("assistant", None, ["q"]), ("tool", "r", None), ("assistant", "done", None)
    rows = [([call, reply, text],), ([call, reply],), ([call],), ([text],), ([call, reply, ("assistant", " <think> ", None)],)]
    got = [r.x for r in spark.createDataFrame(rows, ddl).select(R.structure_reward(F.col("m")).alias("x")).collect()]
    assert got == [0.1, 0.05, -0.15, 0.0, 0.05]


def test_conjunction(one, spark):
    votes = lambda *v: F.array(*[F.lit(x) for x in v])
    row = one(a=R.binary_conjunction(votes(1, 1)), b=R.binary_conjunction(votes(1, 0)), c=R.binary_conjunction(votes(0, -1)))
    assert tuple(row) == (1, 0, -1)
    with pytest.raises(PySparkException):
        spark.range(1).select(R.binary_conjunction(votes(2, 1))).collect()


def test_unflip_keeps_failures(one):
    row = one(**{f"x{r}{f}".replace("-", "m"): R.unflip(F.lit(r), F.lit(f)) for r in (-1, 0, 1) for f in (True, False)})
    assert tuple(row) == (-1, -1, 1, 0, 0, 1)


def test_weighted_sum_of_nothing_is_zero(one):
    none = F.lit(None).cast("double")
    assert one(x=R.weighted_sum([none, none], [1, 2])).x == 0.0


def test_length_rank(one):
    score = lambda n, ok, lo=10, hi=30: one(x=R.length_rank(F.lit(n), F.lit(lo), F.lit(hi), F.lit(ok))).x
    assert [score(10, True), score(30, True), score(10, False), score(30, False), score(10, True, 10, 10)] == [0.5, -0.5, 0.0, -0.5, 0.0]


# --- objectives -------------------------------------------------------------


def sig(x):
    return 1 / (1 + math.exp(-x))


@pytest.mark.parametrize("x", [-800.0, -3.0, 0.0, 2.5, 800.0])
def test_log_sigmoid_is_stable(one, x):
    want = -np.logaddexp(0, -x)
    assert one(x=O.log_sigmoid(F.lit(x))).x == pytest.approx(want, abs=1e-12)


def test_pair_losses(one):
    c, r, rc, rr = -4.0, -5.5, -4.5, -5.0
    cols = [F.lit(v) for v in (c, r, rc, rr)]
    beta, s = 0.3, 0.1
    x, a, b = (c - r) - (rc - rr), c - rc, r - rr
    ls = lambda v: math.log(sig(v))
    want = {
        "sigmoid": -ls(beta * x) * (1 - s) - ls(-beta * x) * s,
        "robust": (-ls(beta * x) * (1 - s) + ls(-beta * x) * s) / (1 - 2 * s),
        "exo_pair": sig(beta * x) * (ls(beta * x) - math.log(1 - s)) + sig(-beta * x) * (ls(-beta * x) - math.log(s)),
        "hinge": max(0, 1 - beta * x),
        "ipo": (x - 1 / (2 * beta)) ** 2,
        "sppo_hard": (a - 0.5 / beta) ** 2 + (b + 0.5 / beta) ** 2,
        "nca_pair": -ls(beta * a) - 0.5 * ls(-beta * a) - 0.5 * ls(-beta * b),
        "apo_zero": 1 - sig(beta * a) + sig(beta * b),
        "apo_down": sig(beta * a) + 1 - sig(beta * (a - b)),
        "discopop": -ls(beta * x) * (1 - sig(beta * x / 0.05)) + math.exp(-beta * x) * sig(beta * x / 0.05),
        "bco_pair": -ls(beta * a - 0.2) - ls(-(beta * b - 0.2)),
        "sft": 1.5,
    }
    got = one(**{n: O.pair_loss(n, *cols, beta=beta, smoothing=s, baseline=F.lit(0.2), nll=F.lit(1.5)) for n in O.PAIR_LOSSES})
    assert got.asDict() == pytest.approx(want)
    with pytest.raises(ValueError):
        O.pair_loss("nope", *cols)


def test_exo_default_smoothing_is_local(one):
    cols = [F.lit(v) for v in (-4.0, -5.5, -4.5, -5.0)]
    got = one(a=O.pair_loss("exo_pair", *cols), b=O.pair_loss("exo_pair", *cols, smoothing=1e-3), c=O.pair_loss("sigmoid", *cols))
    assert got.a == got.b
    assert got.c == pytest.approx(-math.log(sig(0.1 * 1.0)))


def reals(xs):
    return F.array(*[F.lit(float(x)) for x in xs]) if len(xs) else F.array().cast("array<double>")


@pytest.mark.parametrize("n", [0, 1, 5, 127, 128, 129, 300])
def test_backward_scan(one, n):
    xs = np.random.default_rng(n).normal(size=n)
    want, y = [], 0.0
    for x in xs[::-1]:
        y = x + 0.9 * y
        want.append(y)
    assert one(x=O.backward_scan(reals(xs), 0.9)).x == pytest.approx(want[::-1])


def test_generalised_advantage(one):
    r, v, g, lam = [0.1, 0.2, 1.0], [0.5, 0.4, 0.3], 0.9, 0.8
    deltas = [r[0] + g * v[1] - v[0], r[1] + g * v[2] - v[1], r[2] - v[2]]
    a2 = deltas[2]
    a1 = deltas[1] + g * lam * a2
    a0 = deltas[0] + g * lam * a1
    adv, ret = O.generalised_advantage(reals(r), reals(v), g, lam)
    row = one(a=adv, b=ret)
    assert row.a == pytest.approx([a0, a1, a2])
    assert row.b == pytest.approx([a0 + v[0], a1 + v[1], a2 + v[2]])


def test_log_softmax_and_entropy(one):
    xs = np.array([3.0, -1.0, 0.5, 700.0])
    want = xs - (xs.max() + np.log(np.exp(xs - xs.max()).sum()))
    row = one(a=O.log_softmax(reals(xs)), b=O.entropy(reals(xs[:3])))
    assert row.a == pytest.approx(want)
    p = np.exp(xs[:3]) / np.exp(xs[:3]).sum()
    assert row.b == pytest.approx(-(p * np.log(p)).sum())


def test_token_losses_forms(one):
    w, p, adv = [0.5, -0.5], [-1.0, -2.0], -0.7
    row = one(**{f: O.token_losses(f, reals(w), reals(p), F.lit(adv)) for f in ("grpo", "cispo", "sapo")}, two=O.token_losses("grpo", reals(w), reals(p), F.lit(adv), delta=1.1))
    ratio = [math.exp(x) for x in w]
    clipped = [min(max(x, 0.8), 1.2) for x in ratio]
    assert row.grpo == pytest.approx([-min(a * adv, b * adv) for a, b in zip(ratio, clipped)])
    assert row.cispo == pytest.approx([-min(a, 0.2) * adv * x for a, x in zip(ratio, p)])
    assert row.sapo == pytest.approx([-sig(1.05 * (a - 1)) * 4 / 1.05 * adv for a in ratio])
    assert row.two == pytest.approx([-min(min(a, 1.1) * adv, b * adv) for a, b in zip(ratio, clipped)])


def test_sampler_modes(one):
    old, new, mask = reals([0.0, 1.0, 2.0]), reals([0.0, 0.0, 0.0]), F.array(F.lit(1), F.lit(1), F.lit(0))
    row = one(**{m: O.sampler_correction(old, new, mask, m, 2.0) for m in ("token_truncate", "token_mask", "sequence_truncate", "sequence_mask")})
    assert row.token_truncate == pytest.approx([1, 2, 1])
    assert row.token_mask == pytest.approx([1, 0, 1])
    assert row.sequence_truncate == pytest.approx([2])
    assert row.sequence_mask == pytest.approx([0])


def test_divergence_ends(spark):
    rows = [(0.5, 0.2), (0.5, 0.8)]
    df = spark.createDataFrame(rows, "p double, q double")
    total = lambda beta: df.agg(F.sum(O.divergence_term(F.col("p"), F.col("q"), beta))).first()[0]
    kl = lambda i, j: sum(r[i] * math.log(r[i] / r[j]) for r in rows)
    assert total(0) == pytest.approx(kl(1, 0))
    assert total(1) == pytest.approx(kl(0, 1))
    mix = [(p, q, (p + q) / 2) for p, q in rows]
    assert total(0.5) == pytest.approx(sum(0.5 * q * math.log(q / m) + 0.5 * p * math.log(p / m) for p, q, m in mix))


@pytest.mark.parametrize(
    ("text", "gold", "want"),
    [
        (r"so \boxed{\frac{\sqrt{3}}{2}} holds", r"\boxed{\frac{\sqrt{3}}{2}}", 1.0),
        (r"\boxed{1} or rather \boxed{ \{2, {5}\} }.", r"$\{2,{5}\}$", 1.0),
        (r"\boxed{1,2}", "12", 0.0),
        (r"\boxed{1,234,567}", "1234567", 1.0),
        (r"\boxed{1,2345}", "12345", 0.0),
        (r"\boxed{\frac{7}{40}}", "7/40", 1.0),
        (r"\boxed{\dfrac{-7}{40}}", "-7/40", 1.0),
        (r"\boxed{\frac{7}{4}}", "4/7", 0.0),
        (r"never closed \boxed{3", "3", 0.0),
        ("🙂 \\boxed{a🙂{b}}", r"\boxed{a🙂{b}}", 1.0),
    ],
)
def test_answers_in_boxes(one, text, gold, want):
    assert one(r=R.answer_accuracy(F.lit(text), F.lit(gold))).r == want


def test_rank_judge_is_not_told_the_places(spark):
    texts = [["bb", "a", "cccc", "ddd"], [], ["only"]]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, texts array<string>").withColumn("p", F.lit("?"))
    order = R.shown_order(F.col("texts"), "k")
    df = df.withColumn("order", order).withColumn("shown", R.in_order(F.col("texts"), F.col("order")))

    def make():
        return lambda prompts, lists: [sorted(range(len(c)), key=lambda i: -len(c[i])) for c in lists]

    rows = udf.rank_rows(df, make, "p", "shown").withColumn("own", R.own_places(F.col("ranks"), F.col("order"))).orderBy("k").collect()
    assert [r.own for r in rows] == [[2, 3, 0, 1], [], [0]]
    assert [sorted(r.shown) for r in rows] == [sorted(t) for t in texts]


def test_binary_judge_with_and_without_gold(spark):
    df = spark.createDataFrame([("p", "yes", "yes"), ("p", "no", "yes"), ("p", None, "yes")], "p string, c string, g string")

    def make():
        return lambda prompts, given, gold=None: [-1 if c is None else int(gold is None or c == g) for c, g in zip(given, gold or given)]

    assert [r.satisfied for r in udf.binary_rows(df, make, "p", "c", "g").collect()] == [1, 0, -1]
    assert [r.satisfied for r in udf.binary_rows(df, make, "p", "c").collect()] == [1, 1, -1]


def test_fitted_weights_follow_the_formula(spark):
    rows = queries()["fitted_classifier_losses"](spark, SF).collect()
    assert {r.desirable for r in rows} == {True, False}
    for r in rows:
        weight = 1.0 if r.p is None else min(max(r.p / (1 - r.p + 1e-8), 0.5), 10.0)
        sign = 1 if r.desirable else -1
        loss = math.log1p(math.exp(-sign * (r.r - r.delta))) * (1 if r.desirable else weight)
        assert r.weight == pytest.approx(weight) and r.loss == pytest.approx(loss)


@pytest.mark.parametrize(
    ("text", "gold", "want"),
    [
        # A gold answer without a value says nothing about the text.
        ("Answer is seventeen.", "Answer is seventeen.", None),
        (r"\boxed{17}", "seventeen", None),
        ("", None, None),
        # Prose with a number, formulas between signs, and a text without either.
        (r"\boxed{17}", "There are 17 of them.", 1.0),
        ("It is $17$, or rather $18$.", "18", 1.0),
        (r"It is \(17\).", r"\[17\]", 1.0),
        ("17", "17", 0.0),
        (None, "17", 0.0),
        # One value, other notation.
        (r"\boxed{0.75}", r"\frac{3}{4}", 1.0),
        (r"\boxed{\frac{9}{12}}", ".75", 1.0),
        (r"\boxed{75\%}", "3/4", 1.0),
        (r"\boxed{75}", r"75\%", 0.0),
        (r"\boxed{\frac34}", "0.750", 1.0),
        (r"\boxed{-\frac{3}{4}}", r"\frac{3}{-4}", 1.0),
        (r"\boxed{+007.0}", "7", 1.0),
        (r"\boxed{-0}", "0", 1.0),
        (r"\boxed{1.5/0.25}", "6", 1.0),
        (r"\boxed{x = 7}", "7", 1.0),
        (r"\boxed{12\text{ km}}", "12", 1.0),
        (r"\boxed{\text{B}}", "$B$", 1.0),
        (r"\boxed{0.3333}", r"\frac{1}{3}", 0.0),
        (r"\boxed{1/0}", "1/0", 1.0),
        (r"\boxed{123456789012345678901234567890}", "123456789012345678901234567890", 1.0),
        (r"\boxed{123456789012345678901234567890}", "123456789012345678901234567891", 0.0),
        (r"\boxed{999999999999999999/999999999999999998}", "999999999999999999/999999999999999998", 1.0),
        # Sets in any order, tuples in theirs.
        (r"\boxed{\{0.5, 2, 2\}}", r"\boxed{\left\{2, \frac{1}{2}\right\}}", 1.0),
        (r"\boxed{2, 1}", r"\{1, 2\}", 1.0),
        (r"\boxed{(1, 2)}", "(1.0, 4/2)", 1.0),
        (r"\boxed{(2, 1)}", "(1, 2)", 0.0),
        (r"\boxed{[1, 2)}", "(1, 2)", 0.0),
        (r"\boxed{(7)}", "7", 1.0),
    ],
)
def test_answers_by_value(one, text, gold, want):
    say = lambda t: F.lit(t).cast("string")
    assert one(x=R.answer_accuracy(say(text), say(gold))).x == want


@given(st.integers(-(10**6), 10**6), st.integers(1, 10**4), st.integers(1, 50))
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_fractions_are_reduced(one, a, b, k):
    f = Fraction(a, b)
    got = one(x=R.answer_value(F.lit(f"{a * k}/{b * k}")), y=R.answer_value(F.lit(rf"\frac{{{a}}}{{{b}}}")))
    assert got.x == got.y == f"{f.numerator}/{f.denominator}"
