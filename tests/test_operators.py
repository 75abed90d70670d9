"""Ordering, skew, groups, alignment, windows, builders and samplers against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tunetable.operators import align, builders, groups, metrics, sampling, skew, windows
from tunetable.operators import ordering as order
from tunetable.operators.vocab import build_vocabulary, encode, tokens_of
from tunetable.plans.inputs import half_counts
from tunetable.sources import splits

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def skewed(spark, n=600, seed=1):
    """A third of the rows in one group, values with many ties."""
    rng = random.Random(seed)
    rows = [(i, 0 if rng.random() < 0.34 else rng.randrange(1, 40), rng.randrange(8)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, k long, v long")


# --- ordering ---------------------------------------------------------------


def test_global_index(spark):
    rows, df = skewed(spark)
    got = {r.id: r.row_index for r in order.global_index(df, F.desc("v"), "id").collect()}
    assert got == {i: n for n, (i, _, _) in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}


def test_the_order_really_is_split(spark):
    _, df = skewed(spark)
    parts = order._ranged(df, ["k", "v", "id"])
    assert parts.select("_part").distinct().count() > 1
    assert parts.filter("k = 0").select("_part").distinct().count() > 1


def test_rank_within_splits_hot_groups(spark):
    rows, df = skewed(spark)
    want, seen = {}, Counter()
    for i, k, v in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        seen[k] += 1
        want[i] = seen[k]
    got = {r.id: r["rank"] for r in order.rank_within(df, ["k"], ["v", "id"]).collect()}
    assert got == want


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_totals(spark, keys, inclusive):
    rows, df = skewed(spark)
    want, total = {}, defaultdict(int)
    for i, k, v in sorted(rows):
        g = k if keys else None
        want[i] = total[g] + (v if inclusive else 0)
        total[g] += v
    out = order.running_totals(df, ["id"], {"t": F.col("v")}, keys, inclusive)
    assert {r.id: r.t for r in out.collect()} == want


def test_running_totals_of_a_null_group(spark):
    df = spark.range(50).select("id", F.when(F.col("id") % 5 == 0, F.col("id")).alias("k"))
    got = {r.id: r["rank"] for r in order.rank_within(df, ["k"], ["id"]).collect()}
    nulls = [i for i in range(50) if i % 5]
    assert got == {**{i: n + 1 for n, i in enumerate(nulls)}, **{i: 1 for i in range(0, 50, 5)}}


@FEW
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60), st.floats(0, 1))
def test_exact_quantile(spark, xs, q):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    assert order.exact_quantile(df, "v", q).first()["quantile"] == pytest.approx(np.quantile(xs, q))


@pytest.mark.parametrize("n", [0, 1, 250, 600, 700])
def test_first_in_order(spark, n):
    rows, df = skewed(spark)
    want = {r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))[:n]}
    assert {r.id for r in df.filter(order.first_in_order(df, n, "v", "id")).collect()} == want


def test_splits(spark):
    df = spark.range(100)
    for train, test in (splits.sized_split(df, "id", 30), splits.ordered_split(df, "id", 0.7), splits.tail_split(df, "id", 70)):
        a, b = ({r.id for r in x.collect()} for x in (train, test))
        assert len(a) == 30 and len(b) == 70 and not a & b
    a, b = splits.fraction_split(df, splits.hash_slot("id", 3), 0.25)
    assert a.count() + b.count() == 100
    assert [r.id for r in splits.percent_slice(df, "id", 5, 8).collect()] == [5, 6, 7]


# --- skew -------------------------------------------------------------------


@pytest.mark.parametrize("head", [1, 3, 10_000])
def test_join_unique(spark, head):
    rows, df = skewed(spark)
    sizes = Counter(k for _, k, _ in rows)
    table = spark.createDataFrame([(k, n, k * 10) for k, n in sizes.items() if k != 7], "k long, n long, x long")
    out = skew.join_unique(df, table, ["k"], "n", ["x"], head_keys=head)
    assert out.columns == ["id", "k", "v", "x"]
    assert {r.id: r.x for r in out.collect()} == {i: None if k == 7 else k * 10 for i, k, _ in rows}


def test_hot_rows_are_spread_over_the_shuffle(spark):
    rows, df = skewed(spark, 3000)
    sizes = Counter(k for _, k, _ in rows)
    table = spark.createDataFrame([(k, n, 1) for k, n in sizes.items()], "k long, n long, x long")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = skew.join_unique(df, table, ["k"], "n", ["x"], head_keys=4).withColumn("part", F.spark_partition_id())
        per_task = [r["count"] for r in out.groupBy("part").count().collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(per_task) == 3000
    assert max(per_task) < sizes[0]


def test_group_stats_with_null_keys(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (None, 9.0)], "k long, v double")
    got = {(r.k, r.v): r.m for r in groups.with_group_stats(df, ["k"], {"m": F.avg("v")}).collect()}
    assert got == {(1, 2.0): 3.0, (1, 4.0): 3.0, (None, 9.0): 9.0}


# --- groups -----------------------------------------------------------------


@pytest.mark.parametrize("small", [True, False])
def test_group_advantage(spark, small):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0), (3, 2.0), (3, 2.0)], "g long, r double")
    got = {(r.g, r.r): (r.advantage, r.zero_std) for r in groups.group_advantage(df, ["g"], "r", small_groups=small).collect()}
    s = math.sqrt(2)
    assert got[1, 1.0][0] == pytest.approx(-1 / (s + 1e-4)) and got[1, 3.0][0] == pytest.approx(1 / (s + 1e-4))
    assert got[2, 5.0] == (0.0, True) and got[3, 2.0] == (0.0, True) and not got[1, 1.0][1]
    with pytest.raises(ValueError):
        groups.group_advantage(df, ["g"], "r", "other")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_best_cuts_groups_before_the_shuffle(spark):
    _, df = skewed(spark)
    out = groups.keep_best(df, ["k"], "v", ["id"], 3)
    below = plan_of(out).split("Exchange", 1)[1]
    assert "WindowGroupLimit" in below
    assert out.groupBy("k").count().filter("count > 3").isEmpty()


def test_group_stats_share_one_shuffle(spark):
    _, df = skewed(spark)
    out = groups.with_group_stats(df, ["k"], {"m": F.avg("v")})
    out.collect()
    final = out._jdf.queryExecution().toString()
    assert "ReusedExchange" in final
    assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final


def test_leave_one_out(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 6.0), (2, 5.0)], "g long, r double")
    got = {(r.g, r.r): r.advantage for r in groups.leave_one_out_advantage(df, ["g"], "r").collect()}
    assert got == {(1, 1.0): -3.0, (1, 2.0): -1.5, (1, 6.0): 4.5, (2, 5.0): 0.0}


def test_advantages_of_a_list_equal_those_of_rows(spark):
    rng = random.Random(6)
    lists = [[rng.choice([0.0, 0.35, 1.0, None, -2.5]) for _ in range(rng.randrange(0, 9))] for _ in range(30)] + [[0.35] * 7, [None, None], []]
    df = spark.createDataFrame(list(enumerate(lists)), "g long, r array<double>")
    one = df.select("g", F.posexplode(groups.advantages_in_row(F.col("r"))).alias("i", "x")).select("g", "i", "x.*")
    many = groups.group_advantage(df.select("g", F.posexplode("r").alias("i", "reward")), ["g"], "reward")
    key = lambda r: (r.g, r.i)
    got, want = sorted(one.collect(), key=key), sorted(many.collect(), key=key)
    assert len(got) == sum(map(len, lists)) and list(map(key, got)) == list(map(key, want))
    for a, b in zip(got, want):
        assert a.reward == b.reward and a.group_mean == pytest.approx(b.group_mean) and a.group_std == pytest.approx(b.group_std)
        assert a.advantage == pytest.approx(b.advantage) and a.zero_std == b.zero_std


def test_replay_buffer(spark):
    scores = spark.createDataFrame([(i, s) for i, s in enumerate([1.25, 0.1, 2.5, 1.25, 0.05, 3.0, 0.75, 0.75])], "g long, score double")
    kept = [r.score for r in groups.replay_buffer(scores, ["g"], 4).collect()]
    assert kept == [3.0, 2.5, 1.25, 1.25]


@pytest.mark.parametrize("flat", [3, 40])
def test_replay_fill(spark, flat):
    buffer = spark.createDataFrame([(100 + i, 1.0 + i) for i in range(8)], "g long, score double")
    stds = spark.createDataFrame([(i, 0.0) for i in range(flat)] + [(50 + i, 1.0) for i in range(5)], "g long, s double")
    rows = groups.fill_from_replay(stds, ["g"], "s", buffer, groups.uniform(5, "g")).collect()
    drawn = [r.replay_g for r in rows]
    assert sorted(r.g for r in rows) == list(range(flat))
    assert set(drawn) <= set(range(100, 108))
    if flat <= 8:
        assert len(set(drawn)) == flat


def test_weighted_draws_follow_the_weights(spark):
    buffer = spark.createDataFrame([(0, 1.0), (1, 3.0)], "g long, score double")
    rows = spark.range(4000).withColumnRenamed("id", "i")
    out = groups.draw_with_replacement(rows, buffer, "score", ["g"], groups.uniform(1, "i"), "p")
    share = out.filter("p.g = 1").count() / 4000
    assert share == pytest.approx(0.75, abs=0.04)


def test_draws_follow_the_cumulative_weights(spark):
    rng = random.Random(4)
    weights = [rng.choice([1e-9, 0.5, 2.0, 700.0]) for _ in range(300)] + [0.0, 1e-30]
    buffer = spark.createDataFrame(list(enumerate(weights)), "g long, score double").repartition(5)
    points = [0.0, 1 - 2**-53] + [rng.random() for _ in range(500)]
    rows = spark.createDataFrame(list(enumerate(points)), "i long, u double")
    got = {r.i: r.p for r in groups.draw_with_replacement(rows, buffer, "score", ["g"], F.col("u"), "p").collect()}
    ends = np.cumsum(weights)
    assert len(got) == len(points)
    for i, u in enumerate(points):
        g = got[i].g
        assert got[i].w == weights[g] > 1e-20
        assert ends[g] - weights[g] - 1e-6 <= u * ends[-1] <= ends[g] + 1e-6
    nobody = groups.draw_with_replacement(rows, buffer.filter("g < 0"), "score", ["g"], F.col("u"), "p").collect()
    assert len(nobody) == len(points) and all(r.p is None for r in nobody)


def test_whiten_and_entropy_mask(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 99.0], [1, 1, 0]), (2, [3.0, 6.0, 0.0], [1, 1, 0])], "k int, v array<double>, m array<int>")
    vals = np.array([1, 2, 3, 6.0])
    want = (vals - vals.mean()) / np.sqrt(vals.var(ddof=1) + 1e-8)
    got = [r.w for r in groups.whiten(df, "v", "m", "w").orderBy("k").collect()]
    assert np.allclose(got, [[want[0], want[1], 0], [want[2], want[3], 0]])
    masks = [r.entropy_mask for r in groups.high_entropy_mask(df, "k", "v", "m", 0.5).orderBy("k").collect()]
    assert masks == [[0, 0, 0], [1, 1, 0]]


# --- alignment --------------------------------------------------------------


def brute_groups(student, teacher):
    """Groups end wherever both sides have spelled the same text."""
    spelled = lambda ps: {"".join(ps[: i + 1]): i for i in range(len(ps)) if ps[i]}
    s, t = spelled(student), spelled(teacher)
    cuts = [x for x in s if x in t]
    number = lambda ends: lambda i: sum(1 for c in cuts if ends[c] < i)
    return [number(s)(i) for i in range(len(student))], [number(t)(i) for i in range(len(teacher))]


@FEW
@given(st.lists(st.sampled_from(["a", "ab", "b", "ba", "abc"]), min_size=1, max_size=12), st.lists(st.sampled_from(["a", "b", "ab", "c", "ca"]), min_size=1, max_size=12))
def test_alignment_groups(spark, student, teacher):
    side = lambda ps: spark.createDataFrame([(1, i, p) for i, p in enumerate(ps)], "seq long, pos int, piece string")
    rows = align.alignment_groups(side(student), side(teacher), "seq").collect()
    got = [[r.group for r in sorted((x for x in rows if x.side == s), key=lambda x: x.pos)] for s in ("student", "teacher")]
    assert got == list(map(list, brute_groups(student, teacher)))


def test_attach_is_complete(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, a string")
    b = spark.createDataFrame([(1, "z")], "k long, b string")
    with pytest.raises(PySparkException):
        align.attach(a, b, ["k"]).collect()
    assert align.attach(a, b, ["k"], complete=False).count() == 1


def test_fill_tail(spark):
    rows = [(0, 0, 1, math.log(0.5)), (0, 1, 1, math.log(0.1)), (0, 2, 2, math.log(0.3)), (0, 3, 99, math.log(0.2)), (1, 0, 0, 0.0)]
    df = spark.createDataFrame(rows, "pos int, o int, token_id int, logp double")
    got = {r.pos: r for r in align.fill_tail(df, ["pos"], "o", 4).collect()}
    assert got[0].tail_logp == pytest.approx(math.log(0.2 / 2))
    assert got[1].tail_logp is None


def test_rank_pairs(spark):
    rng = random.Random(4)
    rows = [(i, i % 3, rng.random(), rng.random()) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, b long, x double, y double")
    got = sorted((r.b, r["rank"], r.first, r.second) for r in align.rank_pairs(df, "b", F.col("x"), F.col("y"), "id").collect())
    want = []
    for b in range(3):
        xs, ys = (sorted(r[c] for r in rows if r[1] == b) for c in (2, 3))
        want += [(b, i + 1, x, y) for i, (x, y) in enumerate(zip(xs, ys))]
    assert got == want


def test_vocabulary_and_encoding(spark):
    docs = spark.createDataFrame([(1, "b a, a"), (2, ""), (3, "a c")], "k long, t string")
    vocab = build_vocabulary(tokens_of(docs, "t"))
    assert [(r.token, r.id) for r in vocab.orderBy("id").collect()] == [("a", 0), (",", 1), ("b", 2), ("c", 3)]
    got = {r.k: r.input_ids for r in encode(docs, "t", vocab, ["k"]).collect()}
    assert got == {1: [2, 0, 1, 0], 2: [], 3: [0, 3]}


# --- conversation windows ---------------------------------------------------


def brute_slices(roles, counts, budget, most):
    target, found = roles[-1], defaultdict(list)
    for end in range(1, len(roles) + 1):
        for start in range(1, end + 1):
            part, cost = roles[start - 1 : end], counts[start - 1 : end]
            prompt = sum(cost) if part[-1] == "user" else sum(cost[:-1])
            if part[-1] != target or len(part) > most or prompt > budget:
                continue
            if target == "assistant" and "user" not in part[:-1]:
                continue
            found[end].append(start)
    return found


@FEW
@given(
    st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), st.integers(1, 9)), min_size=1, max_size=9), min_size=12, max_size=12),
    st.integers(0, 20),
    st.integers(1, 6),
)
def test_slice_ranges(spark, talks, budget, most):
    rows = [(i, [r for r, _ in t], [c for _, c in t]) for i, t in enumerate(talks)]
    df = spark.createDataFrame(rows, "i int, roles array<string>, counts array<long>")
    ranges = df.select("i", windows.slice_ranges(F.col("roles"), F.col("counts"), budget, most).alias("x"))
    for row in ranges.collect():
        got = {r["end"]: list(range(r["first"], r["last"] + 1)) for r in row.x}
        assert got == dict(brute_slices(rows[row.i][1], rows[row.i][2], budget, most))


def test_budget_filter_needs_rows(spark):
    none = windows.budget_filter(spark.range(3), F.col("id"), F.lit(1), -1, 5)
    for read in (none.collect, none.count):
        with pytest.raises(PySparkException, match="within the budget"):
            read()
    some = windows.budget_filter(spark.range(9), F.col("id"), F.lit(1), 3, 5)
    assert sorted(r.id for r in some.collect()) == [0, 1, 2, 3] and some.count() == 4


@pytest.mark.parametrize("error", [0.01, 0.0005])
def test_entropy_sketch_keeps_its_rank_error(spark, error):
    rng = random.Random(12)
    rows = [(i, [rng.choice([rng.random(), rng.expovariate(1), 0.25]) for _ in range(40)], [int(rng.random() < 0.9) for _ in range(40)]) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v array<double>, m array<int>").repartition(6)
    valid = sorted(x for _, v, m in rows for x, on in zip(v, m) if on)
    for q in (0.05, 0.5, 0.8, 0.99):
        got = groups.high_entropy_mask(df, "k", "v", "m", q, error).collect()
        t = got[0].threshold
        below, upto = sum(x < t for x in valid), sum(x <= t for x in valid)
        assert below <= (q + error) * len(valid) + 1 and upto >= (q - error) * len(valid) - 1
        for r in got:
            assert r.entropy_mask == [int(on and x >= t) for x, on in zip(r.v, r.m)]


# --- builders ---------------------------------------------------------------


def test_rotation(spark):
    rows, df = skewed(spark, 120)
    by_k = defaultdict(list)
    for i, k, _ in rows:
        by_k[k].append(i)
    want = {i: ids[n - 1] for ids in by_k.values() for n, i in enumerate(ids)}
    df = df.withColumn("x", F.col("id"))
    assert {r.id: r.y for r in builders.rotate_in_batch(df, "k", "id", "x", "y").collect()} == want


def test_step_tree(spark):
    ddl = (
        "id int, prompt string, steps array<struct<completions:array<struct<text:string,rating:int>>,"
        "chosen_completion:int,human_completion:struct<text:string>>>"
    )
    steps = [
        ([("a", 1), ("b", -1)], 0, None),
        ([("c", 0)], None, ("h",)),
        ([("d", 1), ("e", 1)], None, None),
        ([("z", 1)], 0, None),
    ]
    df = spark.createDataFrame([(1, "p", steps), (2, "q", [(None, None, None)]), (3, "r", [([("x", 1)], 0, None)])], ddl)
    got = defaultdict(set)
    for r in builders.expand_step_tree(df, "prompt", "steps").collect():
        got[r.id].add((tuple(r.completions), tuple(r.labels)))
    assert got[1] == {
        (("b",), (False,)),
        (("a", "c"), (True, False)),
        (("a", "h", "d"), (True, True, True)),
        (("a", "h", "e"), (True, True, True)),
        (("a", "h"), (True, True)),
    }
    assert got[2] == {((), ())}
    assert got[3] == {(("x",), (True,))}


def test_marked_steps(spark):
    text = "What is it? Step 1: add ки\nStep 2: stop ки"
    marks = "What is it? Step 1: add +\nStep 2: stop -"
    df = spark.createDataFrame([(text, marks)], "t string, m string")
    p, c, x = builders.marked_steps(F.col("t"), F.col("m"))
    assert tuple(df.select(p, c, x).first()) == ("What is it?", ["Step 1: add", "Step 2: stop"], [True, False])
    p, c, x = builders.marked_steps(F.col("t"), F.col("m"), F.lit(True))
    assert tuple(df.select(p, c, x).first()) == ("What is it? Step 1: add", ["Step 2: stop"], [False])
    asked = spark.createDataFrame([("Why? Because ки so ки", "Why? Because + so +")], "t string, m string")
    p, c, x = builders.marked_steps(F.col("t"), F.col("m"))
    assert tuple(asked.select(p, c, x).first()) == ("Why?", ["Because", "so"], [True, True])


def test_transcripts(spark):
    start = "\n\nHuman: Hi\n\nAssistant: Yo\n\nHuman: Why?\n\nAssistant: "
    df = spark.createDataFrame([(start + "Because.", start + "Bah.")], "chosen string, rejected string")
    row = builders.transcript_pair(df).first()
    assert [(m.role, m.content) for m in row.prompt] == [("user", "Hi"), ("assistant", "Yo"), ("user", "Why?")]
    assert (row.chosen[0].content, row.rejected[0].content) == ("Because.", "Bah.")


def test_best_and_worst_ties(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (1, 1, 2.0), (2, 0, 1.0), (2, 1, 3.0)], "g int, i int, r double")
    got = {x.g: (x.chosen.i, x.rejected.i) for x in builders.best_and_worst(df, ["g"], "r", "i", ["i"]).collect()}
    assert got == {1: (0, 1), 2: (1, 0)}


def test_unknown_batch(spark):
    with pytest.raises(PySparkException):
        spark.range(1).select(builders.batch_prompt(F.lit("nope"), F.lit(""), F.lit(""), F.lit(""), F.lit(""))).collect()


def test_choice_helpers(one):
    samples = F.array(*[F.lit(x) for x in ("a", "a", "b")])
    best, other = builders.best_and_first_other(samples, F.lit(1))
    chosen, rejected = builders.choose(F.array(F.lit("x"), F.lit("y")), F.lit(1))
    row = one(a=best, b=other, c=chosen, d=rejected, e=builders.wrap_solution(F.lit("No")), f=builders.wrap_solution(F.lit("7")))
    assert tuple(row) == ("a", "b", "y", "x", "No", "$7$")


# --- samplers and metrics ---------------------------------------------------


def test_repeat_sampler(spark):
    ordered = lambda **k: [r.id for r in sampling.repeat_sampler(spark.range(7), ["id"], **k).orderBy("position").collect()]
    assert ordered(mini_repeat=2) == [i for i in range(7) for _ in range(2)]
    assert ordered(batch=3, repeat=2) == [0, 1, 2, 0, 1, 2, 3, 4, 5, 3, 4, 5]
    assert ordered(batch=2, mini_repeat=2, repeat=2)[:8] == [0, 0, 1, 1, 0, 0, 1, 1]


@pytest.mark.parametrize(("rows", "n", "want"), [(6, 4, [2, 2, 1, 1]), (3, 5, [1, 1, 1]), (8, 4, [2, 2, 2, 2])])
def test_even_chunks(spark, rows, n, want):
    sizes = Counter(r.chunk for r in sampling.even_chunks(spark.range(rows), ["id"], n).collect())
    assert [sizes[c] for c in sorted(sizes)] == want


def test_first_per(spark):
    rows, df = skewed(spark)
    want = {}
    for i, k, v in rows:
        want.setdefault(k, (i, v))
    assert {r.k: (r.id, r.v) for r in sampling.first_per(df, ["k"], "id").collect()} == want


def test_shuffle_keeps_rows_together(spark):
    df = spark.range(50).withColumn("x", F.col("id") * 2)
    rows = sampling.shuffled(df, 3, "id").collect()
    assert sorted(r.id for r in rows) == list(range(50)) and [r.id for r in rows] != list(range(50))
    assert all(r.x == 2 * r.id for r in rows)
    assert rows == sampling.shuffled(df, 3, "id").collect()


def test_running_moments(spark):
    xs = np.random.default_rng(2).normal(size=30)
    df = spark.createDataFrame([(i // 7, float(x)) for i, x in enumerate(xs)], "b long, v double")
    for r in metrics.running_moments(df, "b", "v").collect():
        seen = xs[: min((r.b + 1) * 7, 30)]
        assert (r["count"], r["mean"], r["std"]) == (len(seen), pytest.approx(seen.mean()), pytest.approx(seen.std(ddof=1)))


def test_win_rates_keep_failures(spark):
    df = spark.createDataFrame([(1,), (0,), (-1,), (1,)], "w int")
    row = metrics.win_rates(df, "w").first()
    assert (row.win_rate, row.valid_win_rate) == (0.5, pytest.approx(2 / 3))


def test_length_metrics_without_ended_rows(spark):
    df = spark.createDataFrame([([1, 2],), ([3],)], "ids array<int>")
    row = metrics.length_metrics(df, "ids", [9]).first()
    assert (row.mean_length, row.clipped_ratio, row.mean_terminated_length) == (1.5, 1.0, 0.0)


def test_pair_accuracy_drops_ties(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 1.0), (0.0, 2.0)], "c double, r double")
    assert tuple(metrics.pair_accuracy(df, "c", "r").first()) == (2, 0.5)


def test_null_and_repeated_keys_lose_nothing(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 4.0), ("a", 3, 2.0)], "k string, id long, x double")
    assert {r.id: r.y for r in builders.rotate_in_batch(df, "k", "id", "x", "y").collect()} == {1: 4.0, 2: 1.0, 3: 2.0}
    pairs = align.rank_pairs(df, "k", F.col("x"), -F.col("x"), "id").collect()
    assert sorted((str(r.k), r["rank"], r.first, r.second) for r in pairs) == [("None", 1, 1.0, -4.0), ("None", 2, 4.0, -1.0), ("a", 1, 2.0, -2.0)]
    one = spark.createDataFrame([(None, "t", 0.75), (None, "u", 0.25)], "k string, token string, p double")
    assert [r.l1 for r in align.sorted_l1(one, one, ["k"], "p").collect()] == [0.0]


def test_small_test_shares_are_not_empty(spark):
    _, test = splits.fraction_split(spark.range(200_000), splits.hash_slot("id", 3), 0.0005)
    assert 50 < test.count() < 200


def test_running_baseline_weighs_batches_alike(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, None), (2, 8.0), (4, 2.0), (4, 2.0), (4, 5.0)], "b long, v double")
    got = {r.b: (r.rows, r.baseline) for r in metrics.running_baseline(df, "b", "v").collect()}
    assert got == {0: (2, 2.0), 1: (1, 2.0), 2: (1, 5.0), 4: (3, pytest.approx(13 / 3))}
    none = spark.createDataFrame([(0, None)], "b long, v double")
    assert metrics.running_baseline(none, "b", "v").first().baseline is None


@pytest.mark.parametrize("weights", [None, (0.25, 0.5)])
def test_dense_hybrid_loss(spark, weights):
    p = np.array([[0.5, 0.2, 0.2, 0.1], [0.1, 0.3, 0.2, 0.4]])  # tokens 0, 1 shared; 2, 3 the student's
    q = np.array([[0.3, 0.4, 0.3], [0.6, 0.2, 0.2]])  # tokens 0, 1 shared; 4 the teacher's
    rows = lambda a, names: [(k, t, float(a[k, i])) for k in range(2) for i, t in enumerate(names)]
    student = spark.createDataFrame(rows(p, [0, 1, 2, 3]), "k long, token long, p double")
    teacher = spark.createDataFrame(rows(q, [0, 1, 4]), "k long, token long, p double")
    vocabulary = spark.createDataFrame([(t, 2, t < 2) for t in range(5)], "token long, n long, shared boolean")
    mix = (p[:, :2] + q[:, :2]) / 2
    matched = (0.5 * p[:, :2] * np.log(p[:, :2] / mix) + 0.5 * q[:, :2] * np.log(q[:, :2] / mix)).sum() / 2
    own = (np.sort(p[:, 2:])[:, ::-1] - np.pad(q[:, 2:], ((0, 0), (0, 1)))).__abs__().sum() / 2
    a, b = weights or (2 / 3, 1 / 3)
    row = align.hybrid_loss(
        student, teacher, vocabulary, ["k"], 0.5, weights, teacher_tokens=F.lit(3), matched_tokens=F.lit(2), dense=True
    ).first()
    assert (row.matched_loss, row.unmatched_loss, row.loss) == pytest.approx((matched, own, a * matched + b * own))


def test_fill_tail_over_a_vocabulary(spark):
    df = spark.createDataFrame([(0, "a", 0, 0.5), (0, "b", 1, 0.25), (0, "c", 7, 0.2), (1, "a", 0, 1.0)], "k long, token string, token_id int, p double")
    rows = align.fill_tail(df.withColumn("logp", F.log("p")), ["k"], "token", F.lit(5)).orderBy("k").collect()
    assert rows[0].tail_logp == pytest.approx(math.log(0.25 / 3))  # id 7 is out of range
    assert rows[1].tail_logp is None


def brute_halves(docs):
    """``(doc, row, token, p, q)`` of rows of words."""
    out = []
    for row, (doc, text) in enumerate(docs):
        w = (text or "").split()
        cut = (len(w) + 1) // 2
        for t in sorted(set(w)):
            out.append((doc, row, t, w[:cut].count(t) / cut, w[cut:].count(t) / (len(w) - cut) if len(w) > cut else 0.0))
    return out


HALVED = [(1, "a b a c b d"), (2, "a"), (3, ""), (4, None), (5, "a b c a"), (5, "a b c a"), (5, "b z"), (6, "c c d"), (6, ""), (None, "a b a"), (None, "b b")]


def test_half_counts(spark):
    docs = spark.createDataFrame(HALVED, "doc_id long, text string")
    got = half_counts(docs).collect()
    assert sorted((str(r.doc_id), r.token, r.p, r.q) for r in got) == sorted((str(d), t, p, q) for d, _, t, p, q in brute_halves(HALVED))
    assert len({(r.row, r.token) for r in got}) == len(got)
    plan = half_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the texts; no shuffle of tokens


def test_divergence_of_pairs_is_that_of_joined_sides(spark):
    both = spark.createDataFrame(brute_halves(HALVED), "k long, row long, token string, p double, q double")
    student, teacher = both.filter("p > 0").select("k", "token", "p"), both.filter("q > 0").select("k", "token", "q")
    joined = student.join(teacher, ["k", "token"], "full_outer")
    want = {r.k: r.divergence for r in align.divergence_by_position(joined, ["k"], "p", "q", 0.3).collect()}
    for again in (both, both.filter("k IS NULL OR k = 5")):
        got = {r.k: r.divergence for r in align.divergence_of_pairs(both, again, "k", "row", 0.3).collect()}
        assert got == pytest.approx(want) and set(got) == {None, 1, 2, 5, 6}


def test_losses_of_pairs_are_those_of_merged_rows(spark):
    both = spark.createDataFrame(brute_halves(HALVED), "k long, row long, token string, p double, q double").cache()
    side = lambda c: both.filter(F.col(c) > 0).select("k", F.col(c).alias("v"))
    want = align.rank_aligned_loss(side("p"), side("q"), ["k"], "v").first().loss
    assert align.rank_aligned_loss_of_pairs(both, ["k"], "p", "q").first().loss == pytest.approx(want)
    vocabulary = spark.createDataFrame([("a", 9, True), ("b", 7, False), ("c", 5, False), ("z", 1, True)], "token string, n long, shared boolean")
    of = lambda *more: tuple(align.hybrid_loss_of_pairs(both.drop(*(() if more else ("row",))), vocabulary, ["k"], 0.5, (0.4, 0.6), None, None, None, *more).first())
    plain = of()
    for again in (both, both.filter("k IS NULL OR k = 5")):
        assert of(again, "row") == pytest.approx(plain)


def test_encode_keeps_unknown_tokens_and_extreme_ids(spark):
    docs = spark.createDataFrame([(1, "a b c a"), (2, "b"), (2, "c a")], "k long, t string")
    vocab = spark.createDataFrame([("a", 2**31 - 1, 3), ("b", -(2**31), 2)], "token string, id int, n long")
    got = sorted((r.k, tuple(r.ids)) for r in encode(docs, "t", vocab, ["k"], "ids").collect())
    a, b = 2**31 - 1, -(2**31)
    assert got == [(1, (a, b, None, a)), (2, (None, b, a)), (2, (None, b, a))]
    plan = encode(docs, "t", vocab, ["k"], "ids")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan  # tokens are not sorted to find their ids
