"""Advantages, replay and token-level objectives over rollouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunetable import udf
from tunetable.functions import objectives as O
from tunetable.functions.messages import first_index, head
from tunetable.functions.render import render_chat
from tunetable.functions.rewards import overlong_penalty, weighted_sum
from tunetable.functions.tokens import n_words
from tunetable.operators import groups as G
from tunetable.operators.skew import with_group_stats
from tunetable.plans.datasets import sql_render
from tunetable.plans.inputs import (
    ROLLOUT_ORDER,
    SQL_MESSAGES,
    SQL_ORDER_ROLLOUTS,
    SQL_ROLLOUTS,
    SQL_TOKEN_ROWS,
    message_table,
    num,
    order_rollouts,
    rollouts,
    sequence_rows,
    sql_num,
    sql_words,
)
from tunetable.plans.registry import query

KEYS = ["group_id", *ROLLOUT_ORDER]
_KEYS = ", ".join(KEYS)


# --- flagship ---------------------------------------------------------------

@query(
    f"""WITH {SQL_MESSAGES}, f AS (SELECT *, list_position(list_transform(messages, lambda m: m.role), 'assistant') AS f FROM msgs),
    p AS (SELECT conv_id, md5({sql_render('messages[1:f-1]')} || '<|im_start|>assistant' || chr(10)) AS prompt FROM f WHERE f > 0),
    s AS (SELECT c.conv_id, c.turn, prompt, len({sql_words('c.text')}) AS n FROM conversations c JOIN p USING (conv_id) WHERE role = 'assistant'),
    r AS (SELECT *, CASE WHEN n <= 100 THEN 0.0 WHEN n <= 300 THEN (100 - n) / 200.0 ELSE -1.0 END::DOUBLE AS reward FROM s),
    g AS (SELECT *, avg(reward) OVER (PARTITION BY conv_id) AS m, coalesce(stddev_samp(reward) OVER (PARTITION BY conv_id), 0.0) AS sd FROM r)
    SELECT conv_id, turn, prompt, {sql_num('reward')} AS reward, {sql_num('(reward - m) / (sd + 0.0001)')} AS advantage, sd < 0.00000001 AS zero_std FROM g"""
)
def conversation_advantage(spark, sf):
    """Assistant turns as rollouts of what opens their conversation: prompt text, length reward, advantage."""
    m = F.col("messages")
    opening = head(m, first_index(m, lambda x: x.role == "assistant") - 1)
    numbered = F.transform(m, lambda x, i: F.struct(i.cast("long").alias("turn"), x.role.alias("role"), n_words(x.content).alias("n")))
    # A conversation is one row, so its group is too: nothing is shuffled after the messages are gathered.
    rows = message_table(spark, sf).select(
        "conv_id", F.md5(render_chat(opening, ask=True)).alias("prompt"), F.filter(numbered, lambda x: x.role == "assistant").alias("said")
    )
    scored = G.advantages_in_row(F.transform("said", lambda x: overlong_penalty(x.n, 300, 200)))
    paired = F.zip_with("said", scored, lambda x, s: F.struct(x.turn.alias("turn"), s.reward.alias("reward"), s.advantage.alias("advantage"), s.zero_std.alias("zero_std")))
    out = rows.select("conv_id", "prompt", F.inline(paired))
    return out.select("conv_id", "turn", "prompt", num(F.col("reward")).alias("reward"), num(F.col("advantage")).alias("advantage"), "zero_std")


# --- groups -----------------------------------------------------------------


@query(
    f"WITH {SQL_ORDER_ROLLOUTS} SELECT {_KEYS}, {sql_num('r_quantity * 1.0 + coalesce(r_discount, 0) * 0.5 + coalesce(r_tax, 0) * -0.25')} AS reward FROM orr"
)
def weighted_reward(spark, sf):
    total = weighted_sum([F.col(r) for r in ("r_quantity", "r_discount", "r_tax")], [1.0, 0.5, -0.25])
    return order_rollouts(spark, sf).select(*KEYS, num(total).alias("reward"))


@query(f"WITH {SQL_ORDER_ROLLOUTS} SELECT {_KEYS} FROM orr WHERE r_discount IS NULL AND r_tax IS NULL")
def rows_without_reward(spark, sf):
    return G.all_null_rows(order_rollouts(spark, sf), ["r_discount", "r_tax"]).select(*KEYS)


def _advantage_sql(std: str, scaled: bool = True) -> str:
    adv = f"(reward - m) / (sd + {G.EPS})" if scaled else "reward - m"
    return (
        f"WITH {SQL_ORDER_ROLLOUTS}, g AS (SELECT *, avg(reward) OVER (PARTITION BY group_id) AS m, {std} AS sd FROM orr) "
        f"SELECT {_KEYS}, {sql_num(adv)} AS advantage, sd < 0.00000001 AS zero_std FROM g"
    )


_GROUP_STD = "coalesce(stddev_samp(reward) OVER (PARTITION BY group_id), 0.0)"


def _advantage(spark, sf, scale):
    out = G.group_advantage(order_rollouts(spark, sf), ["group_id"], "reward", scale)
    return out.select(*KEYS, num(F.col("advantage")).alias("advantage"), "zero_std")


@query(_advantage_sql(_GROUP_STD))
def group_advantage(spark, sf):
    return _advantage(spark, sf, "group")


@query(_advantage_sql("stddev_samp(reward) OVER ()"))
def batch_scaled_advantage(spark, sf):
    return _advantage(spark, sf, "batch")


@query(_advantage_sql(_GROUP_STD, scaled=False))
def unscaled_advantage(spark, sf):
    return _advantage(spark, sf, "none")


@query(
    f"""WITH {SQL_ORDER_ROLLOUTS}, g AS (SELECT *, sum(reward) OVER (PARTITION BY group_id) AS s, count(*) OVER (PARTITION BY group_id) AS n FROM orr)
    SELECT {_KEYS}, {sql_num('CASE WHEN n > 1 THEN reward - (s - reward) / (n - 1) ELSE 0.0 END')} AS advantage FROM g"""
)
def leave_one_out_advantage(spark, sf):
    out = G.leave_one_out_advantage(order_rollouts(spark, sf), ["group_id"], "reward")
    return out.select(*KEYS, num(F.col("advantage")).alias("advantage"))


@query(
    f"""WITH {SQL_ORDER_ROLLOUTS}, c AS (SELECT *, least(greatest(reward, 5.0), 40.0) - 0.1 * coalesce(r_tax, 0.0) AS r FROM orr),
    g AS (SELECT *, sum(r) OVER (PARTITION BY group_id) AS s, count(*) OVER (PARTITION BY group_id) AS n FROM c),
    a AS (SELECT *, CASE WHEN n > 1 THEN r - (s - r) / (n - 1) ELSE 0.0 END AS a FROM g)
    SELECT {_KEYS}, {sql_num('(a - avg(a) OVER ()) / (stddev_samp(a) OVER () + 0.0001)', 5)} AS advantage FROM a"""
)
def normalised_leave_one_out(spark, sf):
    df = order_rollouts(spark, sf).withColumn("kl", F.coalesce("r_tax", F.lit(0.0)))
    out = G.leave_one_out_advantage(df, ["group_id"], "reward", (5.0, 40.0), "kl", 0.1, normalise=True)
    return out.select(*KEYS, num(F.col("advantage"), 5).alias("advantage"))


@query(
    f"""WITH {SQL_ORDER_ROLLOUTS}, k AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY r_quantity - coalesce(r_tax, 0) DESC, {', '.join(ROLLOUT_ORDER)}) AS r FROM orr),
    g AS (SELECT *, avg(reward) OVER (PARTITION BY group_id) AS m, {_GROUP_STD} AS sd FROM k WHERE r <= 2)
    SELECT {_KEYS}, {sql_num('(reward - m) / (sd + 0.0001)')} AS advantage FROM g"""
)
def filtered_group_advantage(spark, sf):
    df = order_rollouts(spark, sf).withColumn("score", F.col("r_quantity") - F.coalesce("r_tax", F.lit(0.0)))
    kept = G.keep_best(df, ["group_id"], "score", ROLLOUT_ORDER, 2)
    out = G.group_advantage(kept, ["group_id"], "reward", small_groups=True)
    return out.select(*KEYS, num(F.col("advantage")).alias("advantage"))


@query(f"WITH {SQL_ORDER_ROLLOUTS} SELECT {_KEYS}, {sql_num('avg(reward) OVER (PARTITION BY group_id)')} AS group_mean, count(*) OVER (PARTITION BY group_id) AS group_rows FROM orr")
def group_values_on_rows(spark, sf):
    out = with_group_stats(order_rollouts(spark, sf), ["group_id"], {"group_mean": F.avg("reward"), "group_rows": F.count("*")})
    return out.select(*KEYS, num(F.col("group_mean")).alias("group_mean"), "group_rows")


_SQL_SCORES = (
    f"{SQL_ORDER_ROLLOUTS}, g AS (SELECT *, avg(reward) OVER (PARTITION BY group_id) AS m, {_GROUP_STD} AS sd FROM orr), "
    "sc AS (SELECT group_id, round(sum(abs((reward - m) / (sd + 0.0001)) * sd), 6) AS score FROM g GROUP BY group_id HAVING max(sd) > 0)"
)


def _scores(spark, sf):
    out = G.group_advantage(order_rollouts(spark, sf), ["group_id"], "reward")
    return G.replay_scores(out, ["group_id"], "advantage", "group_std").withColumn("score", F.round("score", 6))


@query(f"WITH {_SQL_SCORES} SELECT group_id, score FROM sc ORDER BY score DESC, group_id LIMIT 256")
def replay_buffer(spark, sf):
    return G.replay_buffer(_scores(spark, sf), ["group_id"], 256)


@query(
    f"""WITH {_SQL_SCORES}, b AS (SELECT group_id, score FROM sc ORDER BY score DESC, group_id LIMIT 256)
    SELECT group_id, score FROM b ORDER BY -ln((((group_id * 7919 + 13) % 10007) + 0.5::DOUBLE) / 10007) / score, group_id LIMIT 64"""
)
def replay_draw(spark, sf):
    buffer = G.replay_buffer(_scores(spark, sf), ["group_id"], 256)
    u = (F.pmod(F.col("group_id") * 7919 + 13, F.lit(10007)) + 0.5) / 10007
    return G.weighted_draw(buffer, "score", 64, u, ["group_id"])


@query(
    f"""WITH {_SQL_SCORES}, b AS (SELECT group_id, score FROM sc ORDER BY score DESC, group_id LIMIT 64), c AS (SELECT *, sum(score) OVER (ORDER BY group_id) AS upto, sum(score) OVER () AS total FROM b),
    f AS (SELECT group_id, (((group_id * 7919 + 13) % 10007) + 0.5::DOUBLE) / 10007 AS u FROM g GROUP BY group_id HAVING max(sd) < 0.00000001)
    SELECT f.group_id, min(c.group_id) AS replay_group_id FROM f JOIN c ON c.upto > f.u * c.total GROUP BY f.group_id"""
)
def replay_fill(spark, sf):
    # There are more flat groups than the buffer holds, so draws repeat.
    scored = G.group_advantage(order_rollouts(spark, sf), ["group_id"], "reward")
    groups = scored.groupBy("group_id").agg(F.max("group_std").alias("std"))
    buffer = G.replay_buffer(_scores(spark, sf), ["group_id"], 64)
    u = (F.pmod(F.col("group_id") * 7919 + 13, F.lit(10007)) + 0.5) / 10007
    return G.fill_from_replay(groups, ["group_id"], "std", buffer, u)


@query(
    f"""WITH {SQL_ROLLOUTS}, g AS (SELECT *, max(length(completion)) OVER (PARTITION BY group_id) AS longest, max(r_length) OVER (PARTITION BY group_id) AS best FROM rollouts)
    SELECT group_id, idx, {sql_num('r_length / best + length(completion) / longest')} AS filter_score FROM g"""
)
def group_filter_scores(spark, sf):
    def score(texts, rewards):
        longest, best = max(map(len, texts)), max(rewards)
        return [r / best + len(t) / longest for t, r in zip(texts, rewards)]

    df = rollouts(spark, sf).select("group_id", "idx", "completion", "r_length")
    out = udf.group_scores(df, ["group_id"], "idx", "completion", "r_length", score)
    return out.select("group_id", "idx", num(F.col("filter_score")).alias("filter_score"))


# --- token level ------------------------------------------------------------

FORMS = ("grpo", "bnpo", "dr_grpo", "dapo", "cispo", "sapo")
_W = "(policy - old)"
_KL = "(exp(ref - policy) - (ref - policy) - 1)"
_CLIPPED = f"(-least(exp({_W}) * a, least(greatest(exp({_W}), 0.8), 1.2) * a))"
_GATE = "(4.0 / {t} / (1.0 + exp(-({t} * (exp(" + _W + ") - 1)))))"
_SAPO = f"(-(CASE WHEN a > 0 THEN {_GATE.format(t='1.0')} ELSE {_GATE.format(t='1.05')} END) * a)"
_CISPO = f"(-least(exp({_W}), 1.2) * a * policy)"


def _mean_per_sequence(loss: str) -> str:
    return f"(SELECT avg(x) FROM (SELECT sum(({loss} + 0.04 * {_KL}) * mask) / greatest(sum(mask), 1) AS x FROM tr GROUP BY conv_id, turn))"


def _total(loss: str) -> str:
    return f"sum(({loss} + 0.04 * {_KL}) * mask)"


@query(
    f"""WITH {SQL_TOKEN_ROWS} SELECT {sql_num(_mean_per_sequence(_CLIPPED))} AS grpo, {sql_num(f'{_total(_CLIPPED)} / greatest(sum(mask), 1)')} AS bnpo,
    {sql_num(f'{_total(_CLIPPED)} / (count(DISTINCT (conv_id, turn)) * 256)')} AS dr_grpo, {sql_num(f'{_total(_CLIPPED)} / sum(mask)')} AS dapo,
    {sql_num(f'{_total(_CISPO)} / sum(mask)')} AS cispo, {sql_num(_mean_per_sequence(_SAPO))} AS sapo FROM tr"""
)
def token_objectives(spark, sf):
    rows = sequence_rows(spark, sf)
    weights = O.importance_log_weights(F.col("policy"), F.col("old"), F.col("mask"))
    rows = rows.withColumn("w", weights)
    kl = F.zip_with("policy", "ref", lambda p, r: 0.04 * O.k3(p, r))

    def loss(form):
        tokens = O.token_losses(form, F.col("w"), F.col("policy"), F.col("advantage"), high=1.2 if form == "cispo" else 0.2)
        return O.reduce_token_losses(form, F.zip_with(tokens, kl, lambda a, b: a + b), F.col("mask"), 256)

    return rows.agg(*[num(loss(f)).alias(f) for f in FORMS])


@query(
    f"""WITH {SQL_TOKEN_ROWS}, m AS (SELECT conv_id, turn, sum((policy - old) * mask) / greatest(sum(mask), 1) AS s, sum(exp(policy - old)) AS t, count(*) AS n FROM tr GROUP BY conv_id, turn)
    SELECT conv_id, turn, {sql_num('t / n')} AS token_ratio, {sql_num('exp(s)')} AS sequence_ratio, {sql_num('exp(s) * n')} AS sequence_token_sum FROM m"""
)
def importance_ratios(spark, sf):
    rows = sequence_rows(spark, sf)
    level = lambda k: F.transform(O.importance_log_weights(F.col("policy"), F.col("old"), F.col("mask"), k), F.exp)
    return rows.select(
        "conv_id", "turn",
        num(O.array_sum(level("token")) / F.size("policy")).alias("token_ratio"),
        num(F.get(level("sequence"), F.lit(0))).alias("sequence_ratio"),
        num(O.array_sum(level("sequence_token"))).alias("sequence_token_sum"),
    )


_D = "((policy - old) * mask)"


@query(
    f"""WITH {SQL_TOKEN_ROWS} SELECT conv_id, turn, {sql_num(f'sum(least(exp({_D}), 2.0))')} AS token_truncate, {sql_num(f'sum(CASE WHEN exp({_D}) > 2.0 THEN 0.0 ELSE exp({_D}) END)')} AS token_mask,
    {sql_num(f'least(exp(sum({_D})), 2.0)')} AS sequence_truncate, {sql_num(f'CASE WHEN exp(sum({_D})) > 2.0 THEN 0.0 ELSE exp(sum({_D})) END')} AS sequence_mask FROM tr GROUP BY conv_id, turn"""
)
def sampler_correction(spark, sf):
    args = F.col("policy"), F.col("old"), F.col("mask")
    modes = [f"{level}_{rule}" for level in ("token", "sequence") for rule in ("truncate", "mask")]
    return sequence_rows(spark, sf).select(
        "conv_id", "turn", *[num(O.array_sum(O.sampler_correction(*args, m, 2.0))).alias(m) for m in modes]
    )


@query(
    f"""WITH {SQL_TOKEN_ROWS}, q AS (SELECT quantile_cont(-policy, 0.8) AS t FROM tr WHERE mask = 1)
    SELECT conv_id, turn, CAST(sum(CASE WHEN mask = 1 AND -policy >= t THEN 1 ELSE 0 END) AS INTEGER) AS kept, {sql_num('max(t)')} AS threshold FROM tr, q GROUP BY conv_id, turn"""
)
def high_entropy_tokens(spark, sf):
    rows = sequence_rows(spark, sf).withColumn("entropy", F.transform("policy", lambda x: -x))
    out = G.high_entropy_mask(rows.select("conv_id", "turn", "entropy", "mask"), "turn", "entropy", "mask", 0.8)
    kept = F.aggregate("entropy_mask", F.lit(0), lambda a, x: a + x)
    return out.select("conv_id", "turn", kept.alias("kept"), num(F.col("threshold")).alias("threshold"))


@query(f"WITH {SQL_TOKEN_ROWS} SELECT count(*) AS tokens, true AS within_error FROM tr WHERE mask = 1")
def high_entropy_sketch(spark, sf):
    """Whether the sketch's threshold keeps the rank error it promises, over all valid tokens."""
    q, error = 0.8, 0.001
    rows = sequence_rows(spark, sf).withColumn("entropy", F.transform("policy", lambda x: -x))
    out = G.high_entropy_mask(rows.select("entropy", "mask"), "turn", "entropy", "mask", q, error)
    tokens = out.select("threshold", F.explode(F.arrays_zip(F.col("entropy").alias("v"), F.col("mask").alias("m"))).alias("t")).filter("t.m = 1")
    below, upto = F.count_if(F.col("t.v") < F.col("threshold")), F.count_if(F.col("t.v") <= F.col("threshold"))
    n = F.count("*")
    return tokens.agg(n.alias("tokens"), ((below <= (q + error) * n + 1) & (upto >= (q - error) * n - 1)).alias("within_error"))


@query(
    f"""WITH {SQL_TOKEN_ROWS}, f AS (SELECT conv_id % 4 AS rank, mask, CASE WHEN exp({_W}) < 0.8 AND a < 0 THEN 1.0 ELSE 0.0 END AS lo, CASE WHEN exp({_W}) > 1.2 AND a > 0 THEN 1.0 ELSE 0.0 END AS hi FROM tr),
    r AS (SELECT rank, sum(lo * mask) / greatest(sum(mask), 1) AS lo, sum(hi * mask) / greatest(sum(mask), 1) AS hi, sum(greatest(lo, hi) * mask) / greatest(sum(mask), 1) AS reg FROM f GROUP BY rank)
    SELECT {sql_num('avg(lo)')} AS low_mean, {sql_num('min(lo)')} AS low_min, {sql_num('avg(hi)')} AS high_mean, {sql_num('max(hi)')} AS high_max, {sql_num('avg(reg)')} AS region_mean FROM r"""
)
def clip_fractions(spark, sf):
    rows = sequence_rows(spark, sf)
    low, high = O.clip_flags(O.importance_log_weights(F.col("policy"), F.col("old"), F.col("mask")), F.col("advantage"))
    rows = rows.select((F.col("conv_id") % 4).alias("rank"), "mask", low.alias("lo"), high.alias("hi"))
    mean = lambda c: F.sum(O.array_dot(c, F.col("mask"))) / F.greatest(F.sum(O.array_sum(F.col("mask").cast("array<double>"))), F.lit(1.0))
    region = F.zip_with("lo", "hi", lambda a, b: F.greatest(a, b))
    ranks = rows.groupBy("rank").agg(mean(F.col("lo")).alias("lo"), mean(F.col("hi")).alias("hi"), mean(region).alias("region"))
    return ranks.agg(
        num(F.avg("lo")).alias("low_mean"), num(F.min("lo")).alias("low_min"), num(F.avg("hi")).alias("high_mean"),
        num(F.max("hi")).alias("high_max"), num(F.avg("region")).alias("region_mean"),
    )


# Values of the advantage recursion: a tenth of the old model's log-probs.
_SQL_DELTAS = (
    f"{SQL_TOKEN_ROWS}, sh AS (SELECT conv_id, turn, pos, -0.05 * (policy - ref) + CASE WHEN pos = n - 1 THEN a ELSE 0 END AS r, old / 10 AS v, mask FROM tr), "
    "de AS (SELECT *, r + 0.99 * coalesce(lead(v) OVER (PARTITION BY conv_id, turn ORDER BY pos), 0) - v AS d FROM sh), "
    "ga AS (SELECT *, sum(d * pow(0.99 * 0.95, pos)) OVER (PARTITION BY conv_id, turn ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) / pow(0.99 * 0.95, pos) AS adv FROM de)"
)


def _shaped(spark, sf):
    rows = sequence_rows(spark, sf)
    rewards = O.shaped_rewards(F.col("policy"), F.col("ref"), F.col("advantage"), F.size("policy") - 1, 0.05)
    return rows.withColumn("rewards", rewards).withColumn("values", F.transform("old", lambda x: x / 10))


def _long(df, *cols):
    """One row per token, for comparison."""
    zipped = F.arrays_zip(*[F.col(c) for c in cols])
    return df.select("conv_id", "turn", F.posexplode(zipped).alias("pos", "z")).select("conv_id", "turn", "pos", *[num(F.col(f"z.{c}"), 4).alias(c) for c in cols])


@query(f"WITH {_SQL_DELTAS} SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, {sql_num('adv', 4)} AS advantages, {sql_num('adv + v', 4)} AS returns FROM ga")
def generalised_advantages(spark, sf):
    advantages, returns = O.generalised_advantage(F.col("rewards"), F.col("values"), 0.99, 0.95)
    return _long(_shaped(spark, sf).select("conv_id", "turn", advantages.alias("advantages"), returns.alias("returns")), "advantages", "returns")


@query(
    f"""WITH {SQL_TOKEN_ROWS} SELECT conv_id, turn, {sql_num('sum(-0.05 * (policy - ref)) + max(a)')} AS k1_total, {sql_num(f'sum(-0.05 * {_KL}) + max(a)')} AS k3_total,
    {sql_num('max(-0.05 * (policy - ref) + a) FILTER (pos = n - 1)')} AS k1_last FROM tr GROUP BY conv_id, turn"""
)
def shaped_rewards(spark, sf):
    shape = lambda k: O.shaped_rewards(F.col("policy"), F.col("ref"), F.col("advantage"), F.size("policy") - 1, 0.05, k)
    return sequence_rows(spark, sf).select(
        "conv_id", "turn", num(O.array_sum(shape("k1"))).alias("k1_total"), num(O.array_sum(shape("k3"))).alias("k3_total"),
        num(F.get(shape("k1"), F.size("policy") - 1)).alias("k1_last"),
    )


@query(
    f"""WITH {SQL_TOKEN_ROWS}, s AS (SELECT avg(policy) AS m, var_samp(policy) AS v FROM tr WHERE mask = 1)
    SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, {sql_num('CASE WHEN mask = 1 THEN (policy - s.m) / sqrt(s.v + 1e-8) ELSE 0 END', 4)} AS white,
    {sql_num('CASE WHEN mask = 1 THEN (policy - s.m) / sqrt(s.v + 1e-8) + s.m ELSE 0 END', 4)} AS scaled FROM tr, s"""
)
def whitened_tokens(spark, sf):
    rows = sequence_rows(spark, sf)
    rows = G.whiten(G.whiten(rows, "policy", "mask", "white"), "policy", "mask", "scaled", shift_mean=False)
    return _long(rows, "white", "scaled")


@query(
    f"""WITH {SQL_TOKEN_ROWS}, s AS (SELECT conv_id, turn, pos, (ref - policy) * pow(0.98, pos) AS r, pow(0.98, pos) AS g FROM tr),
    w AS (SELECT *, sum(r) OVER x AS a, sum(g) OVER x AS l FROM s WINDOW x AS (PARTITION BY conv_id, turn ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, {sql_num('a', 4)} AS plain, {sql_num('a / l', 4)} AS normalised, {sql_num('a / g', 4)} AS divided FROM w"""
)
def discounted_suffix_rewards(spark, sf):
    args = F.col("policy"), F.col("ref"), 0.98
    rows = sequence_rows(spark, sf).select(
        "conv_id", "turn", O.discounted_suffix(*args).alias("plain"), O.discounted_suffix(*args, normalise=True).alias("normalised"),
        O.discounted_suffix(*args, divide=True).alias("divided"),
    )
    return _long(rows, "plain", "normalised", "divided")

