"""Objectives over logged log-probabilities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunetable.functions import objectives as O
from tunetable.functions.tokens import IGNORED
from tunetable.operators import density as D
from tunetable.operators.align import rank_pairs
from tunetable.operators.metrics import running_baseline, running_moments, share
from tunetable.operators.skew import join_unique, with_group_stats
from tunetable.plans.inputs import (
    SQL_PAIR_LOGPS,
    SQL_SEQ_LOGPS,
    SQL_TOKEN_ROWS,
    num,
    pair_logps,
    sequence_logps,
    sequence_rows,
    sql_ls,
    sql_num,
    sql_sig,
)
from tunetable.plans.registry import query
from tunetable.sources.scan import table

BETA = 2.0
PAIR = ("chosen", "rejected", "ref_chosen", "ref_rejected")


def _pair_cols():
    return [F.col(c) for c in PAIR]


# --- sequences --------------------------------------------------------------


@query(
    f"WITH {SQL_TOKEN_ROWS} SELECT conv_id, turn, {sql_num('sum(policy * mask)')} AS total, {sql_num('sum(policy * mask) / sum(mask)')} AS mean FROM tr GROUP BY conv_id, turn HAVING sum(mask) > 0"
)
def sequence_log_probs(spark, sf):
    labels = F.transform("mask", lambda m: F.when(m == 1, 5).otherwise(IGNORED))
    df = sequence_rows(spark, sf).filter(F.array_contains("mask", 1)).withColumn("labels", labels)
    logp = lambda avg: num(O.sequence_logp(F.col("policy"), F.col("labels"), avg))
    return df.select("conv_id", "turn", logp(False).alias("total"), logp(True).alias("mean"))


# --- pair family ------------------------------------------------------------

_X = "((chosen - rejected) - (ref_chosen - ref_rejected))"
_A, _B = "(chosen - ref_chosen)", "(rejected - ref_rejected)"
_BX = f"({BETA} * {_X})"
_BASE = f"({BETA} * (SELECT (avg({_A}) + avg({_B})) / 2 FROM pl))"
_SQL_PAIR_LOSSES = {
    "sigmoid": f"-{sql_ls(_BX)} * 0.9 - {sql_ls('-' + _BX)} * 0.1",
    "robust": f"(-{sql_ls(_BX)} * 0.9 + {sql_ls('-' + _BX)} * 0.1) / 0.8",
    "exo_pair": f"{sql_sig(_BX)} * ({sql_ls(_BX)} - ln(0.9)) + {sql_sig('-' + _BX)} * ({sql_ls('-' + _BX)} - ln(0.1))",
    "hinge": f"greatest(1 - {_BX}, 0)",
    "ipo": f"pow({_X} - 1 / (2 * {BETA}), 2)",
    "sppo_hard": f"pow({_A} - 0.5 / {BETA}, 2) + pow({_B} + 0.5 / {BETA}, 2)",
    "nca_pair": f"-{sql_ls(f'{BETA} * {_A}')} - 0.5 * {sql_ls(f'-{BETA} * {_A}')} - 0.5 * {sql_ls(f'-{BETA} * {_B}')}",
    "apo_zero": f"1 - {sql_sig(f'{BETA} * {_A}')} + {sql_sig(f'{BETA} * {_B}')}",
    "apo_down": f"{sql_sig(f'{BETA} * {_A}')} + 1 - {sql_sig(f'{BETA} * ({_A} - {_B})')}",
    "discopop": f"-{sql_ls(_BX)} * (1 - {sql_sig(f'{_BX} / 0.05')}) + exp(-{_BX}) * {sql_sig(f'{_BX} / 0.05')}",
    "bco_pair": f"-{sql_ls(f'{BETA} * {_A} - {_BASE}')} - {sql_ls(f'-({BETA} * {_B} - {_BASE})')}",
    "sft": "-chosen",
}


@query(
    f"WITH {SQL_PAIR_LOGPS} SELECT conv_id, " + ", ".join(f"{sql_num(e)} AS {n}" for n, e in _SQL_PAIR_LOSSES.items()) + " FROM pl"
)
def pair_losses(spark, sf):
    df = pair_logps(spark, sf)
    rewards = [O.implicit_reward(F.col(s), F.col(f"ref_{s}"), BETA) for s in ("chosen", "rejected")]
    baseline = df.agg(((F.avg(rewards[0]) + F.avg(rewards[1])) / 2).alias("b")).scalar()
    loss = lambda n: O.pair_loss(n, *_pair_cols(), beta=BETA, smoothing=0.1, baseline=baseline, nll=-F.col("chosen"))
    return df.select("conv_id", *[num(loss(n)).alias(n) for n in O.PAIR_LOSSES])


# A training step takes 16 conversations, in the order of their ids.
_STEP = 16


@query(
    f"""WITH {SQL_PAIR_LOGPS}, m AS (SELECT conv_id // {_STEP} AS step, {BETA} * (avg({_A}) + avg({_B})) / 2 AS m FROM pl GROUP BY 1),
    b AS (SELECT step, avg(m) OVER (ORDER BY step) AS base FROM m)
    SELECT conv_id, {sql_num('base')} AS baseline, {sql_num(f"-{sql_ls(f'{BETA} * {_A} - base')} - {sql_ls(f'-({BETA} * {_B} - base)')}")} AS loss
    FROM pl JOIN b ON conv_id // {_STEP} = step"""
)
def running_pair_baseline(spark, sf):
    df = pair_logps(spark, sf).withColumn("step", F.floor(F.col("conv_id") / _STEP))
    rewards = [O.implicit_reward(F.col(s), F.col(f"ref_{s}"), BETA) for s in ("chosen", "rejected")]
    baseline = running_baseline(df.withColumn("reward", (rewards[0] + rewards[1]) / 2), "step", "reward")
    df = join_unique(df, baseline, ["step"], "rows", ["baseline"])
    loss = O.pair_loss("bco_pair", *_pair_cols(), beta=BETA, baseline=F.col("baseline"))
    return df.select("conv_id", num(F.col("baseline")).alias("baseline"), num(loss).alias("loss"))


@query(
    f"""WITH {SQL_PAIR_LOGPS}, c AS (SELECT conv_id % 4 AS batch, conv_id, chosen - rejected AS p, ref_chosen - ref_rejected AS q, {_A} AS a, {_B} AS b FROM pl),
    r AS (SELECT batch, row_number() OVER (PARTITION BY batch ORDER BY p, conv_id) AS rp, row_number() OVER (PARTITION BY batch ORDER BY q, conv_id) AS rq,
    row_number() OVER (PARTITION BY batch ORDER BY a, conv_id) AS ra, row_number() OVER (PARTITION BY batch ORDER BY b, conv_id) AS rb, p, q, a, b FROM c)
    SELECT 'aot' AS kind, x.batch, x.rp AS rank, {sql_num(f"-{sql_ls(f'{BETA} * (x.p - y.q)')}")} AS loss FROM r x JOIN r y ON x.batch = y.batch AND x.rp = y.rq
    UNION ALL SELECT 'aot_pair', x.batch, x.ra, {sql_num(f"-{sql_ls(f'{BETA} * (x.a - y.b)')}")} FROM r x JOIN r y ON x.batch = y.batch AND x.ra = y.rb"""
)
def order_statistic_losses(spark, sf):
    df = pair_logps(spark, sf).withColumn("batch", F.col("conv_id") % 4)
    c, r, rc, rr = _pair_cols()
    kinds = {"aot": (c - r, rc - rr), "aot_pair": (c - rc, r - rr)}
    parts = []
    for kind, (first, second) in kinds.items():
        pairs = rank_pairs(df, "batch", first, second, "conv_id")
        loss = O.smoothed(BETA * (F.col("first") - F.col("second")), 0.0)
        parts.append(pairs.select(F.lit(kind).alias("kind"), "batch", "rank", num(loss).alias("loss")))
    return parts[0].unionByName(parts[1])


_ALPHA = f"(exp(least(-0.5 * {_B}, 88.7228)) - exp(least(-0.5 * {_A}, 88.7228))) / 0.5"
_SOFT = lambda x: f"(-{sql_ls('-' + x)})"


@query(
    f"WITH {SQL_PAIR_LOGPS} SELECT conv_id, {sql_num('-' + sql_ls(f'{BETA} * ({_ALPHA})'))} AS alpha, {sql_num('-' + sql_ls(f'{BETA} * ({_X} - ({_SOFT(_A)} - {_SOFT(_B)}))'))} AS js FROM pl"
)
def divergence_variants(spark, sf):
    loss = lambda **k: num(O.pair_loss("sigmoid", *_pair_cols(), beta=BETA, **k))
    return pair_logps(spark, sf).select("conv_id", loss(divergence="alpha", alpha=0.5).alias("alpha"), loss(divergence="js").alias("js"))


@query(
    """WITH d AS (SELECT CAST(floor(event_id / 100) AS BIGINT) AS batch, count(value) AS n, sum(value) AS s, sum(value * value) AS q FROM events GROUP BY 1),
    r AS (SELECT batch, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q FROM d WINDOW w AS (ORDER BY batch))
    SELECT batch, CAST(n AS BIGINT) AS count, round(s / n, 9) AS mean, round(sqrt((q - s * s / n) / (n - 1)), 6) AS std FROM r"""
)
def running_reward_moments(spark, sf):
    events = table(spark, sf, "events", "event_id", "value").withColumn("batch", F.floor(F.col("event_id") / 100))
    out = running_moments(events, "batch", "value")
    return out.select("batch", "count", num(F.col("mean"), 9).alias("mean"), num(F.col("std")).alias("std"))


@query(
    f"""WITH {SQL_TOKEN_ROWS}, e AS (SELECT conv_id, max(turn) AS last, min(turn) AS first FROM tr GROUP BY conv_id HAVING max(turn) > min(turn)),
    s AS (SELECT t.conv_id, t.turn, t.pos, t.policy, t.n, e.last, e.first, min(t.n) OVER (PARTITION BY t.conv_id) AS shared FROM tr t JOIN e ON t.conv_id = e.conv_id AND t.turn IN (e.last, e.first))
    SELECT conv_id, {sql_num('sum(policy * CASE WHEN pos < shared THEN 1.0 ELSE 0.3 END) FILTER (turn = last)', 4)} AS chosen,
    {sql_num('sum(policy * CASE WHEN pos < shared THEN 1.0 ELSE 0.3 END) FILTER (turn = first)', 4)} AS rejected,
    {sql_num('least(exp((avg(policy) FILTER (turn = last)) + (avg(policy) FILTER (turn = first)) + 10), 1.0)')} AS weight FROM s GROUP BY conv_id"""
)
def length_desensitised_logps(spark, sf):
    ends = sequence_rows(spark, sf).groupBy("conv_id").agg(
        F.max_by("policy", "turn").alias("c"), F.min_by("policy", "turn").alias("r"), F.count("*").alias("k")
    ).filter("k > 1")
    shared = F.least(F.size("c"), F.size("r"))
    mean = lambda c: O.array_sum(F.col(c)) / F.size(c)
    return ends.select(
        "conv_id", num(O.length_desensitised(F.col("c"), shared, 0.3), 4).alias("chosen"),
        num(O.length_desensitised(F.col("r"), shared, 0.3), 4).alias("rejected"),
        num(O.pair_confidence(mean("c") + 5, mean("r") + 5)).alias("weight"),
    )


@query(
    f"""WITH {SQL_PAIR_LOGPS} SELECT {sql_num(f'avg({BETA} * {_A})')} AS chosen_reward, {sql_num(f'avg({BETA} * {_B})')} AS rejected_reward, {sql_num(f'avg(CASE WHEN {_A} > {_B} THEN 1.0 ELSE 0.0 END)')} AS accuracy,
    {sql_num(f'avg({BETA} * ({_A} - {_B}))')} AS margin, {sql_num(f"avg(-{sql_ls(_BX)} * 0.8 + pow({_X} - 1 / (2 * {BETA}), 2) * 0.2 - chosen * 1.0)")} AS loss FROM pl"""
)
def implicit_reward_metrics(spark, sf):
    df = pair_logps(spark, sf)
    good, bad = (O.implicit_reward(F.col(s), F.col(f"ref_{s}"), BETA) for s in ("chosen", "rejected"))
    weights = {"sigmoid": 0.8, "ipo": 0.2, "sft": 1.0}
    total = sum((w * O.pair_loss(n, *_pair_cols(), beta=BETA, nll=-F.col("chosen")) for n, w in weights.items()), F.lit(0.0))
    return df.agg(
        num(F.avg(good)).alias("chosen_reward"), num(F.avg(bad)).alias("rejected_reward"), num(share(good > bad)).alias("accuracy"),
        num(F.avg(good - bad)).alias("margin"), num(F.avg(total)).alias("loss"),
    )


# --- unpaired ---------------------------------------------------------------

# Odd turns of a conversation stand for desirable rows; the batch is the conversation modulo 8.
_SQL_UNPAIRED = (
    f"{SQL_SEQ_LOGPS}, u AS (SELECT *, n % 2 = 1 AS label, policy - ref AS x, greatest(avg(old - ref) OVER (PARTITION BY conv_id % 8), 0) AS kl FROM sl)"
)


@query(
    f"""WITH {_SQL_UNPAIRED} SELECT conv_id, turn, {sql_num(f"CASE WHEN label THEN 1.0 * (1 - {sql_sig(f'{BETA} * (x - kl)')}) ELSE 1.3 * (1 - {sql_sig(f'{BETA} * (kl - x)')}) END")} AS kto,
    {sql_num(f"CASE WHEN label THEN 1.0 * (1 - {sql_sig(f'{BETA} * x')}) ELSE 1.3 * {sql_sig(f'{BETA} * x')} END")} AS apo_zero_unpaired FROM u"""
)
def unpaired_losses(spark, sf):
    df = sequence_logps(spark, sf).withColumn("batch", F.col("conv_id") % 8)
    df = with_group_stats(df, ["batch"], {"kl": F.greatest(F.avg(F.col("old") - F.col("ref")), F.lit(0.0))})
    ratio, label = F.col("policy") - F.col("ref"), F.col("n") % 2 == 1
    loss = lambda n: num(O.unpaired_loss(n, label, ratio, F.col("kl"), BETA, 1.0, 1.3)).alias(n)
    return df.select("conv_id", "turn", loss("kto"), loss("apo_zero_unpaired"))


@query(
    f"""WITH {SQL_SEQ_LOGPS}, b AS (SELECT turn AS step, avg({BETA} * (policy - ref)) AS m, count(*) AS n FROM sl GROUP BY turn),
    d AS (SELECT step, sum(m * n) OVER (ORDER BY step) / sum(n) OVER (ORDER BY step) AS delta FROM b),
    u AS (SELECT s.*, d.delta, {BETA} * (policy - ref) AS r, n % 2 = 1 AS label, least(greatest(exp(old) * 300 / (1 - exp(old) * 300 + 1e-8), 0.5), 10.0) AS w FROM sl s JOIN d ON s.turn = d.step)
    SELECT conv_id, turn, {sql_num(f"CASE WHEN label THEN -{sql_ls('r - delta')} ELSE -w * {sql_ls('-(r - delta)')} END")} AS loss, {sql_num('delta')} AS delta FROM u"""
)
def classifier_losses(spark, sf):
    df = sequence_logps(spark, sf).withColumn("r", BETA * (F.col("policy") - F.col("ref")))
    baseline = running_moments(df, "turn", "r").select("turn", F.col("mean").alias("delta"), "rows")
    weight = O.density_ratio_weight(F.exp("old") * 300, 0.5, 10.0)
    loss = O.classifier_loss(F.col("n") % 2 == 1, F.col("r"), F.col("delta"), weight)
    df = join_unique(df, baseline, ["turn"], "rows", ["delta"])
    return df.select("conv_id", "turn", num(loss).alias("loss"), num(F.col("delta")).alias("delta"))


@query()
def fitted_classifier_losses(spark, sf):
    """The classifier objective weighted by the fitted probability of each conversation's prompt vector; 1 without a vector."""
    vectors = table(spark, sf, "embeddings").withColumn("good", F.col("label") < 5)
    sample = D.sample_per_class(vectors, "good", F.xxhash64("vec_id", F.lit(11)), 1024)
    scored = D.density_probability(vectors, D.fit_density(sample, "good", "embedding"), "embedding", "p").select(F.col("vec_id").alias("conv_id"), "p")
    df = sequence_logps(spark, sf).withColumn("r", BETA * (F.col("policy") - F.col("ref"))).join(scored, "conv_id", "left")
    baseline = running_moments(df, "turn", "r").select("turn", F.col("mean").alias("delta"), "rows")
    df = join_unique(df, baseline, ["turn"], "rows", ["delta"]).withColumn("weight", F.coalesce(O.density_ratio_weight(F.col("p"), 0.5, 10.0), F.lit(1.0)))
    loss = O.classifier_loss(F.col("n") % 2 == 1, F.col("r"), F.col("delta"), F.col("weight"))
    return df.select("conv_id", "turn", "p", "weight", "r", "delta", (F.col("n") % 2 == 1).alias("desirable"), loss.alias("loss"))


@query()
def density_classifier(spark, sf):
    df = table(spark, sf, "embeddings").withColumn("good", F.col("label") < 5)
    sample = D.sample_per_class(df, "good", F.xxhash64("vec_id", F.lit(11)), 1024)
    model = D.fit_density(sample, "good", "embedding")
    scored = D.density_probability(df, model, "embedding", "p")
    return D.class_accuracy(scored, "good", "p")


# --- reference-free ---------------------------------------------------------

_F = "(chosen - rejected)"
_FA = "((1 - exp(-0.2 * chosen)) / 0.2 - (1 - exp(-0.2 * rejected)) / 0.2)"


@query(
    f"""WITH {SQL_PAIR_LOGPS} SELECT conv_id, {sql_num('-' + sql_ls(f'{BETA} * ({_F} - 0.5 / {BETA})'))} AS simpo, {sql_num(f"-{sql_ls(f'{BETA} * {_F}')} * 0.9 - {sql_ls(f'-{BETA} * {_F}')} * 0.1")} AS sigmoid,
    {sql_num(f'greatest(1 - {BETA} * {_F}, 0)')} AS hinge, {sql_num(f'pow({_F} - 1 / (2 * {BETA}), 2)')} AS ipo, {sql_num('-' + sql_ls(f'{BETA} * {_FA}'))} AS alpha FROM pl"""
)
def reference_free_losses(spark, sf):
    c, r = F.col("chosen"), F.col("rejected")
    loss = lambda n, **k: num(O.free_pair_loss(n, c, r, BETA, **k))
    return pair_logps(spark, sf).select(
        "conv_id", loss("simpo", gamma=0.5).alias("simpo"), loss("sigmoid", smoothing=0.1).alias("sigmoid"), loss("hinge").alias("hinge"),
        loss("ipo").alias("ipo"), loss("sigmoid", alpha=0.2).alias("alpha"),
    )


_ODDS = "((chosen - rejected) - (ln(1 - exp(chosen)) - ln(1 - exp(rejected))))"


@query(
    f"WITH {SQL_PAIR_LOGPS} SELECT conv_id, {sql_num(_ODDS)} AS log_odds, {sql_num(f'{BETA} * {sql_ls(_ODDS)}')} AS term, {sql_num(f'-chosen - {BETA} * {sql_ls(_ODDS)}')} AS loss FROM pl"
)
def odds_ratio_losses(spark, sf):
    c, r = F.col("chosen"), F.col("rejected")
    term = O.odds_ratio_term(c, r, BETA)
    return pair_logps(spark, sf).select("conv_id", num(O.log_odds(c, r)).alias("log_odds"), num(term).alias("term"), num(-c - term).alias("loss"))


@query(
    f"""WITH {SQL_PAIR_LOGPS} SELECT {sql_num(f"avg(-{sql_ls('chosen - rejected - 0.1')} + 0.01 * pow(chosen + rejected, 2))")} AS loss, {sql_num('least(min(chosen), min(rejected))')} AS min_reward,
    {sql_num('(avg(chosen) + avg(rejected)) / 2')} AS mean_reward, {sql_num('greatest(max(chosen), max(rejected))')} AS max_reward,
    {sql_num('avg(CASE WHEN chosen > rejected THEN 1.0 ELSE 0.0 END)')} AS accuracy, {sql_num('avg(chosen - rejected)')} AS margin FROM pl"""
)
def reward_model_metrics(spark, sf):
    c, r = F.col("chosen"), F.col("rejected")
    return pair_logps(spark, sf).agg(
        num(F.avg(O.reward_model_loss(c, r, F.lit(0.1), 0.01))).alias("loss"),
        num(F.least(F.min(c), F.min(r))).alias("min_reward"),
        num((F.avg(c) + F.avg(r)) / 2).alias("mean_reward"),
        num(F.greatest(F.max(c), F.max(r))).alias("max_reward"),
        num(share(c > r)).alias("accuracy"),
        num(F.avg(c - r)).alias("margin"),
    )


# --- scores, two sources, tokens --------------------------------------------


@query(
    """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    z AS (SELECT vec_id, max(x) + ln(sum(exp(x - m))) AS z FROM (SELECT *, max(x) OVER (PARTITION BY vec_id) AS m FROM e) GROUP BY vec_id)
    SELECT vec_id, """
    + f"{sql_num('max(x - z) FILTER (i = label + 1)')} AS selected, {sql_num('-sum(exp(x - z) * (x - z))')} AS entropy "
    + "FROM e JOIN z USING (vec_id) JOIN (SELECT vec_id, label FROM embeddings) USING (vec_id) GROUP BY vec_id"
)
def log_softmax_and_entropy(spark, sf):
    scores = F.col("embedding").cast("array<double>")
    df = table(spark, sf, "embeddings").withColumn("s", scores)
    return df.select(
        "vec_id", num(F.get(O.log_softmax(F.col("s")), F.col("label"))).alias("selected"), num(O.entropy(F.col("s"))).alias("entropy")
    )


_M, _R = "(chosen - ref_chosen)", "(rejected - ref_rejected)"
_LOGITS = f"(CASE WHEN conv_id % 2 = 0 THEN {_M} - {_R} ELSE {_R} - {_M} END)"


@query(
    f"WITH {SQL_PAIR_LOGPS} SELECT conv_id, {sql_num('-' + sql_ls(f'{BETA} * {_LOGITS}'))} AS pair_loss, {sql_num(f'pow({_LOGITS} - 1 / (2 * {BETA}), 2)')} AS ipo_loss, {sql_num('0.01 * rejected')} AS bonus FROM pl"
)
def exploratory_losses(spark, sf):
    # The chosen side stands for the model's own data, the rejected one for the reference's.
    m, r, rm, rr = _pair_cols()
    won = F.col("conv_id") % 2 == 0
    pair, bonus = O.exploratory_losses(won, m, r, rm, rr, BETA, 0.01)
    ipo, _ = O.exploratory_losses(won, m, r, rm, rr, BETA, 0.01, "ipo")
    return pair_logps(spark, sf).select("conv_id", num(pair).alias("pair_loss"), num(ipo).alias("ipo_loss"), num(bonus).alias("bonus"))


@query(
    f"WITH {SQL_TOKEN_ROWS} SELECT conv_id, turn, {sql_num('0.1 * sum((policy - ref) * policy) - ((conv_id % 10) / 10.0 - 0.5) * sum(policy)')} AS loss FROM tr GROUP BY conv_id, turn"
)
def game_value_losses(spark, sf):
    p = (F.col("conv_id") % 10) / 10.0
    return sequence_rows(spark, sf).select("conv_id", "turn", num(O.game_loss(p, F.col("policy"), F.col("ref"), 0.1)).alias("loss"))


@query(
    f"""WITH {SQL_TOKEN_ROWS}, v AS (SELECT mask, greatest(pow(ref / 5 - policy / 4, 2), pow(least(greatest(ref / 5, old / 5 - 0.2), old / 5 + 0.2) - policy / 4, 2)) AS vf,
    greatest(-a * exp(policy - old), -a * least(greatest(exp(policy - old), 0.8), 1.2)) AS pg FROM tr)
    SELECT {sql_num('0.5 * sum(vf * mask) / sum(mask)')} AS value_loss, {sql_num('sum(pg * mask) / sum(mask)')} AS policy_loss FROM v"""
)
def clipped_losses(spark, sf):
    scaled = lambda c, by: F.transform(c, lambda x: x / by)
    rows = sequence_rows(spark, sf).withColumns({"v": scaled("ref", 5), "ov": scaled("old", 5), "ret": scaled("policy", 4)})
    rows = rows.withColumn("adv", F.array_repeat(F.col("advantage"), F.size("policy")))
    value = O.clipped_value_loss(F.col("v"), F.col("ov"), F.col("ret"), 0.2)
    policy = O.clipped_policy_loss(F.col("policy"), F.col("old"), F.col("adv"), 0.2)
    tokens = F.sum(O.array_sum(F.col("mask").cast("array<double>")))
    mean = lambda x: F.sum(O.array_dot(x, F.col("mask"))) / tokens
    return rows.agg(num(0.5 * mean(value)).alias("value_loss"), num(mean(policy)).alias("policy_loss"))


@query(
    f"""WITH {SQL_TOKEN_ROWS}, k AS (SELECT conv_id, turn, n, least(greatest(exp(old - policy) - (old - policy) - 1, 0.0), 0.2) AS k, policy, ref FROM tr)
    SELECT conv_id, turn, {sql_num('sum(k)')} AS perception_kl, {sql_num('0.03 * -sum(policy) / max(n) + 0.02 * -sum(ref) / max(n)')} AS entropy_terms FROM k GROUP BY conv_id, turn"""
)
def perception_terms(spark, sf):
    kl = O.perception_kl(F.col("policy"), F.col("old"))
    mean = lambda c: -O.array_sum(F.col(c)) / F.size(c)
    return sequence_rows(spark, sf).select(
        "conv_id", "turn", num(O.array_sum(kl)).alias("perception_kl"), num(0.03 * mean("policy") + 0.02 * mean("ref")).alias("entropy_terms")
    )


@query(f"WITH {SQL_TOKEN_ROWS} SELECT {sql_num('sum(-exp(policy) * policy * mask) / sum(mask)')} AS loss FROM tr")
def probability_weighted_loss(spark, sf):
    rows = sequence_rows(spark, sf)
    total = F.sum(O.weighted_token_loss(F.col("policy"), F.col("mask")))
    return rows.agg(num(total / F.sum(O.array_sum(F.col("mask").cast("array<double>")))).alias("loss"))

