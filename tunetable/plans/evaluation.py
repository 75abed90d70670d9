"""Metric roll-ups, evaluation tables, samples and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunetable import udf
from tunetable.functions import objectives as O
from tunetable.functions.tokens import n_words, token_id
from tunetable.operators import metrics as E
from tunetable.operators import sampling as S
from tunetable.operators.align import pair_models
from tunetable.plans.inputs import (
    SQL_ORDER_ROLLOUTS,
    SQL_PAIR_LOGPS,
    SQL_ROLLOUTS,
    SQL_SEQ_LOGPS,
    SQL_STEPWISE,
    SQL_TEXT_PAIRS,
    SQL_TOKEN_ROWS,
    SQL_TURN_TOKENS,
    conversations,
    documents,
    num,
    order_rollouts,
    pair_logps,
    rollouts,
    sequence_logps,
    sequence_rows,
    sql_num,
    sql_words,
    stepwise,
    text_pairs,
    turn_tokens,
)
from tunetable.plans.registry import query
from tunetable.session import settle
from tunetable.sources.scan import table

END = token_id(".")


@query(
    f"""WITH {SQL_TURN_TOKENS}, l AS (SELECT group_id % 3 AS part, len(completion_ids) AS n, coalesce(completion_ids[-1] = {END}, false) AS done FROM tt)
    SELECT part, {sql_num('avg(n)')} AS mean_length, min(n)::DOUBLE AS min_length, max(n)::DOUBLE AS max_length, {sql_num('avg(CASE WHEN done THEN 0.0 ELSE 1.0 END)')} AS clipped_ratio,
    {sql_num('coalesce(avg(n) FILTER (done), 0)')} AS mean_terminated_length, coalesce(min(n) FILTER (done), 0)::DOUBLE AS min_terminated_length, coalesce(max(n) FILTER (done), 0)::DOUBLE AS max_terminated_length FROM l GROUP BY part"""
)
def length_metrics(spark, sf):
    df = turn_tokens(spark, sf).withColumn("part", F.col("group_id") % 3)
    out = E.length_metrics(df, "completion_ids", [END], ["part"])
    return out.select("part", *[num(F.col(c)).alias(c) for c in out.columns if c != "part"])


@query("SELECT round(sum(len(string_split(props, ':')) - 1) / count(*), 6) AS call_frequency, round(count(*) FILTER (event_type = 'error') / sum(len(string_split(props, ':')) - 1), 6) AS failure_frequency FROM events")
def tool_metrics(spark, sf):
    calls = F.regexp_count("props", F.lit(":"))
    out = E.tool_metrics(table(spark, sf, "events"), calls, F.when(F.col("event_type") == "error", 1).otherwise(0))
    return out.select(num(F.col("call_frequency")).alias("call_frequency"), num(F.col("failure_frequency")).alias("failure_frequency"))


_STATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


@query(
    f"WITH {SQL_ORDER_ROLLOUTS} SELECT "
    + ", ".join(f"{sql_num(f'{f}({r})')} AS {r}_{k}" for r in ("r_discount", "r_tax") for k, f in _STATS.items())
    + " FROM orr"
)
def reward_statistics(spark, sf):
    out = E.reward_metrics(order_rollouts(spark, sf), ["r_discount", "r_tax"])
    return out.select(*[num(F.col(c)).alias(c) for c in out.columns])


@query(
    f"""WITH {SQL_ORDER_ROLLOUTS}, g AS (SELECT reward, coalesce(stddev_samp(reward) OVER (PARTITION BY group_id), 0.0) AS s FROM orr)
    SELECT {sql_num('avg(reward)')} AS reward, {sql_num('avg(s)')} AS reward_std, {sql_num('avg(CASE WHEN s < 1e-8 THEN 1.0 ELSE 0.0 END)')} AS frac_zero_std FROM g"""
)
def zero_variance_fraction(spark, sf):
    out = E.zero_std_fraction(order_rollouts(spark, sf), ["group_id"], "reward")
    return out.select(*[num(F.col(c)).alias(c) for c in out.columns])


def _metric_rows(spark, sf):
    """Events as logged metrics: the date is the step, one user in five is an evaluation run."""
    mode = F.when(F.col("user_id") % 5 == 0, "eval").otherwise("train")
    return table(spark, sf, "events").select(
        F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).alias("step"), mode.alias("mode"), F.col("event_type").alias("name"), "value"
    )


@query(
    f"""WITH m AS (SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS step, CASE WHEN user_id % 5 = 0 THEN 'eval' ELSE 'train' END AS mode, event_type AS name, value FROM events)
    SELECT step, mode, CASE WHEN mode = 'eval' THEN 'eval_' || name ELSE name END AS name, {sql_num('avg(value)', 9)} AS value FROM m GROUP BY ALL"""
)
def metric_roll_up(spark, sf):
    return E.roll_up(_metric_rows(spark, sf)).withColumn("value", num(F.col("value"), 9))


@query(
    f"""WITH {SQL_SEQ_LOGPS}, u AS (SELECT conv_id % 4 AS step, n % 2 = 1 AS good, 2.0 * (policy - ref) AS r, policy FROM sl),
    s AS (SELECT step, avg(r) FILTER (good) AS rc, avg(r) FILTER (NOT good) AS rr, avg(policy) FILTER (good) AS lc, avg(policy) FILTER (NOT good) AS lr FROM u GROUP BY step)
    SELECT step, {sql_num('rc')} AS rewards_chosen, {sql_num('rr')} AS rewards_rejected, {sql_num('lc')} AS logps_chosen, {sql_num('lr')} AS logps_rejected, {sql_num('rc - rr')} AS rewards_margins FROM s"""
)
def class_split_metrics(spark, sf):
    df = sequence_logps(spark, sf).withColumn("step", F.col("conv_id") % 4)
    out = E.class_split(df, ["step"], F.col("n") % 2 == 1, {"rewards": 2.0 * (F.col("policy") - F.col("ref")), "logps": F.col("policy")})
    return out.select("step", *[num(F.col(c)).alias(c) for c in out.columns if c != "step"])


@query(
    f"""WITH {SQL_TOKEN_ROWS} SELECT CAST(sum(CASE WHEN mask = 1 AND policy > ref THEN 1 ELSE 0 END) AS BIGINT) AS correct, CAST(sum(mask) AS BIGINT) AS total,
    {sql_num('sum(CASE WHEN mask = 1 AND policy > ref THEN 1 ELSE 0 END) / sum(mask)')} AS accuracy FROM tr"""
)
def token_accuracy(spark, sf):
    # A prediction counts as right where the policy is surer than the reference.
    rows = sequence_rows(spark, sf)
    predicted = F.zip_with("policy", "ref", lambda p, r: F.when(p > r, 1).otherwise(0))
    labels = F.transform("mask", lambda m: F.when(m == 1, 1).otherwise(-100))
    out = E.token_accuracy(rows.select(predicted.alias("p"), labels.alias("l")), "p", "l")
    return out.withColumn("accuracy", num(F.col("accuracy")))


@query(
    f"""WITH {SQL_STEPWISE}, s AS (SELECT unnest(completions) AS c, unnest(labels) AS l FROM stepwise)
    SELECT 'steps' AS kind, count(*) AS n, {sql_num('avg(CASE WHEN (length(c) % 2 = 0) = l THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM s
    UNION ALL SELECT 'pairs', (SELECT count(*) FROM (WITH {SQL_TEXT_PAIRS} SELECT * FROM tpairs WHERE length(chosen) // 100 <> length(rejected) // 100)),
    (WITH {SQL_TEXT_PAIRS} SELECT {sql_num('avg(CASE WHEN length(chosen) // 100 > length(rejected) // 100 THEN 1.0 ELSE 0.0 END)')} FROM tpairs WHERE length(chosen) // 100 <> length(rejected) // 100)"""
)
def stepwise_accuracy(spark, sf):
    df = stepwise(spark, sf)
    predicted = F.transform("completions", lambda c: F.when(F.length(c) % 2 == 0, 1).otherwise(0))
    labels = F.transform("labels", lambda x: x.cast("int"))
    steps = E.token_accuracy(df.select(predicted.alias("p"), labels.alias("l")), "p", "l")
    hundreds = lambda c: F.floor(F.length(c) / 100).alias(c)
    pairs = E.pair_accuracy(text_pairs(spark, sf).select(hundreds("chosen"), hundreds("rejected")), "chosen", "rejected")
    return steps.select(F.lit("steps").alias("kind"), F.col("total").alias("n"), num(F.col("accuracy")).alias("accuracy")).unionByName(
        pairs.select(F.lit("pairs").alias("kind"), "n", num(F.col("accuracy")).alias("accuracy"))
    )


@query(
    f"WITH t AS (SELECT turn AS step, CAST(sum(len({sql_words('text')})) AS BIGINT) AS tokens FROM conversations GROUP BY turn) SELECT step, tokens, CAST(sum(tokens) OVER (ORDER BY step) AS BIGINT) AS num_tokens FROM t"
)
def running_token_count(spark, sf):
    return E.running_token_count(conversations(spark, sf).withColumnRenamed("turn", "step"), "step", n_words(F.col("text")).cast("long"))


_SQL_MODELS = (
    f"{SQL_TEXT_PAIRS}, w AS (SELECT conv_id, prompt, rejected AS reference, chosen AS policy, CASE WHEN length(chosen) % 7 = 0 THEN -1 WHEN length(chosen) > length(rejected) THEN 1 ELSE 0 END AS winner, "
    "1.0 / (1.0 + exp((length(rejected) - length(chosen)) / 500.0)) AS p FROM tpairs)"
)


def _judged(spark, sf):
    """Two models' completions by prompt with a verdict; some judgements fail."""
    pairs = text_pairs(spark, sf)
    asked, answered = F.struct("prompt", F.col("rejected").alias("text")), F.struct(F.col("chosen").alias("text"))
    both = pair_models(pairs.select("conv_id", asked.alias("c")), pairs.select("conv_id", answered.alias("c")), "conv_id", "c", ("first", "second"))
    df = both.select("conv_id", "first.prompt", F.col("first.text").alias("reference"), F.col("second.text").alias("policy"))
    n, m = F.length("policy"), F.length("reference")
    winner = F.when(n % 7 == 0, -1).when(n > m, 1).otherwise(0)
    return df.withColumn("winner", winner).withColumn("p", 1.0 / (1.0 + F.exp((m - n) / 500.0)))


@query(
    f"WITH {_SQL_MODELS} SELECT {sql_num('avg(CASE WHEN winner = 1 THEN 1.0 ELSE 0.0 END)')} AS win_rate, {sql_num('avg(CASE WHEN winner = 1 THEN 1.0 ELSE 0.0 END) FILTER (winner <> -1)')} AS valid_win_rate, {sql_num('avg(p)')} AS mean_win_probability FROM w"
)
def win_rates(spark, sf):
    out = E.win_rates(_judged(spark, sf), "winner", "p")
    return out.select(*[num(F.col(c)).alias(c) for c in out.columns])


@query(f"WITH {_SQL_MODELS} SELECT 100 AS step, prompt, reference, policy, winner FROM w")
def win_rate_table(spark, sf):
    return E.win_rate_table(_judged(spark, sf), 100)


@query(f"WITH {_SQL_MODELS} SELECT conv_id, reference, policy FROM w")
def model_pairs(spark, sf):
    pairs = text_pairs(spark, sf)
    first = pairs.select("conv_id", F.col("rejected").alias("text"))
    second = pairs.select("conv_id", F.col("chosen").alias("text"))
    return pair_models(first, second, "conv_id", "text", ("reference", "policy"))


@query(f"WITH {SQL_TEXT_PAIRS}, s AS (SELECT * FROM tpairs ORDER BY (conv_id * 7919 + 13) % 10007, conv_id LIMIT 16) SELECT prompt, chosen AS policy, rejected AS reference FROM s")
def game_log(spark, sf):
    df = text_pairs(spark, sf)
    df = S.sample_rows(df, 16, F.pmod(F.col("conv_id") * 7919 + 13, F.lit(10007)), "conv_id")
    df = df.select("prompt", F.concat("prompt", "chosen").alias("p"), F.concat("prompt", "rejected").alias("r"))
    return E.game_log(df, "prompt", "p", "r")


@query(
    f"""WITH {SQL_ROLLOUTS} SELECT count(*) AS total_predictions, count(*) FILTER (length(prompt) > 50) AS successful_predictions,
    {sql_num('avg(length(completion)) FILTER (length(prompt) > 50)')} AS avg_chars, {sql_num('avg(100.0 / nullif(length(completion) % 3, 0)) FILTER (length(prompt) > 50)')} AS avg_odd FROM rollouts"""
)
def scorer_summary(spark, sf):
    scorers = {
        "chars": lambda p, c: F.length(c).cast("double"),
        "odd": lambda p, c: F.try_divide(F.lit(100.0), (F.length(c) % 3).cast("double")),
    }
    df = udf.apply_scorers(rollouts(spark, sf), scorers, "prompt", "completion")
    out = E.scorer_summary(df, F.length("prompt") <= 50, {n: F.col(f"scores.{n}") for n in scorers})
    return out.select("total_predictions", "successful_predictions", num(F.col("avg_chars")).alias("avg_chars"), num(F.col("avg_odd")).alias("avg_odd"))


@query(
    f"""WITH {SQL_TOKEN_ROWS} SELECT {sql_num('avg(abs(policy - old))')} AS gap_mean, {sql_num('max(abs(policy - old))')} AS gap_max, {sql_num('min(least(exp(policy - old), 2.0))')} AS ratio_min,
    {sql_num('avg(least(exp(policy - old), 2.0))')} AS ratio_mean, {sql_num('max(least(exp(policy - old), 2.0))')} AS ratio_max FROM tr WHERE mask = 1"""
)
def sampler_divergence(spark, sf):
    out = E.divergence_metrics(sequence_rows(spark, sf), "policy", "old", "mask", 2.0)
    return out.select(*[num(F.col(c)).alias(c) for c in out.columns])


_BETA = 2.0


@query(
    f"""WITH {SQL_TOKEN_ROWS}, s AS (SELECT conv_id, turn, sum(policy) AS p, sum(ref) AS r, max(a) AS a FROM tr GROUP BY conv_id, turn)
    SELECT {sql_num('avg(p - r)')} AS kl, {sql_num('avg(-0.05 * (p - r))')} AS non_score_reward, {sql_num('avg(a - 0.05 * (p - r))')} AS rlhf_reward, {sql_num('avg(-p)')} AS entropy, {sql_num('avg(a)')} AS scores,
    {sql_num('(SELECT avg(x - y) FROM (SELECT arg_max(a, turn) AS x, arg_min(a, turn) AS y FROM s GROUP BY conv_id HAVING count(*) > 1))')} AS scores_margin FROM s"""
)
def policy_statistics(spark, sf):
    rows = sequence_rows(spark, sf).select(
        "conv_id", "turn", O.array_sum(F.col("policy")).alias("p"), O.array_sum(F.col("ref")).alias("r"), "advantage"
    )
    rows = settle(rows)
    kl = F.col("p") - F.col("r")
    gap = F.max_by("advantage", "turn") - F.min_by("advantage", "turn")
    margins = rows.groupBy("conv_id").agg(gap.alias("gap"), F.count("*").alias("k")).filter("k > 1")
    return rows.agg(
        num(F.avg(kl)).alias("kl"), num(F.avg(-0.05 * kl)).alias("non_score_reward"),
        num(F.avg(F.col("advantage") - 0.05 * kl)).alias("rlhf_reward"), num(F.avg(-F.col("p"))).alias("entropy"),
        num(F.avg("advantage")).alias("scores"),
    ).withColumn("scores_margin", num(margins.agg(F.avg("gap")).scalar()))


@query(
    f"""WITH {SQL_PAIR_LOGPS}, r AS (SELECT *, {_BETA} * (chosen - ref_chosen) AS g, {_BETA} * (rejected - ref_rejected) AS b FROM pl)
    SELECT {sql_num('avg(((chosen - ref_chosen) + (rejected - ref_rejected)) / 2)')} AS kl, {sql_num('-(avg(chosen) + avg(rejected)) / 2')} AS entropy, {sql_num('avg(chosen) + avg(ref_chosen)')} AS logps_chosen,
    {sql_num('avg(rejected) + avg(ref_rejected)')} AS logps_rejected, {sql_num('avg(g)')} AS rewards_chosen, {sql_num('avg(b)')} AS rewards_rejected, {sql_num('avg(g - b)')} AS margins, {sql_num('avg(CASE WHEN g - b > 0 THEN 1.0 ELSE 0.0 END)')} AS accuracies,
    (WITH {SQL_TEXT_PAIRS} SELECT {sql_num("avg(CASE WHEN ends_with(chosen, '.') THEN 1.0 ELSE 0.0 END)")} FROM tpairs) AS model_ends,
    (WITH {SQL_TEXT_PAIRS} SELECT {sql_num("avg(CASE WHEN contains(rejected, 'tion.') THEN 1.0 ELSE 0.0 END)")} FROM tpairs) AS ref_ends FROM r"""
)
def two_source_statistics(spark, sf):
    # The chosen side stands for the model's own data, the rejected one for the reference's.
    c, r, rc, rr = (F.col(x) for x in ("chosen", "rejected", "ref_chosen", "ref_rejected"))
    good, bad = _BETA * (c - rc), _BETA * (r - rr)
    stats = {
        "kl": F.avg(((c - rc) + (r - rr)) / 2), "entropy": -(F.avg(c) + F.avg(r)) / 2, "logps_chosen": F.avg(c) + F.avg(rc),
        "logps_rejected": F.avg(r) + F.avg(rr), "rewards_chosen": F.avg(good), "rewards_rejected": F.avg(bad),
        "margins": F.avg(good - bad), "accuracies": E.share(good - bad > 0),
    }
    out = pair_logps(spark, sf).agg(*[num(x).alias(n) for n, x in stats.items()])
    ends = text_pairs(spark, sf).agg(
        F.struct(E.share(F.endswith("chosen", F.lit("."))).alias("m"), E.share(F.contains("rejected", F.lit("tion."))).alias("r")).alias("e")
    ).scalar()
    return out.withColumns({"model_ends": num(ends.m), "ref_ends": num(ends.r)})


# --- distinct, samples, orders ----------------------------------------------


@query("SELECT source, doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def first_per_source(spark, sf):
    return S.first_per(documents(spark, sf, "source", "doc_id", "lang"), ["source"], "doc_id")


@query("SELECT doc_id, lang FROM documents ORDER BY (doc_id * 7919 + 13) % 10007, doc_id LIMIT 25")
def sampled_rows(spark, sf):
    return S.sample_rows(documents(spark, sf, "doc_id", "lang"), 25, F.pmod(F.col("doc_id") * 7919 + 13, F.lit(10007)), "doc_id")


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def first_rows(spark, sf):
    return S.first_rows(documents(spark, sf, "doc_id", "lang"), 100, "doc_id")


@query("SELECT doc_id, lang, source, text FROM documents")
def shuffled_rows(spark, sf):
    return S.shuffled(documents(spark, sf), 7, "doc_id").select("doc_id", "lang", "source", "text")


@query(
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY (doc_id * 7919 + 13) % 10007, doc_id) - 1 AS k, count(*) OVER () AS n FROM documents),
    c AS (SELECT doc_id, k, k // 16 AS chunk FROM r WHERE k < (n // 16) * 16)
    SELECT doc_id, CAST(chunk AS BIGINT) AS chunk, CAST(((chunk * 2 + rep) * 16 + k % 16) * 3 + mini AS BIGINT) AS position
    FROM c, (SELECT unnest(range(2)) AS rep), (SELECT unnest(range(3)) AS mini)"""
)
def repeat_sampler(spark, sf):
    df = documents(spark, sf, "doc_id").withColumn("_o", F.pmod(F.col("doc_id") * 7919 + 13, F.lit(10007)))
    return S.repeat_sampler(df, ["_o", "doc_id"], 16, 3, 2).select("doc_id", "chunk", "position")


@query(
    "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 64 AS BIGINT) AS equal_chunk, CAST(ntile(7) OVER (ORDER BY doc_id) - 1 AS INTEGER) AS even_chunk FROM documents"
)
def chunked_rows(spark, sf):
    ids = documents(spark, sf, "doc_id")
    equal = S.equal_chunks(ids, ["doc_id"], 64).withColumnRenamed("chunk", "equal_chunk")
    even = S.even_chunks(ids, ["doc_id"], 7).withColumnRenamed("chunk", "even_chunk")
    return equal.join(even, "doc_id")


@query("SELECT event_id, CASE WHEN value < 100 THEN round(ln(value), 6) + 0.0 END AS logp FROM events")
def nan_log_probs_dropped(spark, sf):
    logp = F.when(F.col("value") < 100, F.log("value")).otherwise(F.lit(float("nan")))
    return table(spark, sf, "events").select("event_id", F.round(S.nan_to_null(logp), 6).alias("logp"))
