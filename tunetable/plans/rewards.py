"""Row rewards and judges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunetable import udf
from tunetable.functions import rewards as R
from tunetable.functions.tokens import n_words, token_id
from tunetable.operators.align import fill_tail
from tunetable.operators.skew import join_unique, with_group_stats
from tunetable.operators.vocab import build_vocabulary, tokens_of
from tunetable.plans.inputs import (
    SQL_HALVES,
    SQL_MESSAGES,
    SQL_PAIR_LOGPS,
    SQL_ROLLOUTS,
    SQL_TURN_TOKENS,
    documents,
    half_distributions,
    message_table,
    num,
    pair_logps,
    rollouts,
    sql_num,
    sql_words,
    turn_tokens,
)
from tunetable.plans.registry import query
from tunetable.session import settle
from tunetable.sources.scan import table

_KIND = "length(completion) % 5"


def _case(parts: list[str]) -> str:
    return "CASE " + _KIND + " " + " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(parts)) + " END"


def _wrapped(df, parts):
    """Completions wrapped in one of several shapes, by their length."""
    kind = F.length("completion") % len(parts)
    out = F.lit(None)
    for i, p in enumerate(parts):
        out = F.when(kind == i, F.concat(*[F.col(x[1:]) if x.startswith("$") else F.lit(x) for x in p])).otherwise(out)
    return df.withColumn("t", out)


_THINK_SHAPES = [
    ("<think>", "$prompt", "</think>", "$completion"),
    ("<think>", "$prompt", "$completion"),
    ("$prompt", "<think>", "$prompt", "</think>"),
    ("<think>", "$prompt", "<think>", "$prompt", "</think>"),
    ("$completion",),
]


def _sql_shapes(shapes) -> str:
    part = lambda x: x[1:] if x.startswith("$") else "'" + x.replace("\n", "' || chr(10) || '") + "'"
    return _case([" || ".join(part(x) for x in s) for s in shapes])


@query(
    f"""WITH {SQL_ROLLOUTS}, t AS (SELECT group_id, idx, {_sql_shapes(_THINK_SHAPES)} AS t FROM rollouts)
    SELECT group_id, idx, CASE WHEN starts_with(t, '<think>') AND len(string_split(t, '<think>')) = 2 AND contains(t, '</think>') THEN 1.0 ELSE 0.0 END::DOUBLE AS reward FROM t"""
)
def think_format_reward(spark, sf):
    df = _wrapped(rollouts(spark, sf), _THINK_SHAPES)
    return df.select("group_id", "idx", R.think_format(F.col("t")).alias("reward"))


_ANSWER_SHAPES = [
    ("<think>", "x", "</think><answer>", "y", "</answer>"),
    ("<think>\n", "$prompt", "\n</think>\n<answer>\n", "$completion", "\n</answer>"),
    ("<think>", "$prompt", "</think> so <answer>", "$completion", "</answer> done"),
    ("<think>", "$prompt", "</think>"),
    ("$completion",),
]


@query(
    rf"""WITH {SQL_ROLLOUTS}, t AS (SELECT group_id, idx, {_sql_shapes(_ANSWER_SHAPES)} AS t FROM rollouts)
    SELECT group_id, idx, regexp_matches(t, '^<think>.*?</think><answer>.*?</answer>$')::INTEGER::DOUBLE AS strict,
    regexp_matches(t, '(?s)^<think>\n.*?\n</think>\n<answer>\n.*?\n</answer>(?:$|\n)')::INTEGER::DOUBLE AS lines,
    regexp_matches(t, '(?s)^<think>.*?</think>.*?<answer>.*?</answer>')::INTEGER::DOUBLE AS loose FROM t"""
)
def answer_format_rewards(spark, sf):
    df = _wrapped(rollouts(spark, sf), _ANSWER_SHAPES)
    t = F.col("t")
    return df.select(
        "group_id", "idx", R.matches(t, R.THINK_ANSWER).alias("strict"), R.matches(t, R.THINK_ANSWER_LINES).alias("lines"),
        R.matches(t, R.THINK_ANSWER_LOOSE).alias("loose"),
    )


@query(
    f"""WITH {SQL_TURN_TOKENS}, n AS (SELECT group_id, idx, len(completion_ids) AS n FROM tt)
    SELECT group_id, idx, {sql_num('CASE WHEN n <= 150 THEN 0.0 WHEN n <= 250 THEN (150 - n) / 100.0 ELSE -1.0 END')} AS reward FROM n"""
)
def overlong_reward(spark, sf):
    return turn_tokens(spark, sf).select("group_id", "idx", num(R.overlong_penalty(F.size("completion_ids"), 250, 100)).alias("reward"))


# Answers: half the completion's word count in a box, in a notation by row; the gold answer is right, wrong or has no value
# by turn, in another notation. The twin compares the numbers that were written, not their texts.
def _notations(n):
    """``n`` halves, written six ways."""
    say = lambda c: c.cast("string")
    return F.array(
        F.concat(F.lit("\\frac{"), say(n), F.lit("}{2}")),
        F.concat(say(n), F.lit("/2")),
        F.concat(say(F.floor(n / 2)), F.lit("."), say(n % 2 * 5)),
        F.concat(say(n * 50), F.lit("\\%")),
        F.concat(F.lit(" \\dfrac{"), say(n * 3), F.lit("}{6} ")),
        F.concat(say(n), F.lit(".0/2.00")),
    )


def _boxed(df):
    n = n_words(F.col("completion")).cast("long")
    asked = F.when(F.col("idx") % 4 == 3, n + 1).otherwise(n)
    pick = lambda forms, by: F.get(forms, F.pmod(by, F.lit(6)).cast("int"))
    gold = F.when(F.col("idx") % 2 == 1, F.concat(F.lit("$"), pick(_notations(asked), F.col("idx") + F.col("group_id")), F.lit("$"))).otherwise("No number at all.")
    box = F.concat("completion", F.lit(" \\boxed{"), pick(_notations(n), n), F.lit("}."))
    return df.withColumn("boxed", box).withColumn("gold", gold)


_SQL_RIGHT = "CASE WHEN idx % 2 = 1 THEN CASE WHEN n = asked THEN 1.0 ELSE 0.0 END END::DOUBLE"
_SQL_BOXED = f"""{SQL_ROLLOUTS}, bx AS (SELECT *, CASE WHEN idx % 4 = 3 THEN n + 1 ELSE n END AS asked FROM (SELECT *, len({sql_words('completion')}) AS n FROM rollouts))"""


@query(f"WITH {_SQL_BOXED} SELECT group_id, idx, {_SQL_RIGHT} AS reward FROM bx")
def accuracy_reward(spark, sf):
    return _boxed(rollouts(spark, sf)).select("group_id", "idx", R.answer_accuracy(F.col("boxed"), F.col("gold")).alias("reward"))


@query(
    f"""WITH {_SQL_BOXED}, t AS (SELECT *, length(completion) % 3 <> 0 OR contains(completion, '</think>') AS ended FROM bx)
    SELECT group_id, idx, CASE WHEN NOT ended THEN 0.0::DOUBLE ELSE {_SQL_RIGHT} END AS reward FROM t"""
)
def reasoning_reward(spark, sf):
    df = _boxed(rollouts(spark, sf))
    t = F.when(F.length("completion") % 3 == 0, F.col("boxed")).otherwise(F.concat("gold", F.lit("</think>"), "boxed"))
    return df.select("group_id", "idx", R.reasoning_accuracy(t, F.col("gold"), ["</reasoning>", "</think>"]).alias("reward"))


@query(
    f"SELECT doc_id, CAST(len({sql_words('text')}) AS INTEGER) AS tokens, CAST(length(text) AS INTEGER) AS chars, CAST(len(list_distinct(string_split(text, ''))) AS INTEGER) AS distinct_chars FROM documents"
)
def simple_text_rewards(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", n_words(t).alias("tokens"), F.length(t).alias("chars"), R.distinct_chars(t).alias("distinct_chars")
    )


@query(
    rf"""WITH {_SQL_BOXED} SELECT group_id, idx, CASE WHEN regexp_extract(boxed, '\\boxed\{{(.*?)\}}', 1) = replace(gold, '$', '') THEN 1.0 ELSE 0.0 END::DOUBLE AS reward FROM bx"""
)
def boxed_match_reward(spark, sf):
    return _boxed(rollouts(spark, sf)).select(
        "group_id", "idx", R.boxed_match(F.col("boxed"), F.replace("gold", F.lit("$"), F.lit(""))).alias("reward")
    )


@query(
    f"""WITH {SQL_ROLLOUTS}, l AS (SELECT *, length(completion) AS n, min(length(completion)) OVER (PARTITION BY group_id) AS lo, max(length(completion)) OVER (PARTITION BY group_id) AS hi FROM rollouts),
    s AS (SELECT *, 0.5::DOUBLE - (n - lo) / nullif(hi - lo, 0)::DOUBLE AS s FROM l)
    SELECT group_id, idx, {sql_num('CASE WHEN hi = lo THEN 0.0 WHEN n % 2 = 0 THEN s ELSE least(0.0, s) END')} AS reward FROM s"""
)
def length_rank_reward(spark, sf):
    df = rollouts(spark, sf).select("group_id", "idx", F.length("completion").alias("n"))
    df = with_group_stats(df, ["group_id"], {"lo": F.min("n"), "hi": F.max("n")})
    reward = R.length_rank(F.col("n"), F.col("lo"), F.col("hi"), F.col("n") % 2 == 0)
    return df.select("group_id", "idx", num(reward).alias("reward"))


_TASK = "CASE idx % 3 WHEN 0 THEN 'math' WHEN 1 THEN 'coding' ELSE 'chat' END"


@query(
    f"""WITH {_SQL_BOXED}, t AS (SELECT *, {_TASK} AS task FROM bx) SELECT group_id, idx, CASE WHEN task = 'math' THEN {_SQL_RIGHT} END AS math_reward,
    CASE WHEN task = 'coding' THEN CASE WHEN contains(completion, ',') THEN 1.0 ELSE -1.0 END::DOUBLE END AS code_reward FROM t"""
)
def task_rewards(spark, sf):
    task = F.when(F.col("idx") % 3 == 0, "math").when(F.col("idx") % 3 == 1, "coding").otherwise("chat")
    code = F.when(F.contains("completion", F.lit(",")), 1.0).otherwise(-1.0)
    return _boxed(rollouts(spark, sf)).select(
        "group_id", "idx",
        R.for_task(task, "math", R.answer_accuracy(F.col("boxed"), F.col("gold"))).alias("math_reward"),
        R.for_task(task, "coding", code).alias("code_reward"),
    )


_STAR = "completion || CASE length(completion) % 3 WHEN 0 THEN ' *Yes*' WHEN 1 THEN ' *no* or *yes*' ELSE ' yes' END"


@query(
    rf"""WITH {SQL_ROLLOUTS}, t AS (SELECT *, regexp_extract(lower({_STAR}), '\*(yes|no)\*', 1) AS guess, CASE WHEN group_id % 2 = 0 THEN 'YES' ELSE 'No' END AS answer FROM rollouts)
    SELECT group_id, idx, CASE WHEN guess = '' THEN -0.5 WHEN guess = lower(answer) THEN 0.6 ELSE -1.0 END::DOUBLE AS reward FROM t"""
)
def starred_answer_reward(spark, sf):
    n = F.length("completion") % 3
    said = F.concat("completion", F.when(n == 0, " *Yes*").when(n == 1, " *no* or *yes*").otherwise(" yes"))
    answer = F.when(F.col("group_id") % 2 == 0, "YES").otherwise("No")
    return rollouts(spark, sf).select("group_id", "idx", R.starred_answer(said, answer).alias("reward"))


_QUERIES = (
    "list_transform(list_filter(messages, lambda m: m.role = 'assistant' AND length(m.content) % 3 <> 2), "
    "lambda m: CASE length(m.content) % 3 WHEN 0 THEN 'SELECT a FROM t WHERE b = 1' ELSE 'select a from t LIMIT 1' END)"
)


@query(
    f"""WITH {SQL_MESSAGES}, q AS (SELECT conv_id, {_QUERIES} AS q, conv_id % 2 = 0 AS yes, len(list_filter(messages, lambda m: m.role = 'user' AND length(m.content) > 250)) > 0 AS hits,
    messages[1].role = 'system' AS failed FROM msgs),
    w AS (SELECT *, len(list_filter(q, lambda x: contains(x, ' WHERE '))) AS w FROM q)
    SELECT conv_id, {sql_num('CASE WHEN len(q) > 3 THEN -1.5 ELSE 0 END - (len(q) - w) - 0.5 * (len(q) - w) + 0.4 * least(w, 3) + CASE WHEN failed THEN -2.0 WHEN len(q) = 0 THEN -1.5 WHEN hits = yes THEN 2.0 ELSE -1.5 END')} AS reward FROM w"""
)
def trajectory_query_reward(spark, sf):
    kept = F.filter("messages", lambda m: (m.role == "assistant") & (F.length(m.content) % 3 != 2))
    texts = F.transform(kept, lambda m: F.when(F.length(m.content) % 3 == 0, "SELECT a FROM t WHERE b = 1").otherwise("select a from t LIMIT 1"))
    hits = F.exists("messages", lambda m: (m.role == "user") & (F.length(m.content) > 250))
    answer = F.when(F.col("conv_id") % 2 == 0, "Yes").otherwise("no")
    failed = F.get("messages", F.lit(0)).role == "system"
    df = message_table(spark, sf).select("conv_id", texts.alias("q"), hits.alias("hits"), answer.alias("answer"), failed.alias("failed"))
    return df.select("conv_id", num(R.query_reward(F.col("q"), F.col("answer"), F.col("hits"), F.col("failed"))).alias("reward"))


@query(
    f"""WITH {SQL_MESSAGES}, f AS (SELECT conv_id, len(list_filter(messages, lambda m: m.role = 'assistant' AND length(m.content) % 3 <> 2)) > 0 AS c,
    len(list_filter(messages, lambda m: m.role = 'user' AND length(m.content) % 2 = 0)) > 0 AS r,
    len(list_filter(messages, lambda m: (m.role = 'system' AND trim(m.content) <> '') OR (m.role = 'assistant' AND length(m.content) % 3 = 2))) > 0 AS o FROM msgs)
    SELECT conv_id, CASE WHEN c AND r AND o THEN 0.1 WHEN c AND r THEN 0.05 WHEN c THEN -0.15 ELSE 0.0 END::DOUBLE AS reward FROM f"""
)
def trajectory_structure_reward(spark, sf):
    def turn(m):
        role = F.when((m.role == "user") & (F.length(m.content) % 2 == 0), "tool").otherwise(m.role)
        calls = F.when((m.role == "assistant") & (F.length(m.content) % 3 != 2), F.array(F.lit("query")))
        said = F.when(m.role == "user", F.lit(" <think>")).otherwise(m.content)
        return F.struct(role.alias("role"), said.alias("content"), calls.alias("tool_calls"))

    df = message_table(spark, sf).select("conv_id", F.transform("messages", turn).alias("m"))
    return df.select("conv_id", R.structure_reward(F.col("m")).alias("reward"))


def _registry() -> udf.RewardRegistry:
    registry = udf.RewardRegistry()
    registry.add_column("chars", lambda c: F.length(c).cast("double"), "completion")
    registry.add_batch("commas", lambda prompts, texts: [t.count(",") if len(t) > 100 else None for _, t in zip(prompts, texts)], "prompt", "completion")
    return registry


@query(
    f"WITH {SQL_ROLLOUTS} SELECT group_id, idx, length(completion)::DOUBLE AS chars, CASE WHEN length(completion) > 100 THEN (length(completion) - length(replace(completion, ',', '')))::DOUBLE END AS commas FROM rollouts"
)
def user_rewards(spark, sf):
    return _registry().score(rollouts(spark, sf)).select("group_id", "idx", "chars", "commas")


@query(f"WITH {SQL_ROLLOUTS} SELECT group_id, idx, '### Q: ' || prompt || chr(10) || '### A: ' || completion AS text, 'Q: ' || prompt AS python_text FROM rollouts")
def formatted_rows(spark, sf):
    df = udf.format_rows(rollouts(spark, sf), lambda c: F.concat(F.lit("### Q: "), c["prompt"], F.lit("\n### A: "), c["completion"]))
    df = udf.format_rows_python(df, lambda row: f"Q: {row['prompt']}", ["prompt"], "python_text")
    return df.select("group_id", "idx", "text", "python_text")


# --- judges -----------------------------------------------------------------


def _longer_judge():
    """A stub judge: the longer text wins, texts of equal length cannot be judged."""
    def judge(prompts, pairs):
        return [-1 if len(a) == len(b) else int(len(b) > len(a)) for a, b in pairs]

    return judge


@query(f"WITH {SQL_ROLLOUTS} SELECT group_id, idx, CASE WHEN length(prompt) = length(completion) THEN -1 WHEN length(completion) > length(prompt) THEN 1 ELSE 0 END AS verdict FROM rollouts")
def judged_pairs(spark, sf):
    df = rollouts(spark, sf).withColumn("pair", F.array("prompt", "completion"))
    return udf.judge_rows(df, _longer_judge, "prompt", "pair").select("group_id", "idx", "verdict")


@query(f"WITH {SQL_ROLLOUTS} SELECT group_id, idx, CASE WHEN length(prompt) = length(completion) THEN -1 WHEN length(completion) > length(prompt) THEN 1 ELSE 0 END AS verdict FROM rollouts")
def judged_pairs_flipped(spark, sf):
    flip = F.pmod(F.xxhash64("group_id", "idx"), F.lit(2)) == 0
    first, second = R.ordered_pair(flip, F.col("prompt"), F.col("completion"))
    df = rollouts(spark, sf).withColumn("flip", flip).withColumn("pair", F.array(first, second))
    df = udf.judge_rows(df, _longer_judge, "prompt", "pair", "shown")
    return df.select("group_id", "idx", R.unflip(F.col("shown"), F.col("flip")).alias("verdict"))


def _long_first():
    """A stub rank judge: the longest first, texts of equal length in code-point order, then as shown."""
    def judge(prompts, lists):
        return [sorted(range(len(c)), key=lambda i: (-len(c[i]), c[i], i)) for c in lists]

    return judge


@query(
    f"""WITH {SQL_ROLLOUTS}, r AS (SELECT group_id, prompt, completion, row_number() OVER (PARTITION BY group_id ORDER BY idx) - 1 AS place FROM rollouts WHERE completion IS NOT NULL)
    SELECT group_id, string_agg(CAST(place AS VARCHAR), ',' ORDER BY length(completion) DESC, completion, place) AS ranks,
    md5(string_agg(completion, chr(31) ORDER BY length(completion) DESC, completion)) AS best_first FROM r GROUP BY group_id"""
)
def ranked_candidates(spark, sf):
    sorted_texts = F.array_sort(F.collect_list(F.struct("idx", "completion")))
    df = rollouts(spark, sf).filter("completion IS NOT NULL").groupBy("group_id").agg(F.transform(sorted_texts, lambda x: x.completion).alias("texts"))
    # The group stands for its prompt.
    df = df.withColumn("prompt", F.col("group_id").cast("string")).withColumn("order", R.shown_order(F.col("texts"), "group_id"))
    df = df.withColumn("shown", R.in_order(F.col("texts"), F.col("order")))
    df = udf.rank_rows(udf.rank_rows(df, _long_first, "prompt", "texts"), _long_first, "prompt", "shown", "shown_ranks")
    best = R.in_order(F.col("texts"), R.own_places(F.col("shown_ranks"), F.col("order")))
    ranks = F.array_join(F.transform("ranks", lambda r: r.cast("string")), ",")
    return df.select("group_id", ranks.alias("ranks"), F.md5(F.array_join(best, "\x1f")).alias("best_first"))


def _as_long_as_gold():
    """A stub binary judge: a completion has to be as long as the gold one; without either it cannot say."""
    def judge(prompts, completions, golds):
        return [-1 if c is None or g is None else int(len(c) >= len(g)) for c, g in zip(completions, golds, strict=True)]

    return judge


@query(
    f"WITH {SQL_ROLLOUTS}, r AS (SELECT group_id, idx, CASE WHEN idx % 7 <> 3 THEN prompt END AS gold, completion AS c FROM rollouts) "
    "SELECT group_id, idx, CASE WHEN gold IS NULL OR c IS NULL THEN -1 WHEN length(c) >= length(gold) THEN 1 ELSE 0 END AS satisfied FROM r"
)
def binary_judged(spark, sf):
    df = rollouts(spark, sf).withColumn("gold", F.when(F.col("idx") % 7 != 3, F.col("prompt")))
    return udf.binary_rows(df, _as_long_as_gold, "prompt", "completion", "gold").select("group_id", "idx", "satisfied")


_VOTES = "[CASE WHEN length(completion) > 500 THEN 1 ELSE 0 END, CASE WHEN contains(completion, ',') THEN 1 ELSE 0 END, CASE WHEN contains(completion, chr(10)) THEN 1 WHEN idx > 5 THEN -1 ELSE 0 END]"


@query(
    f"WITH {SQL_ROLLOUTS}, v AS (SELECT group_id, idx, {_VOTES} AS v FROM rollouts) SELECT group_id, idx, CASE WHEN list_contains(v, -1) THEN -1 WHEN list_sum(v) = 3 THEN 1 ELSE 0 END AS verdict FROM v"
)
def judge_conjunction(spark, sf):
    c = F.col("completion")
    yes = lambda cond: F.when(cond, 1).otherwise(0)
    last = F.when(F.contains(c, F.lit("\n")), 1).when(F.col("idx") > 5, -1).otherwise(0)
    votes = F.array(yes(F.length(c) > 500), yes(F.contains(c, F.lit(","))), last)
    return rollouts(spark, sf).select("group_id", "idx", R.binary_conjunction(votes).alias("verdict"))


@query(f"WITH {SQL_PAIR_LOGPS} SELECT conv_id, {sql_num('1.0 / (1.0 + exp((rejected - chosen) / 0.5))')} AS p_first FROM pl")
def soft_preference(spark, sf):
    return pair_logps(spark, sf).select("conv_id", num(R.soft_preference(F.col("chosen"), F.col("rejected"), 0.5)).alias("p_first"))


@query(
    f"WITH {SQL_TURN_TOKENS} SELECT group_id, idx, {sql_num(f'len(completion_ids) / 100.0 - CASE WHEN list_contains(completion_ids, {token_id(".")}) THEN 0 ELSE 1.5 END')} AS reward FROM tt"
)
def missing_end_penalty(spark, sf):
    reward = F.size("completion_ids") / 100.0
    return turn_tokens(spark, sf).select("group_id", "idx", num(R.missing_end_penalty(reward, F.col("completion_ids"), token_id("."), 1.5)).alias("reward"))


_LOGGED = 0.002


@query(
    f"""WITH {SQL_HALVES}, v AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS token_id FROM hr GROUP BY token),
    t AS (SELECT s.doc_id, least(sum(p), 1.0) AS mass, count(DISTINCT token_id) AS n_ids, (SELECT count(*) FROM v) AS size FROM stu s JOIN v USING (token) WHERE p >= {_LOGGED} GROUP BY s.doc_id)
    SELECT doc_id, n_ids, {sql_num('mass')} AS mass, {sql_num('CASE WHEN round(mass, 9) < 1 AND n_ids < size THEN ln((1 - mass) / (size - n_ids)) END', 4)} AS tail_logp FROM t"""
)
def tail_mass(spark, sf):
    """A log that lists a token from a least probability on, over the vocabulary of all documents."""
    student, _ = half_distributions(spark, sf)
    vocabulary = settle(build_vocabulary(tokens_of(documents(spark, sf, "doc_id", "text"), "text")))
    logged = student.filter(F.col("p") >= _LOGGED).withColumn("logp", F.log("p"))
    ids = join_unique(logged, vocabulary, ["token"], "n", ["id"]).withColumnRenamed("id", "token_id")
    df = fill_tail(ids, ["doc_id"], "token", vocabulary.agg(F.count("*").alias("n")).scalar())
    # Sums that only differ from 1 by rounding leave no tail.
    tail = F.when(F.round("mass", 9) < 1, F.col("tail_logp"))
    return df.select("doc_id", "n_ids", num(F.col("mass")).alias("mass"), num(tail, 4).alias("tail_logp"))
