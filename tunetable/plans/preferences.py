"""Builders of preference and stepwise datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunetable.functions import messages as M
from tunetable.operators import builders as B
from tunetable.plans.inputs import (
    SQL_MESSAGES,
    SQL_ORDER_ROLLOUTS,
    SQL_STEPWISE,
    SQL_TEXT_PAIRS,
    SQL_UNPAIRED,
    documents,
    message_table,
    order_rollouts,
    show_messages,
    sql_last_index,
    sql_messages,
    stepwise,
    text_pairs,
    unpaired,
)
from tunetable.plans.registry import query
from tunetable.sources.scan import table

_FIRST_LINE = "string_split(text, chr(10))[1]"
_TIGHT = "replace(text, chr(10) || chr(10), chr(10))"


@query(
    f"""SELECT doc_id, 'SUBREDDIT: r/' || source || chr(10) || chr(10) || 'TITLE: ' || {_FIRST_LINE} || chr(10) || chr(10) || 'POST: ' || text || chr(10) || chr(10) || 'TL;DR:' AS prompt,
    CASE WHEN lang = 'de' THEN 'TITLE: ' || {_FIRST_LINE} || chr(10) || chr(10) || {_TIGHT} || chr(10) || chr(10) || 'TL;DR:'
    ELSE 'SUBREDDIT: r/' || source || chr(10) || chr(10) || 'TITLE: ' || {_FIRST_LINE} || chr(10) || chr(10) || 'POST: ' || {_TIGHT} || chr(10) || chr(10) || 'TL;DR:' END AS batch_prompt,
    ' ' || {_FIRST_LINE} AS completion FROM documents"""
)
def summary_prompts(spark, sf):
    text, first = F.col("text"), F.substring_index("text", "\n", 1)
    batch = F.when(F.col("lang") == "de", "cnndm0").when(F.col("lang") == "en", "batch3").otherwise("edit_b2_eval_test")
    return documents(spark, sf).select(
        "doc_id",
        B.summary_prompt(F.col("source"), first, text).alias("prompt"),
        B.batch_prompt(batch, F.col("source"), first, text, text).alias("batch_prompt"),
        B.summary_completion(first).alias("completion"),
    )


@query(
    f"WITH {SQL_TEXT_PAIRS} SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN chosen ELSE rejected END AS chosen, CASE WHEN conv_id % 2 = 0 THEN rejected ELSE chosen END AS rejected FROM tpairs"
)
def choice_pairs(spark, sf):
    df = text_pairs(spark, sf)
    chosen, rejected = B.choose(F.array("chosen", "rejected"), F.pmod("conv_id", F.lit(2)).cast("int"))
    return df.select("conv_id", chosen.alias("chosen"), rejected.alias("rejected"))


@query(
    f"""WITH {SQL_MESSAGES}, s AS (SELECT conv_id, list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: m.content) AS a FROM msgs),
    b AS (SELECT conv_id, a, a[conv_id % len(a) + 1] AS chosen FROM s WHERE len(a) > 0)
    SELECT conv_id, chosen, list_filter(a, lambda x: x <> chosen)[1] AS rejected FROM b"""
)
def best_and_other_sample(spark, sf):
    samples = F.transform(F.filter("messages", lambda m: m.role == "assistant"), lambda m: m.content)
    df = message_table(spark, sf).select("conv_id", samples.alias("a")).filter(F.size("a") > 0)
    chosen, rejected = B.best_and_first_other(F.col("a"), F.pmod("conv_id", F.size("a")).cast("int"))
    return df.select("conv_id", chosen.alias("chosen"), rejected.alias("rejected"))


_TO_LAST = sql_last_index("messages", "m.role = 'assistant'")
_TALK = f"list_filter(messages[1:{_TO_LAST}], lambda m: m.role <> 'system')"


@query(
    f"""WITH {SQL_MESSAGES}, t AS (SELECT conv_id, {_TALK} AS ms FROM msgs)
    SELECT conv_id, {sql_messages('ms[1:len(ms)-1]')} AS prompt, 'assistant:' || ms[-1].content AS chosen, 'assistant:' || reverse(ms[-1].content) AS rejected
    FROM t WHERE len(ms) > 0"""
)
def transcript_pairs(spark, sf):
    kept = F.filter(M.to_last_assistant(F.col("messages")), lambda m: m.role != "system")
    df = message_table(spark, sf).select("conv_id", kept.alias("ms")).filter(F.size("ms") > 0)
    line = lambda m: F.concat(F.when(m.role == "user", "\n\nHuman: ").otherwise("\n\nAssistant: "), m.content)
    before = F.array_join(F.transform(M.head(F.col("ms"), F.size("ms") - 1), line), "")
    last = F.try_element_at("ms", F.lit(-1)).content
    pair = df.select(
        "conv_id",
        F.concat(before, F.lit(B.ASSISTANT_HEADER), last).alias("chosen"),
        F.concat(before, F.lit(B.ASSISTANT_HEADER), F.reverse(last)).alias("rejected"),
    )
    out = B.transcript_pair(pair)
    return out.select("conv_id", *[show_messages(F.col(c)).alias(c) for c in ("prompt", "chosen", "rejected")])


@query(
    f"""WITH {SQL_MESSAGES}, r AS (SELECT conv_id, list_position(list_transform(messages, lambda m: m.role), 'assistant') AS ix, messages FROM msgs)
    SELECT conv_id, CASE WHEN ix > 0 THEN length(messages[ix].content) / 100.0 >= 5 END AS label FROM r"""
)
def rating_labels(spark, sf):
    models = F.transform("messages", lambda m: m.role)
    ratings = F.transform("messages", lambda m: (F.length(m.content) / 100.0).cast("string"))
    return message_table(spark, sf).select("conv_id", B.rated_label(models, ratings, "assistant").alias("label"))


_INDEX = "l_linenumber::BIGINT * 1000000000000 + l_partkey * 1000000 + l_suppkey"


@query(
    f"""WITH {SQL_ORDER_ROLLOUTS}, i AS (SELECT *, {_INDEX} AS i FROM orr),
    r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY reward DESC, i) AS hi, row_number() OVER (PARTITION BY group_id ORDER BY reward, i DESC) AS lo, count(*) OVER (PARTITION BY group_id) AS n FROM i)
    SELECT group_id, max(n) AS n, max(reward) FILTER (hi = 1) AS chosen_reward, max(i) FILTER (hi = 1) AS chosen, max(reward) FILTER (lo = 1) AS rejected_reward, max(i) FILTER (lo = 1) AS rejected
    FROM r GROUP BY group_id"""
)
def best_and_worst_rollouts(spark, sf):
    index = F.col("l_linenumber").cast("long") * 1000000000000 + F.col("l_partkey") * 1000000 + F.col("l_suppkey")
    df = B.best_and_worst(order_rollouts(spark, sf).withColumn("i", index), ["group_id"], "reward", "i", ["i"])
    return df.select(
        "group_id", "n", F.col("chosen.reward").alias("chosen_reward"), F.col("chosen.i").alias("chosen"),
        F.col("rejected.reward").alias("rejected_reward"), F.col("rejected.i").alias("rejected"),
    )


def _step_tree(spark, sf):
    """Lines as steps with two candidates each; some steps have no choice."""
    def step(line):
        n = F.length(line)
        candidate = lambda text, rating: F.struct(F.md5(text).alias("text"), rating.alias("rating"))
        chosen = F.when(n % 3 == 0, 0).when(n % 3 == 1, 1)
        human = F.when(n % 5 != 0, F.struct(F.md5(F.concat(line, F.lit("h"))).alias("text")))
        both = F.array(candidate(line, F.when(n % 2 == 0, 1).otherwise(-1)), candidate(F.concat(line, F.lit("!")), F.lit(1)))
        over = (n % 3 == 2) & (n % 5 == 0) & (n % 2 == 0)
        return F.struct(
            F.when(~over, both).alias("completions"), chosen.alias("chosen_completion"), human.alias("human_completion")
        )

    return stepwise(spark, sf).select("doc_id", "prompt", F.transform("completions", step).alias("steps"))


@query(
    f"""WITH {SQL_STEPWISE},
    st AS (SELECT doc_id, prompt, completions AS l FROM stepwise),
    f AS (SELECT *, coalesce(list_position(list_transform(l, lambda x: length(x) % 3 = 2 AND length(x) % 5 = 0), true), 0) AS stuck,
      coalesce(list_position(list_transform(l, lambda x: length(x) % 3 = 2 AND length(x) % 5 = 0 AND length(x) % 2 = 0), true), 0) AS gone FROM st),
    g AS (SELECT *, least(CASE WHEN gone > 0 THEN gone - 1 ELSE len(l) END, CASE WHEN stuck > 0 THEN stuck - 1 ELSE len(l) END) AS ext,
      least(CASE WHEN gone > 0 THEN gone - 1 ELSE len(l) END, CASE WHEN stuck > 0 THEN stuck ELSE len(l) END) AS seen FROM f),
    s AS (SELECT *, list_transform(l[1:ext], lambda x: CASE length(x) % 3 WHEN 0 THEN md5(x) WHEN 1 THEN md5(x || '!') ELSE md5(x || 'h') END) AS sp,
      list_transform(l[1:ext], lambda x: CASE WHEN length(x) % 3 = 0 THEN length(x) % 2 = 0 ELSE true END) AS sl FROM g),
    k AS (SELECT doc_id, prompt, l, sp, sl, unnest(range(1, seen + 1)) AS i FROM s),
    p AS (SELECT doc_id, prompt, sp[1:i-1] || [md5(l[i])] AS c, sl[1:i-1] || [length(l[i]) % 2 = 0] AS b FROM k WHERE length(l[i]) % 3 <> 0
      UNION ALL SELECT doc_id, prompt, sp[1:i-1] || [md5(l[i] || '!')], sl[1:i-1] || [true] FROM k WHERE length(l[i]) % 3 <> 1
      UNION ALL SELECT doc_id, prompt, sp, sl FROM s)
    SELECT doc_id, prompt, coalesce(array_to_string(c, ','), '') AS completions, coalesce(array_to_string(list_transform(b, lambda x: CASE WHEN x THEN 'y' ELSE 'n' END), ''), '') AS labels FROM p"""
)
def step_tree_paths(spark, sf):
    paths = B.expand_step_tree(_step_tree(spark, sf), "prompt", "steps")
    flags = F.transform("labels", lambda x: F.when(x, "y").otherwise("n"))
    return paths.select("doc_id", "prompt", F.array_join("completions", ",").alias("completions"), F.array_join(flags, "").alias("labels"))


_TRIM = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


@query(
    f"""WITH {SQL_STEPWISE} SELECT doc_id, {_TRIM.format(x='prompt')} AS prompt,
    array_to_string(list_transform(completions, lambda s, i: {_TRIM.format(x="('Step ' || i || ': ' || s)")}), chr(31)) AS completions,
    array_to_string(list_transform(labels, lambda x: CASE WHEN x THEN '+' ELSE '-' END), '') AS labels FROM stepwise WHERE len(completions) > 0"""
)
def marked_step_labels(spark, sf):
    df = stepwise(spark, sf).filter(F.size("completions") > 0)
    line = lambda s, i: F.concat(F.lit("Step "), (i + 1).cast("string"), F.lit(": "), s)
    marked = lambda mark: F.concat(
        "prompt", F.lit(" "), F.array_join(F.transform(F.arrays_zip("completions", "labels"), lambda x, i: F.concat(line(x.completions, i), F.lit(" "), mark(x.labels))), "\n")
    )
    df = df.select(
        "doc_id", marked(lambda _: F.lit(B.STEP_MARK)).alias("text"), marked(lambda ok: F.when(ok, "+").otherwise("-")).alias("marks")
    )
    prompt, completions, labels = B.marked_steps(F.col("text"), F.col("marks"))
    flags = F.transform(labels, lambda x: F.when(x, "+").otherwise("-"))
    return df.select("doc_id", prompt.alias("prompt"), F.array_join(completions, "\x1f").alias("completions"), F.array_join(flags, "").alias("labels"))


@query(
    "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'True' WHEN p_size < 20 THEN 'No' ELSE '$' || p_size || '$' END AS solution FROM part"
)
def wrapped_solutions(spark, sf):
    answer = F.when(F.col("p_size") < 10, "True").when(F.col("p_size") < 20, "No").otherwise(F.col("p_size").cast("string"))
    return table(spark, sf, "part").select("p_partkey", B.wrap_solution(answer).alias("solution"))


@query(
    f"""WITH {SQL_MESSAGES} SELECT conv_id, 'user=image()+text(' || messages[1].content || ')' AS prompt, {sql_messages('messages')} AS parsed FROM msgs"""
)
def image_prompts(spark, sf):
    turn = B.image_turn(F.col("messages")[0].content)[0]
    part = lambda b: F.concat(b.type, F.lit("("), F.coalesce(b.text, F.lit("")), F.lit(")"))
    shown = F.concat(turn.role, F.lit("="), F.array_join(F.transform(turn.content, part), "+"))
    parsed = B.parse_messages(F.to_json("messages"))
    return message_table(spark, sf).select("conv_id", shown.alias("prompt"), show_messages(parsed).alias("parsed"))


@query(
    """SELECT doc_id, source, coalesce(lag(doc_id) OVER w, last_value(doc_id) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS kl_doc_id,
    coalesce(lag(n_chars) OVER w, last_value(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS kl_chars
    FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)"""
)
def mismatched_pairs(spark, sf):
    df = documents(spark, sf, "doc_id", "source", "n_chars").withColumn("kl", F.struct("doc_id", "n_chars"))
    out = B.rotate_in_batch(df, "source", "doc_id", "kl", "shifted")
    return out.select("doc_id", "source", F.col("shifted.doc_id").alias("kl_doc_id"), F.col("shifted.n_chars").alias("kl_chars"))


@query(
    f"""WITH {SQL_UNPAIRED}, c AS (SELECT greatest(count(*) FILTER (label), 1) AS g, count(*) AS n FROM unpaired), d AS (SELECT g, greatest(n - g, 1) AS b FROM c)
    SELECT g AS n_desirable, b AS n_undesirable, round(b / g, 2) AS desirable_low, round(b / g * 1.33::DOUBLE, 2) AS desirable_high,
    round(g / b / 1.33::DOUBLE, 2) AS undesirable_low, round(g / b, 2) AS undesirable_high FROM d"""
)
def class_balance(spark, sf):
    return B.class_balance(unpaired(spark, sf), "label")

