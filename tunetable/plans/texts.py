"""Rendering, tokens, masks, truncation and padding."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunetable.functions import messages as M
from tunetable.functions import tokens as K
from tunetable.functions.render import append_end, calling_chat, render_chat, render_pair, render_prompt
from tunetable.operators.batches import flush, pad_to_longest
from tunetable.operators.vocab import build_vocabulary, encode, tokens_of
from tunetable.plans.datasets import sql_render
from tunetable.plans.inputs import (
    SQL_MESSAGES,
    SQL_PAIR_TOKENS,
    SQL_PAIRS,
    SQL_STEPWISE,
    SQL_TOKENS,
    SQL_TURN_TOKENS,
    documents,
    message_table,
    pair_tokens,
    preference_pairs,
    show_ids,
    sql_hashed,
    sql_ids,
    sql_words,
    stepwise,
    stored_tokens,
    token_rows,
    turn_tokens,
)
from tunetable.plans.registry import query

START, STOP, FILL = 1, 2, 0


def digest(ids):
    """Checksum of a list."""
    return F.md5(show_ids(ids))


def sql_digest(expr: str) -> str:
    return f"md5({sql_ids(expr)})"


# --- rendering --------------------------------------------------------------

_IM_PROMPT = (
    f"CASE WHEN messages[-1].role = 'assistant' THEN substr({sql_render('messages')}, 1, length({sql_render('messages')}) - 11) "
    f"ELSE {sql_render('messages')} || '<|im_start|>assistant' || chr(10) END"
)


@query(
    f"""WITH {SQL_MESSAGES} SELECT conv_id, {sql_render('messages')} AS im, {sql_render('messages', 'simple')} || 'Assistant:' AS simple,
    {sql_render('messages', 'plain')} AS plain, {_IM_PROMPT} AS prompt FROM msgs"""
)
def rendered_chat(spark, sf):
    m = F.col("messages")
    return message_table(spark, sf).select(
        "conv_id",
        render_chat(m, "im").alias("im"),
        render_chat(m, "simple", ask=True).alias("simple"),
        render_chat(m, "plain").alias("plain"),
        render_prompt(m, "im").alias("prompt"),
    )


_P = f"{sql_render('prompt')} || '<|im_start|>assistant' || chr(10)"


_TOOL = '{"name":"look_up","parameters":{"n":"integer"}}'
_CALLS = "m.role = 'assistant' AND length(m.content) % 3 = 0"
_SQL_CALL = (
    "'<tool_call>' || chr(10) || '{\"name\":\"look_up\",\"arguments\":{\"n\":' || length(m.content) || '}}' || chr(10) || '</tool_call>'"
)
_SQL_WIDE = (
    "coalesce(array_to_string(list_transform(messages, lambda m: '<|im_start|>' || m.role || CASE WHEN m.role = 'user' AND length(m.content) % 2 = 0 THEN ' ann' ELSE '' END || chr(10) || "
    f"CASE WHEN {_CALLS} THEN CASE WHEN length(m.content) % 2 = 0 THEN {_SQL_CALL} ELSE m.content || chr(10) || {_SQL_CALL} || chr(10) || {_SQL_CALL} END ELSE m.content END || '<|im_end|>' || chr(10)), ''), '')"
)
_SQL_TOOLS = f"'<|im_start|>system' || chr(10) || '# Tools' || chr(10) || chr(10) || '<tools>' || chr(10) || '{_TOOL}' || chr(10) || '</tools><|im_end|>' || chr(10)"


@query(
    f"""WITH {SQL_MESSAGES} SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN '' ELSE {_SQL_TOOLS} END || {_SQL_WIDE} || '<|im_start|>assistant' || chr(10)
    || CASE WHEN conv_id % 2 = 0 THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) ELSE '' END AS text FROM msgs"""
)
def rendered_tool_chat(spark, sf):
    def wide(m):
        n = F.length(m.content)
        call = F.struct(F.lit("look_up").alias("name"), F.concat(F.lit('{"n":'), n.cast("string"), F.lit("}")).alias("arguments"))
        calls = F.when((m.role == "assistant") & (n % 3 == 0), F.when(n % 2 == 0, F.array(call)).otherwise(F.array(call, call)))
        return F.struct(
            m.role.alias("role"),
            F.when(~(calls.isNotNull() & (n % 2 == 0)), m.content).alias("content"),
            F.when((m.role == "user") & (n % 2 == 0), F.lit("ann")).alias("name"),
            calls.alias("tool_calls"),
        )

    tools = F.when(F.col("conv_id") % 3 != 0, F.array(F.lit(_TOOL))).otherwise(F.array().cast("array<string>"))
    options = F.when(F.col("conv_id") % 2 == 0, F.create_map(F.lit("enable_thinking"), F.lit("false")))
    chat = calling_chat(F.transform("messages", wide))
    return message_table(spark, sf).select("conv_id", render_chat(chat, "im", ask=True, tools=tools, options=options).alias("text"))


@query(
    f"""WITH {SQL_PAIRS} SELECT conv_id, {_P} AS prompt, substr({sql_render('prompt || chosen')}, length({_P}) + 1) AS chosen,
    substr({sql_render('prompt || rejected')}, length({_P}) + 1) AS rejected FROM pairs WHERE len(prompt) > 0"""
)
def rendered_pairs(spark, sf):
    df = preference_pairs(spark, sf).filter(F.size("prompt") > 0)
    prompt, chosen = render_pair(F.col("prompt"), F.col("chosen"))
    _, rejected = render_pair(F.col("prompt"), F.col("rejected"))
    return df.select("conv_id", prompt.alias("prompt"), chosen.alias("chosen"), rejected.alias("rejected"))


@query("SELECT doc_id, CASE WHEN ends_with(text, '.') THEN text ELSE text || '.' END AS text FROM documents")
def end_marker_appended(spark, sf):
    return documents(spark, sf).select("doc_id", append_end(F.col("text"), ".").alias("text"))


# --- tokens -----------------------------------------------------------------

_SQL_VOCAB = (
    f"dt AS (SELECT doc_id, unnest({sql_words('text')}) AS token, generate_subscripts({sql_words('text')}, 1) AS pos FROM documents), "
    "voc AS (SELECT token, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, token) + 2 AS INTEGER) AS id FROM dt GROUP BY token)"
)


@query(f"WITH {_SQL_VOCAB} SELECT token, n, id FROM voc")
def vocabulary(spark, sf):
    return build_vocabulary(tokens_of(documents(spark, sf, "doc_id", "text"), "text"), first_id=3).select("token", "n", "id")


@query(
    f"""WITH {_SQL_VOCAB}, e AS (SELECT doc_id, list(id ORDER BY pos) AS input_ids FROM dt JOIN voc USING (token) GROUP BY doc_id)
    SELECT d.doc_id, CAST(coalesce(len(input_ids), 0) AS INTEGER) AS n_tokens, {sql_digest('coalesce(input_ids, []::INTEGER[])')} AS input_ids FROM documents d LEFT JOIN e USING (doc_id)"""
)
def tokenised_documents(spark, sf):
    docs = documents(spark, sf, "doc_id", "text")
    vocab = build_vocabulary(tokens_of(docs, "text"), first_id=3)
    df = encode(docs, "text", vocab, ["doc_id"])
    return df.select("doc_id", F.size("input_ids").alias("n_tokens"), digest(F.col("input_ids")).alias("input_ids"))


@query(
    f"""WITH {SQL_PAIR_TOKENS} SELECT conv_id, {sql_ids('prompt_ids')} AS prompt_ids, {sql_digest('chosen_ids || [2]')} AS chosen_ids,
    {sql_digest('rejected_ids || [2]')} AS rejected_ids FROM ptoks"""
)
def tokenised_pairs(spark, sf):
    end = lambda c: digest(F.concat(c, F.array(F.lit(STOP)))).alias(c)
    return pair_tokens(spark, sf).select("conv_id", show_ids(F.col("prompt_ids")).alias("prompt_ids"), end("chosen_ids"), end("rejected_ids"))


_LEN16 = "CAST(ceil(max(len(input_ids)) OVER (PARTITION BY batch) / 16.0) * 16 AS BIGINT)"


@query(
    f"""WITH t AS (SELECT doc_id, doc_id // 16 AS batch, {sql_hashed('text')} AS input_ids FROM documents), l AS (SELECT *, {_LEN16} AS n FROM t)
    SELECT doc_id, CAST(n AS INTEGER) AS n, {sql_digest('input_ids || list_transform(range(n - len(input_ids)), lambda z: 0)')} AS padded_right,
    {sql_digest('list_transform(range(n - len(input_ids)), lambda z: 0) || input_ids')} AS padded_left FROM l"""
)
def padded_batches(spark, sf):
    df = stored_tokens(spark, sf).withColumn("batch", F.floor(F.col("doc_id") / 16))
    df = pad_to_longest(df, "input_ids", "padded", FILL, ["batch"], multiple=16)
    left = K.pad(F.col("input_ids"), F.size("padded"), FILL, "left")
    return df.select("doc_id", F.size("padded").alias("n"), digest(F.col("padded")).alias("padded_right"), digest(left).alias("padded_left"))


_FIRST = 22  # an id that some rows start or end with


@query(
    f"""WITH {SQL_TOKENS} SELECT doc_id, {sql_digest(f'CASE WHEN len(input_ids) > 0 AND input_ids[1] = {_FIRST} THEN input_ids ELSE [{_FIRST}] || input_ids END')} AS with_start,
    {sql_digest(f'CASE WHEN len(input_ids) > 0 AND input_ids[-1] = {K.token_id(".")} THEN input_ids ELSE input_ids || [{K.token_id(".")}] END')} AS with_end FROM toks"""
)
def special_ids_added(spark, sf):
    ids = F.col("input_ids")
    return token_rows(spark, sf).select(
        "doc_id", digest(K.add_special(ids, first=_FIRST)).alias("with_start"), digest(K.add_special(ids, last=K.token_id("."))).alias("with_end")
    )


def _run(n: str, v: str) -> str:
    return f"list_transform(range({n}), lambda z: {v})"


@query(
    f"""WITH {SQL_TURN_TOKENS} SELECT group_id, idx, {sql_ids(_run('len(prompt_ids)', '0') + ' || ' + _run('len(completion_ids)', '1'))} AS completion_mask,
    {sql_digest(_run('len(prompt_ids)', '-100') + ' || completion_ids')} AS labels, true AS aligned FROM tt"""
)
def completion_masks(spark, sf):
    df = turn_tokens(spark, sf).withColumn("ids", F.concat("prompt_ids", "completion_ids"))
    mask = K.completion_mask(F.col("prompt_ids"), F.col("ids"))
    return df.select(
        "group_id", "idx", show_ids(mask).alias("completion_mask"), digest(K.masked_labels(F.col("ids"), mask)).alias("labels"),
        K.is_prefix(F.col("prompt_ids"), F.col("ids")).alias("aligned"),
    )


@query(
    f"""WITH h AS (SELECT doc_id, {sql_hashed('substr(text, 1, length(text) // 2)')} AS p, {sql_hashed('text')} AS f FROM documents),
    b AS (SELECT *, len(p) - CASE WHEN f[1:len(p)] = p THEN 0 ELSE 1 END AS k FROM h)
    SELECT doc_id, CAST(len(p) AS INTEGER) AS n_prompt, CAST(k AS INTEGER) AS boundary, {sql_digest('f[k+1:]')} AS answer,
    CAST(CASE WHEN k = len(p) OR k = 0 THEN 0 ELSE len(list_filter(range(1, k + 1), lambda i: f[i] <> p[i])) END AS INTEGER) AS differing FROM b"""
)
def answer_boundaries(spark, sf):
    text = F.col("text")
    half = F.substr(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))
    df = documents(spark, sf).select("doc_id", K.hashed_ids(half).alias("p"), K.hashed_ids(text).alias("f"))
    df = df.withColumn("k", K.answer_boundary(F.col("p"), F.col("f")))
    return df.select(
        "doc_id", F.size("p").alias("n_prompt"), F.col("k").alias("boundary"), digest(K.after(F.col("f"), F.col("k"))).alias("answer"),
        K.checked_pair_prompts(F.col("p"), K.first_n(F.col("f"), F.col("k"))).alias("differing"),
    )


@query(
    f"WITH {SQL_TURN_TOKENS} SELECT group_id, idx, CAST(CASE WHEN len(completion_ids) > 0 THEN len(prompt_ids) ELSE 0 END AS INTEGER) AS first_label, CAST(len(completion_ids) AS INTEGER) AS n_labels FROM tt"
)
def answer_spans(spark, sf):
    ids = F.concat("prompt_ids", "completion_ids")
    labels = K.masked_labels(ids, K.completion_mask(F.col("prompt_ids"), ids))
    df = turn_tokens(spark, sf).select("group_id", "idx", labels.alias("labels"))
    first, n = K.answer_span(F.col("labels"))
    return df.select("group_id", "idx", first.alias("first_label"), n.alias("n_labels"))


_A_RUNS = f"flatten(list_transform(messages, lambda m: list_transform({sql_words('m.content')}, lambda w: CASE WHEN m.role = 'assistant' THEN 1 ELSE 0 END)))"


@query(
    f"""WITH {SQL_MESSAGES}, a AS (SELECT conv_id, {_A_RUNS} AS mask, flatten(list_transform(messages, lambda m: {sql_hashed('m.content')})) AS ids FROM msgs
    WHERE list_contains(list_transform(messages, lambda m: m.role), 'assistant'))
    SELECT conv_id, {sql_ids('mask')} AS mask, {sql_digest('list_transform(list_zip(ids, mask), lambda x: CASE WHEN x[2] = 1 THEN x[1] ELSE -100 END)')} AS labels FROM a"""
)
def assistant_masks(spark, sf):
    m = F.col("messages")
    df = message_table(spark, sf).filter(F.exists(m, lambda x: x.role == "assistant"))
    ids = F.flatten(F.transform(m, lambda x: K.hashed_ids(x.content)))
    df = df.select("conv_id", K.assistant_mask(m).alias("mask"), ids.alias("ids"))
    return df.select("conv_id", show_ids(F.col("mask")).alias("mask"), digest(K.masked_labels(F.col("ids"), F.col("mask"))).alias("labels"))


# --- truncation -------------------------------------------------------------


@query(f"WITH {SQL_TURN_TOKENS} SELECT group_id, idx, {sql_ids('prompt_ids[1:64]')} AS prompt_ids, {sql_ids('completion_ids[1:64]')} AS completion_ids FROM tt")
def truncated_lists(spark, sf):
    df = K.truncate_lists(turn_tokens(spark, sf), 64)
    return df.select("group_id", "idx", *[show_ids(F.col(c)).alias(c) for c in ("prompt_ids", "completion_ids")])


def _last(x: str, n: str) -> str:
    return f"{x}[greatest(len({x}) - {n} + 1, 1):]"


@query(
    f"WITH {SQL_PAIR_TOKENS} SELECT conv_id, {sql_ids(_last('prompt_ids', '16'))} AS prompt_ids, {sql_ids('chosen_ids[1:32]')} AS chosen_ids, {sql_ids('rejected_ids[1:32]')} AS rejected_ids FROM ptoks"
)
def truncated_pairs(spark, sf):
    prompt, chosen = K.truncate_pair(F.col("prompt_ids"), F.col("chosen_ids"), 16, 32)
    _, rejected = K.truncate_pair(F.col("prompt_ids"), F.col("rejected_ids"), 16, 32)
    return pair_tokens(spark, sf).select(
        "conv_id", show_ids(prompt).alias("prompt_ids"), show_ids(chosen).alias("chosen_ids"), show_ids(rejected).alias("rejected_ids")
    )


@query(
    f"""WITH {SQL_TURN_TOKENS},
    r AS (SELECT *, 200 - CASE WHEN len(prompt_ids) > 0 AND prompt_ids[1] <> 1 THEN 1 ELSE 0 END - CASE WHEN len(completion_ids) > 0 AND completion_ids[-1] <> 2 THEN 1 ELSE 0 END AS room FROM tt),
    c AS (SELECT *, CASE WHEN len(prompt_ids) + len(completion_ids) > room THEN {_last('prompt_ids', '24')} ELSE prompt_ids END AS p FROM r)
    SELECT group_id, idx, {sql_ids('p')} AS prompt_ids, {sql_ids('CASE WHEN len(p) + len(completion_ids) > room THEN completion_ids[1:room - 24] ELSE completion_ids END')} AS completion_ids FROM c"""
)
def truncated_two_stage(spark, sf):
    p, a = K.truncate_two_stage(F.col("prompt_ids"), F.col("completion_ids"), 200, 24, "keep_end", START, STOP)
    return turn_tokens(spark, sf).select("group_id", "idx", show_ids(p).alias("prompt_ids"), show_ids(a).alias("completion_ids"))


@query(
    f"""WITH {SQL_PAIR_TOKENS}, m AS (SELECT *, greatest(len(chosen_ids), len(rejected_ids)) AS longest FROM ptoks),
    c AS (SELECT *, CASE WHEN len(prompt_ids) + longest > 200 THEN prompt_ids[1:24] ELSE prompt_ids END AS p FROM m)
    SELECT conv_id, {sql_ids('p')} AS prompt_ids, {sql_ids('CASE WHEN len(p) + longest > 200 THEN chosen_ids[1:176] ELSE chosen_ids END')} AS chosen_ids,
    {sql_ids('CASE WHEN len(p) + longest > 200 THEN rejected_ids[1:176] ELSE rejected_ids END')} AS rejected_ids FROM c"""
)
def truncated_pairs_two_stage(spark, sf):
    cols = ("prompt_ids", "chosen_ids", "rejected_ids")
    cut = K.truncate_pair_two_stage(*[F.col(c) for c in cols], 200, 24, "keep_start")
    return pair_tokens(spark, sf).select("conv_id", *[show_ids(x).alias(c) for x, c in zip(cut, cols, strict=True)])


_JM = _run("len(prompt_ids)", "0") + " || " + _run("len(completion_ids)", "1")


@query(
    f"""WITH {SQL_TURN_TOKENS}, j AS (SELECT group_id, idx, prompt_ids || completion_ids AS ids, {_JM} AS mask FROM tt)
    SELECT group_id, idx, {sql_ids('ids[1:100]')} AS start_ids, {sql_ids('mask[1:100]')} AS start_mask, {sql_ids(_last('ids', '100'))} AS end_ids, {sql_ids(_last('mask', '100'))} AS end_mask FROM j"""
)
def truncated_joined(spark, sf):
    out = []
    for mode in ("start", "end"):
        ids, mask = K.truncate_joined(F.col("prompt_ids"), F.col("completion_ids"), 100, f"keep_{mode}")
        out += [show_ids(ids).alias(f"{mode}_ids"), show_ids(mask).alias(f"{mode}_mask")]
    return turn_tokens(spark, sf).select("group_id", "idx", *out)


_VALID = "list_filter(completion_ids, lambda x: x % 3 <> 0)"


@query(
    f"""WITH {SQL_TURN_TOKENS}, v AS (SELECT group_id, idx, {_VALID} AS v FROM tt), n AS (SELECT *, max(len(v)) OVER (PARTITION BY group_id) AS n FROM v)
    SELECT group_id, idx, {sql_ids('v || ' + _run('n - len(v)', '0'))} AS flushed_left, {sql_ids(_run('n - len(v)', '0') + ' || v')} AS flushed_right,
    {sql_ids(_run('len(v)', '1') + ' || ' + _run('n - len(v)', '0'))} AS mask FROM n"""
)
def flushed_rows(spark, sf):
    df = turn_tokens(spark, sf).withColumn("mask", F.transform("completion_ids", lambda x: F.when(x % 3 != 0, 1).otherwise(0)))
    # Flushed once; the other side has the same tokens and as much padding.
    out = flush(df, "completion_ids", "mask", "left", ["group_id"], FILL)
    valid = K.valid_only(F.col("completion_ids"), F.col("mask"))
    return out.select(
        "group_id", "idx", show_ids(F.col("completion_ids")).alias("flushed_left"), show_ids(K.pad(valid, F.size("mask"), FILL, "left")).alias("flushed_right"),
        show_ids(F.col("mask")).alias("mask"),
    )


@query(
    f"""WITH {SQL_TURN_TOKENS}, v AS (SELECT group_id, idx, {_VALID} AS v, list_filter(list_transform(completion_ids, lambda x, i: CASE WHEN x % 3 <> 0 THEN i ELSE 0 END), lambda i: i > 0) AS w FROM tt),
    n AS (SELECT *, max(len(v)) OVER (PARTITION BY group_id) AS n FROM v)
    SELECT group_id, idx, {sql_ids(_run('n - len(v)', '0') + ' || v')} AS ids, {sql_ids(_run('n - len(v)', '0') + ' || w')} AS places,
    {sql_ids(_run('n - len(v)', '0') + ' || ' + _run('len(v)', '1'))} AS mask FROM n"""
)
def flushed_columns(spark, sf):
    df = turn_tokens(spark, sf).withColumns(
        {"mask": F.transform("completion_ids", lambda x: F.when(x % 3 != 0, 1).otherwise(0)), "places": F.transform("completion_ids", lambda x, i: i + 1)}
    )
    df = flush(df, ["completion_ids", "places"], "mask", "right", ["group_id"], FILL)
    return df.select("group_id", "idx", show_ids(F.col("completion_ids")).alias("ids"), show_ids(F.col("places")).alias("places"), show_ids(F.col("mask")).alias("mask"))


_STOP_ID = K.token_id(".")
_END = f"CASE WHEN list_contains(completion_ids, {_STOP_ID}) THEN list_position(completion_ids, {_STOP_ID}) ELSE len(completion_ids) END"


@query(
    f"""WITH {SQL_TURN_TOKENS}, e AS (SELECT *, {_END} AS e FROM tt) SELECT group_id, idx,
    {sql_ids('completion_ids[1:e] || ' + _run('len(completion_ids) - e', '0'))} AS ids, {sql_ids(_run('e', '1') + ' || ' + _run('len(completion_ids) - e', '0'))} AS mask FROM e"""
)
def truncated_at_stop(spark, sf):
    ids, mask = K.truncate_at_stop(F.col("completion_ids"), _STOP_ID, FILL)
    return turn_tokens(spark, sf).select("group_id", "idx", show_ids(ids).alias("ids"), show_ids(mask).alias("mask"))


@query(
    f"WITH {SQL_TURN_TOKENS} SELECT group_id, idx, CAST(coalesce(nullif(list_position(list_transform(completion_ids, lambda x: x > 65000), true), 0) - 1, len(completion_ids)) AS INTEGER) AS first_true FROM tt"
)
def first_true_index(spark, sf):
    flags = F.transform("completion_ids", lambda x: x > 65000)
    return turn_tokens(spark, sf).select("group_id", "idx", K.first_true(flags).alias("first_true"))


_STEP_IDS = f"flatten(list_transform(completions, lambda s: {sql_hashed('s')} || [9]))"
_STEP_LABELS = (
    f"flatten(list_transform(completions, lambda s: list_transform({sql_words('s')}, lambda z: -100) || [CASE WHEN length(s) >= 40 THEN 1 ELSE 0 END]))"
)
_LAST_LABELS = (
    f"flatten(list_transform(completions, lambda s, i: list_transform({sql_words('s')}, lambda z: -100) || "
    "[CASE WHEN i < len(completions) THEN -100 WHEN length(s) >= 40 THEN 1 ELSE 0 END]))"
)


@query(
    f"""WITH {SQL_STEPWISE}, s AS (SELECT doc_id, [1] || {sql_hashed('prompt')} AS p, {_STEP_IDS} AS ids, {_STEP_LABELS} AS labels, {_LAST_LABELS} AS last_labels FROM stepwise),
    t AS (SELECT doc_id, {_last('p', '50')} AS p, ids[1:400] AS ids, labels[1:400] AS labels, last_labels AS last_labels FROM s)
    SELECT doc_id, {sql_digest('(p || ids)[1:420]')} AS input_ids, {sql_ids('(' + _run('len(p)', '-100') + ' || labels)[1:420]')} AS labels,
    {sql_digest('last_labels')} AS last_labels FROM t"""
)
def stepwise_labels(spark, sf):
    df = stepwise(spark, sf).select(
        "doc_id", K.hashed_ids(F.col("prompt")).alias("p"), F.transform("completions", K.hashed_ids).alias("steps"), F.col("labels").alias("right")
    )
    ids, labels = K.stepwise_labels(F.col("p"), F.col("steps"), F.col("right"), 9, START, 50, 400, 420)
    empty = F.array().cast("array<int>")
    _, last = K.stepwise_labels(empty, F.col("steps"), F.col("right"), 9, last_only=True)
    return df.select("doc_id", digest(ids).alias("input_ids"), show_ids(labels).alias("labels"), digest(last).alias("last_labels"))


@query(
    f"""WITH {SQL_MESSAGES}, f AS (SELECT *, list_position(list_transform(messages, lambda m: m.role), 'user') AS u FROM msgs)
    SELECT conv_id, array_to_string(list_transform(messages, lambda m, i: m.role || '=' || CASE WHEN i = u THEN 'image(a/' || conv_id || ')+image(b/' || conv_id || ')+' ELSE '' END || 'text(' || m.content || ')'), chr(31)) AS messages
    FROM f WHERE u > 0"""
)
def image_placeholders(spark, sf):
    m = F.col("messages")
    df = message_table(spark, sf).filter(F.exists(m, lambda x: x.role == "user"))
    key = F.col("conv_id").cast("string")
    images = F.array(F.concat(F.lit("a/"), key), F.concat(F.lit("b/"), key))
    blocks = M.image_blocks(m, images)
    part = lambda b: F.concat(b.type, F.lit("("), F.coalesce(b.text, b.image_ref), F.lit(")"))
    shown = F.transform(blocks, lambda x: F.concat(x.role, F.lit("="), F.array_join(F.transform(x.content, part), "+")))
    return df.select("conv_id", F.array_join(shown, "\x1f").alias("messages"))


@query(
    f"""WITH {SQL_MESSAGES}, f AS (SELECT conv_id, messages, list_transform(messages, lambda m: m.role) AS r FROM msgs),
    t AS (SELECT conv_id, unnest(messages) AS m, generate_subscripts(messages, 1) AS i, r FROM f WHERE list_contains(r, 'user')),
    u AS (SELECT conv_id, i, m.role AS role, 'text(' || m.content || ')' AS text, len(list_filter(r[1:i], lambda x: x = 'user')) AS k FROM t)
    SELECT conv_id, string_agg(role || '=' || CASE WHEN role <> 'user' OR (k > 1 AND conv_id % 2 = 1) THEN text
    WHEN conv_id % 2 = 1 THEN 'image_pil(' || conv_id || '/1)+image_pil(' || conv_id || '/2)+' || text
    WHEN k = 1 THEN 'image_pil(' || conv_id || '/1)+' || text || '+image_pil(' || conv_id || '/2)'
    ELSE 'image_pil(' || conv_id || '/' || (k + 1) || ')+' || text END, chr(31) ORDER BY i) AS messages FROM u GROUP BY conv_id"""
)
def prepared_images(spark, sf):
    """User turns of even conversations are prepared, with one placeholder more in the first; the others are texts with two images."""
    m, even = F.col("messages"), F.col("conv_id") % 2 == 0
    asked = lambda x: x.role == "user"
    df = message_table(spark, sf).filter(F.exists(m, asked)).withColumn("first", M.first_index(m, asked))
    block = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"))
    slot = block("image", F.lit(None))
    own = lambda x, i: F.when(i + 1 == F.col("first"), F.array(slot, block("text", x.content), slot)).otherwise(F.array(slot, block("text", x.content)))
    mixed = F.transform(m, lambda x, i: F.struct(x.role.alias("role"), x.content.alias("content"), F.when(even & asked(x), own(x, i)).alias("blocks")))
    count = F.when(even, F.size(F.filter(m, asked)) + 1).otherwise(2)
    images = F.transform(F.sequence(F.lit(1), count), lambda i: F.concat_ws("/", F.col("conv_id").cast("string"), i.cast("string")))
    blocks = M.rename_image_blocks(M.prepared_image_blocks(mixed, images))
    part = lambda b: F.concat(b.type, F.lit("("), F.coalesce(b.text, b.image_pil), F.lit(")"))
    shown = F.transform(blocks, lambda x: F.concat(x.role, F.lit("="), F.array_join(F.transform(x.content, part), "+")))
    return df.select("conv_id", F.array_join(shown, "\x1f").alias("messages"))


@query(f"WITH {SQL_TURN_TOKENS} SELECT group_id, idx, completion_ids[-1] = {_STOP_ID} AS terminated, {sql_ids(f'list_transform(completion_ids, lambda x: CASE WHEN completion_ids[-1] = {_STOP_ID} THEN 1 ELSE 0 END)')} AS mask FROM tt")
def truncated_rows_masked(spark, sf):
    ids = F.col("completion_ids")
    mask = K.drop_truncated(F.transform(ids, lambda _: F.lit(1)), ids, [_STOP_ID, FILL])
    return turn_tokens(spark, sf).select("group_id", "idx", K.ended(ids, [_STOP_ID, FILL]).alias("terminated"), show_ids(mask).alias("mask"))

