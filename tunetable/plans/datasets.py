"""Scans, splits, projections, filters and dataset-type conversions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunetable import schema
from tunetable.functions import messages as M
from tunetable.functions.render import prompt_and_completion_text, render_chat, strip_repeated_header
from tunetable.functions.tokens import hashed_ids, n_words
from tunetable.operators import convert
from tunetable.operators.windows import budget_filter, window_to_budget
from tunetable.plans.inputs import (
    SQL_MESSAGES,
    SQL_PAIR_TOKENS,
    SQL_PAIRS,
    SQL_ROLLOUTS,
    SQL_STEPWISE,
    SQL_TEXT_PAIRS,
    SQL_TOKENS,
    SQL_UNPAIRED,
    conversations,
    documents,
    message_table,
    pair_tokens,
    preference_pairs,
    rollouts,
    show_messages,
    sql_last_index,
    sql_messages,
    sql_words,
    stepwise,
    text_pairs,
    token_rows,
    unpaired,
)
from tunetable.plans.registry import query
from tunetable.session import scratch_path
from tunetable.sources import sinks, splits
from tunetable.sources.scan import DatasetSpec, log_report, mixture, parse_log, table

# --- scans and sinks --------------------------------------------------------


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def scan_columns(spark, sf):
    return table(spark, sf, "documents", "doc_id", "lang", "source", "n_chars")


@query(
    "SELECT doc_id AS id, text, 'documents' AS source_name FROM documents UNION ALL "
    "SELECT item_id, text, 'benchmark' FROM benchmark UNION ALL SELECT conv_id, text, 'conversations' FROM conversations"
)
def mixture_of_tables(spark, sf):
    keys = {"documents": "doc_id", "benchmark": "item_id", "conversations": "conv_id"}
    return mixture(
        spark, [DatasetSpec(f"{sf}/{n}.parquet", n, columns=[F.col(k).alias("id"), "text"]) for n, k in keys.items()]
    )


def _both(train, test, key):
    return train.select(key, F.lit("train").alias("split")).unionByName(test.select(key, F.lit("test").alias("split")))


@query("SELECT doc_id, CASE WHEN (doc_id * 7919 + 13) % 10000 < 2000 THEN 'test' ELSE 'train' END AS split FROM documents")
def fraction_split(spark, sf):
    slot = F.pmod(F.col("doc_id") * 7919 + 13, F.lit(10000))
    return _both(*splits.fraction_split(documents(spark, sf, "doc_id"), slot, 0.2, 10_000), "doc_id")


@query(
    "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY (doc_id * 7919 + 13) % 10007, doc_id) <= 300 THEN 'train' ELSE 'test' END AS split FROM documents"
)
def sized_split(spark, sf):
    draw = F.pmod(F.col("doc_id") * 7919 + 13, F.lit(10007))
    return _both(*splits.sized_split(documents(spark, sf, "doc_id"), "doc_id", 300, draw), "doc_id")


@query(
    "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= (SELECT count(*) - ceil(0.1 * count(*)) FROM documents) THEN 'train' ELSE 'test' END AS split FROM documents"
)
def ordered_split(spark, sf):
    return _both(*splits.ordered_split(documents(spark, sf, "doc_id"), "doc_id", 0.1), "doc_id")


@query(
    "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) > (SELECT count(*) - 100 FROM documents) THEN 'test' ELSE 'train' END AS split FROM documents"
)
def tail_split(spark, sf):
    return _both(*splits.tail_split(documents(spark, sf, "doc_id"), "doc_id", 100), "doc_id")


@query(
    "SELECT doc_id, lang FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM documents) WHERE r <= floor(0.05 * n + 0.5)"
)
def percent_slice(spark, sf):
    return splits.percent_slice(documents(spark, sf, "doc_id", "lang"), "doc_id", 0, 5)


@query(
    """WITH lines AS (SELECT event_type AS log, props AS line FROM events UNION ALL SELECT 'benchmark', text FROM benchmark),
    parsed AS (SELECT log, json_valid(line) AS ok, CASE WHEN json_valid(line) THEN CAST(line->>'k' AS INTEGER) END AS k FROM lines)
    SELECT log, count(*) FILTER (ok AND k >= 50) AS passed, count(*) FILTER (ok AND k < 50) AS failed,
    count(*) FILTER (NOT ok) AS bad_lines, count(*) AS total FROM parsed GROUP BY log"""
)
def log_pass_fail(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_type").alias("log"), F.col("props").alias("line"))
    notes = table(spark, sf, "benchmark").select(F.lit("benchmark").alias("log"), F.col("text").alias("line"))
    records = parse_log(events.unionByName(notes), "k INT")
    return log_report(records, "log", F.col("k") < 50, F.col("k") >= 50)


@query("SELECT doc_id, lang, text || '<eos>' AS text FROM documents")
def save_and_reload(spark, sf):
    path = scratch_path(spark, "prepared")
    sinks.save_prepared(documents(spark, sf).select("doc_id", "lang", F.concat("text", F.lit("<eos>")).alias("text")), path)
    return sinks.load_prepared(spark, path)


@query(f"WITH {SQL_ROLLOUTS} SELECT CAST(idx AS INTEGER) AS step, prompt, completion, r_length, r_length - 0.5 AS advantage FROM rollouts")
def completion_sink(spark, sf):
    path = scratch_path(spark, "completions")
    rows = rollouts(spark, sf).withColumn("step", F.col("idx")).withColumn("advantage", F.col("r_length") - 0.5)
    sinks.append_completions(rows, path, ["r_length"])
    cols = "prompt string, completion string, r_length double, advantage double, step int"
    return spark.read.schema(cols).parquet(path).select("step", "prompt", "completion", "r_length", "advantage")


@query(f"WITH {SQL_MESSAGES} SELECT conv_id, CAST(len(messages) AS INTEGER) AS n, {sql_messages('messages')} AS messages FROM msgs")
def messages_from_turns(spark, sf):
    df = message_table(spark, sf)
    return df.select("conv_id", F.size("messages").alias("n"), show_messages(F.col("messages")).alias("messages"))


# --- formats ----------------------------------------------------------------


@query(f"WITH {SQL_MESSAGES} SELECT conv_id, true AS conversational, 'language_modeling' AS dataset_type, len(messages) > 0 AS has_messages FROM msgs")
def format_detection(spark, sf):
    df = message_table(spark, sf)
    return df.select(
        "conv_id",
        F.lit(schema.is_conversational(df.schema)).alias("conversational"),
        F.lit(schema.dataset_type(df.schema)).alias("dataset_type"),
        schema.has_messages("messages").alias("has_messages"),
    )


def _share_table(spark, sf):
    """Conversations in the from/value form."""
    who = lambda m: F.when(m.role == "user", "human").when(m.role == "assistant", "gpt").otherwise(None)
    pairs = F.transform("messages", lambda m: F.struct(who(m).alias("from"), m.content.alias("value")))
    return message_table(spark, sf).select("conv_id", pairs.alias("conversations"))


_SQL_SHARE = (
    f"{SQL_MESSAGES}, share AS (SELECT conv_id, list_transform(messages, lambda m: {{'role': CASE m.role WHEN 'user' THEN 'human' "
    "WHEN 'assistant' THEN 'gpt' END, 'content': m.content}) AS messages FROM msgs)"
)


@query(f"WITH {_SQL_SHARE} SELECT conv_id, true AS from_value, false AS chatml FROM share")
def from_value_detection(spark, sf):
    df = _share_table(spark, sf)
    return df.select(
        "conv_id",
        F.lit(schema.is_conversational_from_value(df.schema)).alias("from_value"),
        F.lit(schema.is_conversational(df.schema)).alias("chatml"),
    )


@query(
    f"WITH {_SQL_SHARE} SELECT conv_id, array_to_string(list_transform(messages, lambda m: coalesce(m.role, '-') || ':' || m.content), chr(31)) AS messages FROM share"
)
def share_to_chatml(spark, sf):
    df = M.to_chatml(_share_table(spark, sf))
    shown = F.transform("messages", lambda m: M.message(F.coalesce(m.role, F.lit("-")), m.content))
    return df.select("conv_id", show_messages(shown).alias("messages"))


@query(f"WITH {SQL_MESSAGES} SELECT conv_id, {sql_messages('list_filter(messages, lambda m: m.role <> ' + chr(39) + 'system' + chr(39) + ')')} AS messages FROM msgs")
def share_role_names(spark, sf):
    # A message without a role (here the system turns) is dropped.
    return _share_table(spark, sf).select("conv_id", show_messages(M.share_roles(F.col("conversations"))).alias("messages"))


@query(
    f"WITH {SQL_ROLLOUTS} SELECT group_id, idx, 'system:Answer.' || chr(31) || 'user:' || prompt || chr(31) || 'assistant:' || completion AS messages FROM rollouts"
)
def inferred_messages(spark, sf):
    df = rollouts(spark, sf).select(
        "group_id", "idx", F.lit("Answer.").alias("system"), F.col("prompt").alias("question"), F.col("completion").alias("answer")
    )
    return df.select("group_id", "idx", show_messages(M.infer_messages(df.schema)).alias("messages"))


_LAST_A = sql_last_index("messages", "m.role = 'assistant'")
_LAST_NOT_A = sql_last_index("messages", "m.role <> 'assistant'")


@query(f"WITH {SQL_MESSAGES} SELECT conv_id, {sql_messages(f'messages[1:{_LAST_A}]')} AS messages FROM msgs")
def to_last_assistant(spark, sf):
    return message_table(spark, sf).select("conv_id", show_messages(M.to_last_assistant(F.col("messages"))).alias("messages"))


@query(
    f"WITH {SQL_MESSAGES} SELECT conv_id, {sql_messages(f'messages[1:{_LAST_NOT_A}]')} AS messages, CAST({_LAST_NOT_A} AS INTEGER) AS message_count FROM msgs"
)
def drop_trailing_assistant(spark, sf):
    df = message_table(spark, sf).withColumn("messages", M.drop_trailing_assistant(F.col("messages")))
    return df.select("conv_id", show_messages(F.col("messages")).alias("messages"), F.size("messages").alias("message_count"))


@query(
    """SELECT conv_id, turn, '{"id":' || conv_id || ',"info":{' ||
    concat_ws(',', CASE WHEN role <> 'system' THEN '"role":"' || role || '"' END, CASE WHEN turn <> 0 THEN '"turn":' || turn END) ||
    '},"path":[' || CASE WHEN turn = 0 THEN 'null' ELSE turn::VARCHAR END || ',' || conv_id || ']}' AS example FROM conversations"""
)
def null_entries_removed(spark, sf):
    info = F.struct(F.when(F.col("role") != "system", F.col("role")).alias("role"), F.when(F.col("turn") != 0, F.col("turn")).alias("turn"))
    path = F.array(F.when(F.col("turn") != 0, F.col("turn")), F.col("conv_id"))
    df = conversations(spark, sf).withColumn("x", F.struct(F.col("conv_id").alias("id"), info.alias("info"), path.alias("path")))
    return df.select("conv_id", "turn", M.drop_nulls(F.col("x"), df.schema["x"].dataType).alias("example"))


@query(
    f"""WITH {SQL_MESSAGES} SELECT conv_id, {sql_messages('messages[1:len(messages)-1]')} AS prompt, {sql_messages('messages[len(messages):]')} AS completion,
    {sql_messages("CASE WHEN messages[-1].role = 'user' THEN messages ELSE messages[1:len(messages)-1] END")} AS asked FROM msgs"""
)
def split_last_message(spark, sf):
    m = F.col("messages")
    prompt, completion = M.split_last(m)
    return message_table(spark, sf).select(
        "conv_id", show_messages(prompt).alias("prompt"), show_messages(completion).alias("completion"),
        show_messages(M.prompt_of(m)).alias("asked"),
    )


def sql_render(msgs: str, style: str = "im") -> str:
    body = {
        "im": "'<|im_start|>' || m.role || chr(10) || m.content || '<|im_end|>' || chr(10)",
        "simple": "upper(m.role[1]) || m.role[2:] || ': ' || m.content || chr(10) || chr(10)",
        "plain": "m.role || ': ' || m.content || chr(10)",
    }[style]
    return f"coalesce(array_to_string(list_transform({msgs}, lambda m: {body}), ''), '')"


_ASKED = "CASE WHEN messages[-1].role = 'assistant' THEN messages[1:len(messages)-1] ELSE messages END"


@query(
    f"""WITH {SQL_MESSAGES}, r AS (SELECT conv_id, messages, {sql_render(_ASKED)} || '<|im_start|>assistant' || chr(10) AS prompt, {sql_render('messages')} AS full_text FROM msgs)
    SELECT conv_id, prompt, full_text, CASE WHEN starts_with(full_text, prompt) THEN substr(full_text, length(prompt) + 1)
    WHEN messages[-1].role = 'assistant' THEN messages[-1].content || '<eos>' ELSE '' END AS completion FROM r"""
)
def prompt_and_completion_texts(spark, sf):
    prompt, full, completion = prompt_and_completion_text(F.col("messages"), "<eos>")
    return message_table(spark, sf).select("conv_id", prompt.alias("prompt"), full.alias("full_text"), completion.alias("completion"))


@query(
    "SELECT item_id, 'system:Be brief.' || chr(31) || 'user:' || text AS with_system, 'user:Question: ' || text AS with_preamble FROM benchmark"
)
def constant_system_prompt(spark, sf):
    c = F.col("text")
    return table(spark, sf, "benchmark").select(
        "item_id",
        show_messages(M.with_system(c, "Be brief.")).alias("with_system"),
        show_messages(M.with_preamble(c, "Question: ")).alias("with_preamble"),
    )


@query(
    f"""WITH {SQL_MESSAGES} SELECT conv_id, {sql_messages("list_transform(messages, lambda x: {'role': x.role, 'content': CASE WHEN x.role = 'assistant' THEN '<think>' || replace(x.content, ' ', '_') || '</think>' || x.content ELSE x.content END})")} AS messages FROM msgs"""
)
def thinking_merged(spark, sf):
    thought = lambda m: F.when(m.role == "assistant", F.replace(m.content, F.lit(' '), F.lit('_'))).when(m.role == "user", F.lit("  "))
    with_field = F.transform("messages", lambda m: F.struct(m.role.alias("role"), thought(m).alias("thinking"), m.content.alias("content")))
    return message_table(spark, sf).select("conv_id", show_messages(M.merge_thinking(with_field)).alias("messages"))


@query(f"WITH {SQL_ROLLOUTS} SELECT group_id, idx, completion FROM rollouts")
def repeated_header_removed(spark, sf):
    header = "<|im_start|>assistant"
    said = F.when(F.length("completion") % 2 == 0, F.concat(F.lit(f"{header}\n"), "completion")).otherwise(F.col("completion"))
    prompt = F.concat("prompt", F.lit(f"\n{header}\n"))
    return rollouts(spark, sf).select("group_id", "idx", strip_repeated_header(prompt, said).alias("completion"))


# --- filters ----------------------------------------------------------------

_CHARS = "list_sum(list_transform(messages, lambda m: length(m.content)))"


@query(f"WITH {SQL_MESSAGES} SELECT conv_id, CAST({_CHARS} AS INTEGER) AS chars FROM msgs WHERE {_CHARS} <= 1000")
def character_filter(spark, sf):
    return M.content_filter(message_table(spark, sf), "messages", 1000).select("conv_id", M.total_chars(F.col("messages")).alias("chars"))


@query(f"WITH {SQL_MESSAGES} SELECT conv_id, {sql_messages('messages')} AS messages FROM msgs WHERE length(messages[1].content) <= 512")
def prompt_length_filter(spark, sf):
    return M.prompt_filter(message_table(spark, sf), "messages", 512).select("conv_id", show_messages(F.col("messages")).alias("messages"))


@query(
    f"WITH {SQL_PAIR_TOKENS} SELECT conv_id, CAST(len(chosen_ids) AS INTEGER) AS n_chosen, CAST(len(rejected_ids) AS INTEGER) AS n_rejected FROM ptoks WHERE len(chosen_ids) <= 200 AND len(rejected_ids) <= 200"
)
def pair_token_filter(spark, sf):
    df = pair_tokens(spark, sf).filter((F.size("chosen_ids") <= 200) & (F.size("rejected_ids") <= 200))
    return df.select("conv_id", F.size("chosen_ids").alias("n_chosen"), F.size("rejected_ids").alias("n_rejected"))


@query(f"WITH {SQL_TOKENS} SELECT doc_id, CAST(len(input_ids) AS INTEGER) AS lengths FROM toks WHERE len(input_ids) <= 512")
def token_length_filter(spark, sf):
    df = token_rows(spark, sf).withColumn("lengths", F.size("input_ids")).filter("lengths <= 512")
    return df.select("doc_id", "lengths")


_N_WORDS = f"coalesce(list_sum(list_transform({_ASKED}, lambda m: len({sql_words('m.content')}))), 0)"


@query(f"WITH {SQL_MESSAGES} SELECT conv_id, CAST({_N_WORDS} AS BIGINT) AS prompt_tokens FROM msgs WHERE len(messages) <= 6 AND {_N_WORDS} <= 400")
def prompt_budget_filter(spark, sf):
    counts = F.transform(M.prompt_of(F.col("messages")), lambda m: n_words(m.content).cast("long"))
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    df = message_table(spark, sf).withColumn("prompt_tokens", total)
    return budget_filter(df, F.col("prompt_tokens"), F.size("messages"), 400, 6).select("conv_id", "prompt_tokens")


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE NOT (l_linenumber = CAST(round(l_discount * 100) AS INTEGER) AND l_linenumber = CAST(round(l_tax * 100) AS INTEGER))"
)
def not_all_equal_filter(spark, sf):
    cents = lambda c: F.round(F.col(c) * 100).cast("int")
    df = table(spark, sf, "lineitem")
    kept = df.filter(M.not_all_equal([F.col("l_linenumber"), cents("l_discount"), cents("l_tax"), F.col("l_linenumber")]))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "SELECT p_partkey, p_size FROM part WHERE starts_with(p_name, 's') AND p_size < 40 AND p_retailprice < 1500 AND len(string_split(p_type, ' ')) > 0"
)
def simple_filters(spark, sf):
    df = table(spark, sf, "part")
    kept = df.filter(F.startswith("p_name", F.lit("s")) & (F.col("p_size") < 40) & (F.col("p_retailprice") < 1500))
    return kept.filter(F.size(F.split("p_type", " ")) > 0).select("p_partkey", "p_size")


@query(f"WITH {SQL_MESSAGES} SELECT conv_id FROM msgs WHERE list_contains(list_transform(messages, lambda m: m.role), 'system')")
def membership_filter(spark, sf):
    models = F.transform("messages", lambda m: m.role)
    return message_table(spark, sf).filter(F.array_contains(models, "system")).select("conv_id")


@query(
    f"""WITH {SQL_MESSAGES},
    c AS (SELECT conv_id, list_transform(messages, lambda m: m.role) AS roles, list_transform(messages, lambda m: len({sql_words('m.content')})) AS cnt, len(messages) AS n FROM msgs),
    w AS (SELECT *, coalesce(list_sum(CASE WHEN roles[n] = 'user' THEN cnt ELSE cnt[1:n-1] END), 0) AS whole FROM c),
    e AS (SELECT *, unnest(range(1, n + 1)) AS fin FROM w),
    s AS (SELECT *, unnest(range(1, fin + 1)) AS beg FROM e WHERE roles[fin] = roles[n]),
    v AS (SELECT * FROM s WHERE fin - beg + 1 <= 4
      AND (roles[n] <> 'assistant' OR list_contains(roles[beg:fin-1], 'user'))
      AND coalesce(list_sum(CASE WHEN roles[fin] = 'user' THEN cnt[beg:fin] ELSE cnt[beg:fin-1] END), 0) <= 150),
    g AS (SELECT conv_id, fin, min(beg) AS lo, max(beg) AS hi, row_number() OVER (PARTITION BY conv_id ORDER BY fin) - 1 AS r, count(*) OVER (PARTITION BY conv_id) AS k FROM v GROUP BY conv_id, fin),
    p AS (SELECT conv_id, lo + (conv_id * 31 + 7) % (hi - lo + 1) AS beg, fin FROM g WHERE r = (conv_id * 17 + 3) % k)
    SELECT w.conv_id, CAST(CASE WHEN w.n <= 4 AND w.whole <= 150 THEN 1 ELSE p.beg END AS INTEGER) AS "start",
    CAST(CASE WHEN w.n <= 4 AND w.whole <= 150 THEN w.n ELSE p.fin END AS INTEGER) AS "end"
    FROM w LEFT JOIN p USING (conv_id) WHERE (w.n <= 4 AND w.whole <= 150) OR p.fin IS NOT NULL"""
)
def budget_window(spark, sf):
    m = F.col("messages")
    df = message_table(spark, sf).select(
        "conv_id", F.transform(m, lambda x: x.role).alias("roles"), F.transform(m, lambda x: n_words(x.content).cast("long")).alias("counts")
    )
    key = F.col("conv_id")
    return window_to_budget(df, "roles", "counts", 150, 4, key * 17 + 3, key * 31 + 7).select("conv_id", "start", "end")


@query("SELECT doc_id, text FROM documents")
def column_pruning(spark, sf):
    return M.prune_to(documents(spark, sf), ["doc_id", "text", "input_ids", "completion_mask"])


@query(f"WITH {SQL_TOKENS} SELECT doc_id, CAST(len(input_ids) AS INTEGER) AS n, true AS processed FROM toks")
def processed_rows_kept(spark, sf):
    df = token_rows(spark, sf)
    prepared = df if schema.is_processed(df) else df.withColumn("input_ids", hashed_ids(F.col("text")))
    return prepared.select("doc_id", F.size("input_ids").alias("n"), F.lit(schema.is_processed(df)).alias("processed"))


# --- conversions ------------------------------------------------------------


@query(
    f"""WITH {SQL_ROLLOUTS}, {SQL_MESSAGES} SELECT prompt || completion AS text FROM rollouts
    UNION ALL SELECT {sql_messages('messages')} FROM msgs"""
)
def prompt_completion_to_lm(spark, sf):
    strings = convert.to_language_modeling(rollouts(spark, sf).select("prompt", "completion"))
    prompt, completion = M.split_last(F.col("messages"))
    lists = message_table(spark, sf).select(prompt.alias("prompt"), completion.alias("completion"))
    return strings.unionAll(convert.to_language_modeling(lists).select(show_messages(F.col("messages"))))


@query(f"WITH {SQL_ROLLOUTS} SELECT prompt FROM rollouts")
def prompt_completion_to_prompt_only(spark, sf):
    return convert.to_prompt_only(rollouts(spark, sf).select("prompt", "completion"))


def _implicit(spark, sf):
    return text_pairs(spark, sf).select("conv_id", *[F.concat("prompt", F.lit(" "), c).alias(c) for c in ("chosen", "rejected")])


# Shared start of two strings, by comparing characters one by one.
_SHARED = (
    "coalesce(nullif(list_position(list_transform(list_zip(string_split(c, ''), string_split(r, '')), "
    "lambda x: x[1] IS DISTINCT FROM x[2]), true), 0) - 1, least(length(c), length(r)))"
)
_SQL_IMPLICIT = (
    f"{SQL_TEXT_PAIRS}, imp AS (SELECT conv_id, prompt || ' ' || chosen AS c, prompt || ' ' || rejected AS r FROM tpairs), "
    f"sh AS (SELECT *, {_SHARED} AS s FROM imp), "
    "ex AS (SELECT conv_id, c, r, CASE WHEN s < least(length(c), length(r)) THEN CASE WHEN s > 0 AND substr(c, s, 1) = ' ' THEN s - 1 ELSE s END ELSE greatest(s - 1, 0) END AS k FROM sh)"
)


@query(
    f"WITH {_SQL_IMPLICIT} SELECT conv_id, substr(c, 1, k) AS prompt, substr(c, k + 1) AS chosen, substr(r, k + 1) AS rejected FROM ex"
)
def extract_text_prompt(spark, sf):
    return convert.extract_prompt(_implicit(spark, sf)).select("conv_id", "prompt", "chosen", "rejected")


@query(
    f"""WITH d AS (SELECT doc_id, text AS c, replace(text, ', ', ' , ') AS r FROM documents), sh AS (SELECT *, {_SHARED} AS s FROM d),
    ex AS (SELECT *, CASE WHEN s < least(length(c), length(r)) THEN CASE WHEN s > 0 AND substr(c, s, 1) = ' ' THEN s - 1 ELSE s END ELSE greatest(s - 1, 0) END AS k FROM sh)
    SELECT doc_id, CAST(k AS INTEGER) AS prompt_chars, md5(substr(c, 1, k)) AS prompt, md5(substr(c, k + 1)) AS chosen, md5(substr(r, k + 1)) AS rejected FROM ex"""
)
def extract_document_prompt(spark, sf):
    df = documents(spark, sf).select("doc_id", F.col("text").alias("chosen"), F.replace("text", F.lit(", "), F.lit(" , ")).alias("rejected"))
    df = convert.extract_prompt(df)
    return df.select("doc_id", F.length("prompt").alias("prompt_chars"), *[F.md5(c).alias(c) for c in ("prompt", "chosen", "rejected")])


def _implicit_messages(spark, sf):
    return preference_pairs(spark, sf).select("conv_id", *[F.concat("prompt", c).alias(c) for c in ("chosen", "rejected")])


@query(
    f"""WITH {SQL_PAIRS}, f AS (SELECT conv_id, prompt || chosen AS c, prompt || rejected AS r, len(prompt) AS k FROM pairs)
    SELECT conv_id, {sql_messages('c[1:k]')} AS prompt, {sql_messages('c[k+1:]')} AS chosen, {sql_messages('r[k+1:]')} AS rejected FROM f"""
)
def extract_message_prompt(spark, sf):
    df = convert.extract_prompt(_implicit_messages(spark, sf))
    return df.select("conv_id", *[show_messages(F.col(c)).alias(c) for c in ("prompt", "chosen", "rejected")])


@query(f"WITH {_SQL_IMPLICIT} SELECT 'lm' AS kind, NULL AS prompt, c AS completion, NULL::BOOLEAN AS label FROM ex UNION ALL "
       "SELECT 'prompt_completion', substr(c, 1, k), substr(c, k + 1), NULL FROM ex UNION ALL SELECT 'prompt_only', substr(c, 1, k), NULL, NULL FROM ex UNION ALL "
       "SELECT 'unpaired', substr(c, 1, k), substr(c, k + 1), true FROM ex UNION ALL SELECT 'unpaired', substr(c, 1, k), substr(r, k + 1), false FROM ex")
def implicit_preference_conversions(spark, sf):
    return _conversions(_implicit(spark, sf).drop("conv_id"))


def _conversions(df):
    """Every conversion of a dataset in one long table."""
    none = lambda t: F.lit(None).cast(t)
    lm = convert.to_language_modeling(df).select(F.lit("lm").alias("kind"), none("string").alias("prompt"), F.col("text").alias("completion"), none("boolean").alias("label"))
    pc = convert.to_prompt_completion(df).select(F.lit("prompt_completion").alias("kind"), "prompt", "completion", none("boolean").alias("label"))
    po = convert.to_prompt_only(df).select(F.lit("prompt_only").alias("kind"), "prompt", none("string").alias("completion"), none("boolean").alias("label"))
    parts = [lm, pc, po]
    if "label" not in df.columns:
        parts.append(convert.to_unpaired(df).select(F.lit("unpaired").alias("kind"), "prompt", "completion", "label"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"WITH {SQL_TEXT_PAIRS} SELECT 'lm' AS kind, NULL AS prompt, prompt || chosen AS completion, NULL::BOOLEAN AS label FROM tpairs UNION ALL "
       "SELECT 'prompt_completion', prompt, chosen, NULL FROM tpairs UNION ALL SELECT 'prompt_only', prompt, NULL, NULL FROM tpairs UNION ALL "
       "SELECT 'unpaired', prompt, chosen, true FROM tpairs UNION ALL SELECT 'unpaired', prompt, rejected, false FROM tpairs")
def preference_conversions(spark, sf):
    return _conversions(text_pairs(spark, sf).drop("conv_id"))


@query(f"WITH {SQL_TEXT_PAIRS} SELECT prompt || chosen AS chosen, prompt || rejected AS rejected FROM tpairs")
def preference_to_implicit(spark, sf):
    return convert.to_implicit_preference(text_pairs(spark, sf))


@query(f"WITH {SQL_UNPAIRED} SELECT 'lm' AS kind, NULL AS prompt, prompt || completion AS completion, NULL::BOOLEAN AS label FROM unpaired WHERE label UNION ALL "
       "SELECT 'prompt_completion', prompt, completion, NULL FROM unpaired WHERE label UNION ALL SELECT 'prompt_only', prompt, NULL, NULL FROM unpaired")
def unpaired_conversions(spark, sf):
    return _conversions(unpaired(spark, sf).drop("doc_id"))


_ALL = "len(list_filter(labels, lambda x: NOT x)) = 0"
_JOINED = "coalesce(array_to_string(completions, ''), '')"


@query(f"WITH {SQL_STEPWISE} SELECT 'lm' AS kind, NULL AS prompt, prompt || {_JOINED} AS completion, NULL::BOOLEAN AS label FROM stepwise WHERE {_ALL} UNION ALL "
       f"SELECT 'prompt_completion', prompt, {_JOINED}, NULL FROM stepwise WHERE {_ALL} UNION ALL SELECT 'prompt_only', prompt, NULL, NULL FROM stepwise UNION ALL "
       f"SELECT 'unpaired', prompt, {_JOINED}, {_ALL} FROM stepwise")
def stepwise_conversions(spark, sf):
    return _conversions(stepwise(spark, sf).drop("doc_id"))


@query(f"WITH {SQL_TEXT_PAIRS} SELECT conv_id, prompt, chosen AS completion, true AS label FROM tpairs UNION ALL SELECT conv_id, prompt, rejected, false FROM tpairs")
def unpair_rows(spark, sf):
    return convert.maybe_unpair(text_pairs(spark, sf))


@query(
    f"WITH {SQL_STEPWISE} SELECT doc_id, prompt, CAST(generate_subscripts(completions, 1) - 1 AS INTEGER) AS step, unnest(completions) AS completion, unnest(labels) AS label FROM stepwise"
)
def explode_steps(spark, sf):
    return convert.explode_steps(stepwise(spark, sf))


@query(f"WITH {SQL_PAIRS} SELECT conv_id, {sql_render('prompt || chosen', 'simple')} AS chosen FROM pairs")
def explicit_prompt_kept(spark, sf):
    # Prompt and chosen are both messages, so nothing is extracted.
    df = convert.maybe_extract_prompt(preference_pairs(spark, sf))
    return df.select("conv_id", render_chat(F.concat("prompt", "chosen"), "simple").alias("chosen"))
