"""Conversations written by templates that are data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunetable.functions import templates as T
from tunetable.functions.binding import let
from tunetable.plans.inputs import SQL_MESSAGES, SQL_PAIRS, message_table, preference_pairs, sql_last_index
from tunetable.plans.registry import query

_IM = "<|im_start|>"
_RESULT = "<tool_response>\n"

FOLDED = T.template(
    {
        "name": "folded",
        "start": "<s>",
        "rules": [
            {"role": "system", "open": "[INST] <<SYS>>\n", "close": "\n<</SYS>>\n\n", "first": True, "before": "user"},
            {"role": "system", "open": "[INST] <<SYS>>\n", "close": "\n<</SYS>> [/INST]"},
            {"role": "user", "after": "system", "first": False, "close": " [/INST]", "trim": True},
            {"role": "user", "open": "[INST] ", "close": " [/INST]", "trim": True},
            {"role": "assistant", "open": " ", "close": " </s>", "trim": True},
            {"open": "[{role}] ", "close": " [/{role}]"},
        ],
    }
)
REASONING = T.template(
    {
        "name": "reasoning",
        "rules": [
            {"role": "tool", "after": "!tool", "before": "!tool", "open": f"{_IM}user\n{_RESULT}", "close": "\n</tool_response><|im_end|>\n"},
            {"role": "tool", "after": "!tool", "open": f"{_IM}user\n{_RESULT}", "close": "\n</tool_response>"},
            {"role": "tool", "before": "!tool", "open": f"\n{_RESULT}", "close": "\n</tool_response><|im_end|>\n"},
            {"role": "tool", "open": f"\n{_RESULT}", "close": "\n</tool_response>"},
            {"role": "assistant", "late": True, "lacks": "</think>", "open": f"{_IM}assistant\n<think>\n\n</think>\n\n", "close": "<|im_end|>\n"},
            {"role": "assistant", "late": False, "reasoning": False, "open": f"{_IM}assistant\n", "close": "<|im_end|>\n"},
            {"open": _IM + "{role}\n", "close": "<|im_end|>\n"},
        ],
        "asks": [
            {"text": f"{_IM}assistant\n<think>\n\n</think>\n\n", "option": "enable_thinking", "value": "false"},
            {"text": f"{_IM}assistant\n"},
        ],
        "tools_open": "# Tools\n",
    }
)
TITLED = T.template({"name": "titled", "system": "Be brief.", "end": "<eos>", "rules": [{"open": "{Role}: ", "close": "\n"}], "asks": [{"text": "Assistant:"}]})
TEMPLATES = {t.name: t for t in (FOLDED, REASONING, TITLED)}


def marked(messages: Column) -> Column:
    """The messages with tool turns (lengths divisible by 5, not the first) and reasoning before even-sized answers."""

    def one(m: Column, i: Column) -> Column:
        n = F.length(m.content)
        role = F.when((i > 0) & (n % 5 == 0), F.lit("tool")).otherwise(m.role)
        thought = F.concat(F.lit("<think>\n"), n.cast("string"), F.lit("\n</think>\n\n"), m.content)
        return F.struct(role.alias("role"), F.when((role == "assistant") & (n % 2 == 0), thought).otherwise(m.content).alias("content"))

    return F.transform(messages, one)


_SQL_MARKED = f"""{SQL_MESSAGES}, roles AS (SELECT conv_id, list_transform(messages, lambda m, i: {{'role':
    CASE WHEN i > 1 AND length(m.content) % 5 = 0 THEN 'tool' ELSE m.role END, 'content': m.content}}) AS messages FROM msgs),
    marked AS (SELECT conv_id, list_transform(messages, lambda m: {{'role': m.role, 'content':
    CASE WHEN m.role = 'assistant' AND length(m.content) % 2 = 0 THEN '<think>' || chr(10) || length(m.content) || chr(10) || '</think>' || chr(10) || chr(10) || m.content
    ELSE m.content END}}) AS messages FROM roles)"""


def _q(text: str) -> str:
    return " || chr(10) || ".join("'" + x + "'" for x in text.split("\n"))


def _joined(body: str, messages: str) -> str:
    return f"coalesce(array_to_string(list_transform({messages}, lambda m, i: {body}), ''), '')"


def sql_folded(c: str) -> str:
    trimmed = "regexp_replace(m.content, '^\\s+|\\s+$', '', 'g')"
    return _q("<s>") + " || " + _joined(
        f"""CASE m.role WHEN 'system' THEN {_q('[INST] <<SYS>>' + chr(10))} || m.content || CASE WHEN i = 1 AND coalesce({c}[i + 1].role, '') = 'user'
        THEN {_q(chr(10) + '<</SYS>>' + chr(10) * 2)} ELSE {_q(chr(10) + '<</SYS>> [/INST]')} END
        WHEN 'user' THEN CASE WHEN i > 1 AND {c}[i - 1].role = 'system' THEN '' ELSE '[INST] ' END || {trimmed} || ' [/INST]'
        WHEN 'assistant' THEN ' ' || {trimmed} || ' </s>' ELSE '[' || m.role || '] ' || m.content || ' [/' || m.role || ']' END""",
        c,
    )


def sql_reasoning(c: str, training: bool = False) -> str:
    late = "TRUE" if training else f"i > coalesce({sql_last_index(c, chr(109) + '.role = ' + chr(39) + 'user' + chr(39))}, 0)"
    opens, closes = f"i > 1 AND {c}[i - 1].role = 'tool'", "FALSE" if training else f"coalesce({c}[i + 1].role, '') = 'tool'"
    return _joined(
        f"""CASE WHEN m.role = 'tool' THEN CASE WHEN {opens} THEN '' ELSE {_q(_IM + 'user')} END || {_q((chr(10)) + _RESULT)} || m.content || {_q(chr(10) + '</tool_response>')}
        || CASE WHEN {closes} THEN '' ELSE {_q('<|im_end|>' + chr(10))} END
        ELSE '{_IM}' || m.role || chr(10) || CASE WHEN m.role <> 'assistant' THEN m.content
        WHEN {late} THEN CASE WHEN contains(m.content, '</think>') THEN '' ELSE {_q('<think>' + chr(10) * 2 + '</think>' + chr(10) * 2)} END || m.content
        ELSE regexp_replace(m.content, '^.*</think>\\n*', '', 's') END || {_q('<|im_end|>' + chr(10))} END""",
        c,
    )


def sql_titled(c: str) -> str:
    with_system = f"CASE WHEN {c}[1].role = 'system' THEN {c} ELSE list_concat([{{'role': 'system', 'content': 'Be brief.'}}], {c}) END"
    return _joined("upper(m.role[1]) || m.role[2:] || ': ' || m.content || chr(10)", with_system)


@query(
    f"""WITH {_SQL_MARKED}, texts AS (SELECT conv_id, CASE conv_id % 3 WHEN 0 THEN {sql_folded('messages')} WHEN 1 THEN {sql_reasoning('messages')}
    ELSE {sql_titled('messages')} END AS body FROM marked)
    SELECT conv_id, ['folded', 'reasoning', 'titled'][conv_id % 3 + 1] AS template, body || CASE WHEN conv_id % 3 = 2 THEN '<eos>' ELSE '' END AS text,
    body || CASE conv_id % 3 WHEN 0 THEN '' WHEN 1 THEN {_q(_IM + 'assistant' + chr(10))} ELSE 'Assistant:' END AS asked FROM texts"""
)
def templated_chats(spark, sf):
    name = F.element_at(F.array(*[F.lit(n) for n in TEMPLATES]), (F.col("conv_id") % 3 + 1).cast("int"))
    rows = message_table(spark, sf).select("conv_id", name.alias("template"), marked(F.col("messages")).alias("messages"))
    text = lambda ask: T.render_by_name(TEMPLATES, F.col("template"), F.col("messages"), ask=ask)
    return rows.select("conv_id", "template", text(False).alias("text"), text(True).alias("asked"))


@query(
    f"""WITH {SQL_PAIRS}, texts AS (SELECT conv_id, {sql_reasoning('prompt')} || {_q(_IM + 'assistant' + chr(10))} AS prompt, {sql_reasoning('(prompt || chosen)')} AS chosen,
    {sql_reasoning('(prompt || rejected)')} AS rejected FROM pairs WHERE len(prompt) > 0 AND prompt[-1].role = 'user')
    SELECT conv_id, prompt, substr(chosen, length(prompt) + 1) AS chosen, substr(rejected, length(prompt) + 1) AS rejected FROM texts"""
)
def templated_pairs(spark, sf):
    df = preference_pairs(spark, sf).filter(F.coalesce(F.try_element_at("prompt", F.lit(-1)).role == "user", F.lit(False)))
    prompt, chosen, rejected = T.pair_with(REASONING, F.col("prompt"), F.col("chosen"), F.col("rejected"))
    return df.select("conv_id", prompt.alias("prompt"), chosen.alias("chosen"), rejected.alias("rejected"))


@query(
    f"""WITH {_SQL_MARKED}, texts AS (SELECT conv_id, messages, {sql_reasoning('messages')} AS full_text, {sql_reasoning('messages[1:len(messages)-1]')} AS start_text,
    {sql_reasoning('messages', training=True)} AS train_text, {sql_reasoning('messages[1:len(messages)-1]', training=True)} AS train_start,
    list_filter(messages, lambda m: m.role = 'assistant') AS said FROM marked)
    SELECT conv_id, starts_with(full_text, start_text) AS kept, starts_with(train_text, train_start) AS kept_in_training,
    CAST(length(train_text) AS BIGINT) AS chars, CAST(coalesce(list_sum(list_transform(said, lambda m: length(m.content) + 11)), 0) AS BIGINT) AS said_chars FROM texts"""
)
def template_prefixes(spark, sf):
    """Whether the conversation without its last message begins the whole one, by the template and its training
    variant, and how much of the latter the model has to say."""
    training = T.training_variant(REASONING)
    rows = message_table(spark, sf).select("conv_id", marked(F.col("messages")).alias("messages"))
    m, size = F.col("messages"), F.size("messages") - 1
    count = lambda turns: F.aggregate(
        turns,
        F.struct(F.lit(0).cast("long").alias("chars"), F.lit(0).cast("long").alias("said")),
        lambda s, x: let(
            (F.length(x["body"]) + F.length(x["close"])).cast("long"),
            lambda n: F.struct((s["chars"] + n + F.length(x["open"])).alias("chars"), (s["said"] + F.when(x["role"] == "assistant", n).otherwise(0)).alias("said")),
        ),
    )
    rows = rows.withColumn("n", count(T.turns_with(training, m)))
    return rows.select(
        "conv_id", T.prefix_kept(REASONING, m, size).alias("kept"), T.prefix_kept(training, m, size).alias("kept_in_training"),
        F.col("n.chars").alias("chars"), F.col("n.said").alias("said_chars"),
    )
