"""Conversation text in a fixed set of styles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunetable.functions.binding import let


@dataclass(frozen=True)
class ChatStyle:
    """How one message opens and closes, and the header that asks for an answer."""

    open: Callable[[Column], Column]
    close: str
    ask: str


# The texts each style puts around a message.
STYLES = {
    "im": ChatStyle(lambda role: F.concat(F.lit("<|im_start|>"), role, F.lit("\n")), "<|im_end|>\n", "<|im_start|>assistant\n"),
    "simple": ChatStyle(lambda role: F.concat(F.initcap(role), F.lit(": ")), "\n\n", "Assistant:"),
    "plain": ChatStyle(lambda role: F.concat(role, F.lit(": ")), "\n", "assistant: "),
}


# How tools, calls and an empty reasoning block are written.
TOOLS_OPEN, TOOLS_CLOSE = "# Tools\n\n<tools>\n", "\n</tools>"
CALL_OPEN, CALL_CLOSE = "<tool_call>\n", "\n</tool_call>"
NO_THINKING = "<think>\n\n</think>\n\n"


def _call_text(call: Column) -> Column:
    """``{"name": ..., "arguments": ...}``; the arguments are JSON already."""
    name = F.to_json(F.struct(F.coalesce(call["name"], F.lit("")).alias("name")))
    return F.concat(
        F.lit(CALL_OPEN), F.substr(name, F.lit(1), F.length(name) - 1), F.lit(',"arguments":'), F.coalesce(call["arguments"], F.lit("{}")), F.lit("}" + CALL_CLOSE)
    )


def calling_chat(messages: Column) -> Column:
    """Plain messages from ones with ``name`` and ``tool_calls``: a name joins the role, calls follow the content."""

    def plain(m: Column) -> Column:
        calls = F.transform(F.coalesce(m["tool_calls"], F.array().cast("array<struct<name:string,arguments:string>>")), _call_text)
        parts = F.concat(F.array(F.nullif(m["content"], F.lit(""))), calls)
        return F.struct(F.concat_ws(" ", m["role"], m["name"]).alias("role"), F.array_join(F.array_compact(parts), "\n").alias("content"))

    return F.transform(messages, plain)


def _tools_message(tools: Column) -> Column:
    """A system message listing the tools' JSON schemas, one a line; no message for no tools."""
    listed = F.struct(F.lit("system").alias("role"), F.concat(F.lit(TOOLS_OPEN), F.array_join(tools, "\n"), F.lit(TOOLS_CLOSE)).alias("content"))
    return F.when(F.size(tools) > 0, F.array(listed)).otherwise(F.array().cast("array<struct<role:string,content:string>>"))


def render_chat(messages: Column, style: str = "im", ask: bool = False, tools: Column | None = None, options: Column | None = None) -> Column:
    """The whole conversation as text, with a generation header if ``ask``.

    ``tools`` lists JSON schemas to announce first. ``options`` is a row's map of template options:
    ``enable_thinking`` set to ``false`` closes the reasoning block behind the header.
    """
    s = STYLES[style]
    if tools is not None:
        messages = F.concat(_tools_message(tools), messages)
    parts = F.transform(messages, lambda m: F.concat(s.open(m.role), m.content, F.lit(s.close)))
    text = F.array_join(parts, "")
    return F.concat(text, _ask(s, options)) if ask else text


def _ask(style: ChatStyle, options: Column | None) -> Column:
    if options is None:
        return F.lit(style.ask)
    silent = F.coalesce(F.try_element_at(options, F.lit("enable_thinking")) == "false", F.lit(False))
    return F.when(silent, F.lit(style.ask + NO_THINKING)).otherwise(F.lit(style.ask))


def render_prompt(messages: Column, style: str = "im", tools: Column | None = None, options: Column | None = None) -> Column:
    """Prompt text: a header after a user or tool turn, an open end after an assistant turn.

    A speaker's name behind the role does not count.
    """
    s = STYLES[style]
    role = F.substring_index(F.try_element_at(messages, F.lit(-1)).role, " ", 1)
    whole = render_chat(messages, style, tools=tools)
    return (
        F.when(role.isin("user", "tool"), F.concat(whole, _ask(s, options)))
        .when(role == "assistant", F.substr(whole, F.lit(1), F.length(whole) - len(s.close)))
        .otherwise(F.raise_error(F.concat(F.lit("a prompt cannot end with the role "), F.coalesce(role, F.lit("none")))))
    )


def common_prefix_length(a: Column, b: Column) -> Column:
    """Characters two strings share at their start, found by halving."""

    def search(p: Column) -> Column:
        shorter = F.least(F.length(p.a), F.length(p.b))
        # Halving an interval of n needs about log2(n) steps; one more settles the border.
        steps = F.sequence(F.lit(0), F.ceil(F.log2(shorter + 1)).cast("int"))
        start = F.struct(F.lit(0).alias("same"), shorter.alias("top"))

        def halve(s: Column, _: Column) -> Column:
            mid = F.ceil((s.same + s.top) / 2).cast("int")
            hit = F.substr(p.a, F.lit(1), mid) == F.substr(p.b, F.lit(1), mid)
            return F.struct(
                F.when(hit, mid).otherwise(s.same).alias("same"),
                F.when(hit, s.top).otherwise(F.greatest(mid - 1, s.same)).alias("top"),
            )

        return F.aggregate(steps, start, halve, lambda s: s.same)

    return let(F.struct(a.alias("a"), b.alias("b")), search)


def render_pair(
    prompt: Column, completion: Column, style: str = "im", tools: Column | None = None, options: Column | None = None
) -> tuple[Column, Column]:
    """Prompt and completion text; the prompt is cut to what both renderings share."""
    prompt_text = render_prompt(prompt, style, tools, options)
    full = render_chat(F.concat(prompt, completion), style, tools=tools)
    shared = F.when(F.startswith(full, prompt_text), F.length(prompt_text)).otherwise(common_prefix_length(prompt_text, full))
    return F.substr(full, F.lit(1), shared), F.substr(full, shared + 1, F.length(full))


def prompt_and_completion_text(messages: Column, end_marker: str, style: str = "im") -> tuple[Column, Column, Column]:
    """``(prompt, full, completion)`` texts with the last assistant turn as the completion."""
    size = F.size(messages)
    answered = F.coalesce(F.try_element_at(messages, F.lit(-1)).role == "assistant", F.lit(False))
    prompt = render_chat(F.when(answered, F.slice(messages, 1, F.greatest(size - 1, F.lit(0)))).otherwise(messages), style, ask=True)
    full = render_chat(messages, style)
    completion = (
        F.when(F.startswith(full, prompt), F.substr(full, F.length(prompt) + 1, F.length(full)))
        .when(answered, F.concat(F.try_element_at(messages, F.lit(-1)).content, F.lit(end_marker)))
        .otherwise("")
    )
    return prompt, full, completion


def strip_repeated_header(prompt: Column, completion: Column, header: str = "<|im_start|>assistant") -> Column:
    """Drop an assistant header from a completion when the prompt already ends with it."""
    ends = F.endswith(F.regexp_replace(prompt, r"\s+\z", ""), F.lit(header))
    body = F.regexp_replace(completion, r"\A\s+", "")
    rest = F.substr(body, F.lit(len(header) + 1), F.length(body))
    rest = F.when(F.startswith(rest, F.lit("\n")), F.substr(rest, F.lit(2), F.length(rest))).otherwise(rest)
    return F.when(ends & F.startswith(body, F.lit(header)), rest).otherwise(completion)


def append_end(text: Column, end_marker: str) -> Column:
    return F.when(F.endswith(text, F.lit(end_marker)), text).otherwise(F.concat(text, F.lit(end_marker)))
