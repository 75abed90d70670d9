"""Chat templates as data: headers, separators and conditions, compiled into one expression.

A template is a list of rules. The first rule that fits a message writes what stands before and
behind its content; a message that no rule fits is an error. Conditions look at the role, the
neighbours' roles, the place in the conversation, the content and a row's options, which is what
templates of published models decide by: system texts folded into the first user turn,
tool results grouped in one turn, reasoning kept in the last exchange only.

Templates come from dicts (JSON) or from the rows of a small table, are checked when they are
read, and become array expressions: rendering is row work without a shuffle and without Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.functions.binding import let
from tunetable.functions.render import common_prefix_length

# A table of templates may have this many rows; they become one expression.
MOST_RULES = 1000

_MESSAGES = "array<struct<role:string,content:string>>"
_REASONING = r"(?s)^.*</think>\n*"


@dataclass(frozen=True)
class Rule:
    """What is written around a message, and when.

    ``open`` and ``close`` may hold ``{role}`` and ``{Role}`` (capitalised). ``role``, ``after`` (the
    message before) and ``before`` (the message behind) are a role, ``!role`` for any other or none, or ``*``.
    ``first``, ``last`` and ``late`` (behind the last user message), where given, must hold as given.
    ``holds`` is a text the content must contain, ``lacks`` one it must not. ``option`` and ``value`` ask for an
    entry of the row's options. ``trim`` cuts white space off the content, ``reasoning=False`` cuts all up to
    ``</think>``.
    """

    role: str = "*"
    open: str = ""
    close: str = ""
    after: str = "*"
    before: str = "*"
    first: bool | None = None
    last: bool | None = None
    late: bool | None = None
    holds: str | None = None
    lacks: str | None = None
    option: str | None = None
    value: str | None = None
    trim: bool = False
    reasoning: bool = True

    @property
    def looks_ahead(self) -> bool:
        """Whether a later message can change what this rule writes."""
        return self.before != "*" or self.last is not None or self.late is not None


@dataclass(frozen=True)
class Ask:
    """The header that asks for an answer; the first that fits is written."""

    text: str
    option: str | None = None
    value: str | None = None


@dataclass(frozen=True)
class Template:
    """``start`` and ``end`` stand around the conversation. ``system`` is the system text of conversations that bring
    none. Tools, where a row has any, join the system text: ``tools_open``, the schemas by ``tools_between``, ``tools_close``."""

    name: str
    rules: tuple[Rule, ...]
    asks: tuple[Ask, ...] = ()
    start: str = ""
    end: str = ""
    system: str | None = None
    tools_open: str = ""
    tools_between: str = "\n"
    tools_close: str = ""


def template(entry: Mapping) -> Template:
    """A template from a dict, as JSON gives it; unknown fields and templates without rules are errors."""
    entry = dict(entry)
    rules = tuple(_made(Rule, r) for r in entry.pop("rules", ()))
    asks = tuple(_made(Ask, a) for a in entry.pop("asks", ()))
    made = _made(Template, entry | {"rules": rules, "asks": asks})
    if not rules:
        raise ValueError(f"template {made.name!r} has no rules")
    return made


def _made(kind: type, entry: Mapping):
    names = {f.name for f in fields(kind)}
    if strange := set(entry) - names:
        raise ValueError(f"unknown {kind.__name__.lower()} fields: {', '.join(sorted(strange))}")
    made = kind(**entry)
    if getattr(made, "value", None) is not None and made.option is None:
        raise ValueError("a value needs an option")
    return made


def templates_from_table(table: DataFrame) -> dict[str, Template]:
    """Templates from rows ``template, part, place`` and any fields of :class:`Rule`.

    ``part`` is ``rule`` or ``ask`` (its text in ``open``), taken in the order of ``place``, or ``start``, ``end``,
    ``system``, ``tools_open``, ``tools_between``, ``tools_close`` (text in ``open``). NULL fields keep their defaults.
    More than ``MOST_RULES`` rows are an error.
    """
    rows = table.limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"a table of templates has at most {MOST_RULES} rows")
    entries: dict[str, dict] = {}
    rule_fields = {f.name for f in fields(Rule)} & set(table.columns)
    for row in sorted(rows, key=lambda r: (r["template"], r["place"] or 0)):
        entry = entries.setdefault(row["template"], {"name": row["template"], "rules": [], "asks": []})
        given = {k: row[k] for k in rule_fields if row[k] is not None}
        if row["part"] == "rule":
            entry["rules"].append(given)
        elif row["part"] == "ask":
            entry["asks"].append({"text": given.pop("open", "")} | given)
        else:
            entry[row["part"]] = given.get("open", "")
    return {name: template(entry) for name, entry in entries.items()}


def keeps_prefixes(t: Template) -> bool:
    """Whether no later message changes how an earlier one is written, whatever the conversation."""
    return not t.end and not any(r.looks_ahead for r in t.rules)


def training_variant(t: Template) -> Template:
    """The template with every turn written as if it were the last: rules bound to an earlier place go, the others
    forget theirs. Such a template keeps prefixes, so each turn's text is the same in every training row."""
    kept = [r for r in t.rules if r.last is not False and r.late is not False]
    rules = tuple(replace(r, before="*", last=None, late=None) for r in kept if r.before == "*" or r.before.startswith("!"))
    if not rules:
        raise ValueError(f"template {t.name!r} has no rule for a last turn")
    return replace(t, rules=rules, end="")


# --- compiling --------------------------------------------------------------


def _literal(text: str, role: Column) -> Column:
    """``text`` with the role in its places."""
    parts: list[Column] = []
    for i, piece in enumerate(text.split("{role}")):
        parts += [role] if i else []
        for j, plain in enumerate(piece.split("{Role}")):
            parts += [F.initcap(role)] if j else []
            parts += [F.lit(plain)] if plain else []
    return F.concat(*parts) if parts else F.lit("")


def _is_role(wanted: str, role: Column) -> Column | None:
    if wanted == "*":
        return None
    if wanted.startswith("!"):
        return ~F.coalesce(role == wanted[1:], F.lit(False))
    return F.coalesce(role == wanted, F.lit(False))


def _chosen(option: str | None, value: str | None, options: Column | None) -> Column | None:
    if option is None:
        return None
    if options is None:
        return F.lit(False)
    entry = F.try_element_at(options, F.lit(option))
    return entry.isNotNull() if value is None else F.coalesce(entry == value, F.lit(False))


def _all(conditions: Iterable[Column | None]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out if c is None else out & c
    return out


def _fits(rule: Rule, chat: Column, m: Column, i: Column, options: Column | None) -> Column:
    conditions = [_is_role(rule.role, m["role"]), _chosen(rule.option, rule.value, options)]
    if rule.after != "*":
        conditions.append(_is_role(rule.after, F.get(chat["messages"], i - 1)["role"]))
    if rule.before != "*":
        conditions.append(_is_role(rule.before, F.get(chat["messages"], i + 1)["role"]))
    if rule.first is not None:
        conditions.append((i == 0) == F.lit(rule.first))
    if rule.last is not None:
        conditions.append((i == chat["size"] - 1) == F.lit(rule.last))
    if rule.late is not None:
        conditions.append((i >= chat["late"]) == F.lit(rule.late))
    if rule.holds is not None:
        conditions.append(F.contains(m["content"], F.lit(rule.holds)))
    if rule.lacks is not None:
        conditions.append(~F.contains(m["content"], F.lit(rule.lacks)))
    return _all(conditions)


def _written(rule: Rule, m: Column) -> Column:
    body = m["content"]
    if not rule.reasoning:
        body = F.regexp_replace(body, _REASONING, "")
    if rule.trim:
        body = F.regexp_replace(body, r"\A\s+|\s+\z", "")
    return F.struct(
        m["role"].alias("role"), _literal(rule.open, m["role"]).alias("open"), body.alias("body"), _literal(rule.close, m["role"]).alias("close")
    )


def _with_system(t: Template, messages: Column, tools: Column | None) -> Column:
    """The messages with the default system text and the tools; the given ones where there is neither."""
    entry = lambda c: F.array(F.struct(F.lit("system").alias("role"), c.alias("content")))
    messages = F.coalesce(messages, F.array().cast(_MESSAGES))
    messages = F.transform(
        messages, lambda m: F.struct(F.coalesce(m["role"], F.lit("")).alias("role"), F.coalesce(m["content"], F.lit("")).alias("content"))
    )
    opened = lambda m: F.coalesce(F.get(m, F.lit(0))["role"] == "system", F.lit(False))
    if t.system is not None:
        messages = let(messages, lambda m: F.when(opened(m), m).otherwise(F.concat(entry(F.lit(t.system)), m)))
    if tools is None:
        return messages
    listed = F.concat(F.lit(t.tools_open), F.array_join(tools, t.tools_between), F.lit(t.tools_close))

    def announced(m: Column) -> Column:
        own = F.get(m, F.lit(0))["content"]
        joined = F.when(own == "", listed).otherwise(F.concat(own, F.lit("\n\n"), listed))
        rest = F.slice(m, F.lit(2), F.greatest(F.size(m) - 1, F.lit(0)))
        return F.when(opened(m), F.concat(entry(joined), rest)).otherwise(F.concat(entry(listed), m))

    return let(messages, lambda m: F.when(F.coalesce(F.size(tools), F.lit(0)) > 0, announced(m)).otherwise(m))


def turns_with(t: Template, messages: Column, tools: Column | None = None, options: Column | None = None) -> Column:
    """``array<struct<role, open, body, close>>``: what the template writes, message by message.

    ``body`` and ``close`` of an assistant turn are what the model has to say; tokenising the pieces one by one gives
    a mask over exactly that text. NULL roles and contents are empty, NULL messages are none.
    """

    def write(chat: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            out = None
            for rule in t.rules:
                fits, text = _fits(rule, chat, m, i, options), _written(rule, m)
                out = F.when(fits, text) if out is None else out.when(fits, text)
            return out.otherwise(F.raise_error(F.concat(F.lit(f"template {t.name} has no rule for the role "), m["role"])))

        return F.transform(chat["messages"], one)

    def placed(m: Column) -> Column:
        size = F.size(m)
        # The place behind the last user message, 0 if there is none.
        back = F.array_position(F.reverse(F.transform(m, lambda x: x["role"] == "user")), True)
        late = F.when(back > 0, size - back + 1).otherwise(F.lit(0))
        return F.struct(m.alias("messages"), size.alias("size"), late.alias("late"))

    return let(let(_with_system(t, messages, tools), placed), write)


def _asked(t: Template, options: Column | None) -> Column:
    out = None
    for a in t.asks:
        fits = _all([_chosen(a.option, a.value, options)])
        out = F.when(fits, F.lit(a.text)) if out is None else out.when(fits, F.lit(a.text))
    return F.lit("") if out is None else out.otherwise("")


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(x["open"], x["body"], x["close"])), "")


def render_with(t: Template, messages: Column, ask: bool = False, tools: Column | None = None, options: Column | None = None) -> Column:
    """The whole conversation as text; with ``ask`` a header for the answer in place of ``end``."""
    tail = _asked(t, options) if ask else F.lit(t.end)
    return F.concat(F.lit(t.start), _joined(turns_with(t, messages, tools, options)), tail)


def render_by_name(templates: Mapping[str, Template], name: Column, messages: Column, **how) -> Column:
    """Each row by the template it names; an unknown or missing name is an error."""
    out = None
    for key, t in templates.items():
        text = render_with(t, messages, **how)
        out = F.when(name == key, text) if out is None else out.when(name == key, text)
    unknown = F.raise_error(F.concat(F.lit("no template "), F.coalesce(name, F.lit("named"))))
    return unknown.cast("string") if out is None else out.otherwise(unknown)


def prompt_with(t: Template, messages: Column, tools: Column | None = None, options: Column | None = None) -> Column:
    """Prompt text: a header behind a user or tool turn, an open end behind an assistant turn, an error behind others."""

    def close_off(turns: Column) -> Column:
        last = F.try_element_at(turns, F.lit(-1))
        ahead = F.slice(turns, F.lit(1), F.greatest(F.size(turns) - 1, F.lit(0)))
        return (
            F.when(last["role"].isin("user", "tool"), F.concat(F.lit(t.start), _joined(turns), _asked(t, options)))
            .when(last["role"] == "assistant", F.concat(F.lit(t.start), _joined(ahead), last["open"], last["body"]))
            .otherwise(F.raise_error(F.concat(F.lit("a prompt cannot end with the role "), F.coalesce(last["role"], F.lit("none")))))
        )

    return let(turns_with(t, messages, tools, options), close_off)


def pair_with(
    t: Template, prompt: Column, *completions: Column, tools: Column | None = None, options: Column | None = None
) -> tuple[Column, ...]:
    """The prompt's text, cut to what it shares with every whole text, and the texts of the completions behind it."""
    whole = [render_with(t, F.concat(prompt, c), tools=tools, options=options) for c in completions]
    places = range(1, len(whole) + 1)

    def shorter(x: Column) -> Column:
        return F.when(F.startswith(x["w"], x["p"]), x["p"]).otherwise(F.substr(x["p"], F.lit(1), common_prefix_length(x["p"], x["w"])))

    def cut(texts: Column) -> Column:
        shared = F.get(texts, F.lit(0))
        for i in places:
            shared = let(F.struct(shared.alias("p"), F.get(texts, F.lit(i)).alias("w")), shorter)
        rest = lambda p, w: F.substr(w, F.length(p) + 1, F.length(w))
        return let(shared, lambda p: F.array(p, *[rest(p, F.get(texts, F.lit(i))) for i in places]))

    both = let(F.array(prompt_with(t, prompt, tools, options), *whole), cut)
    return tuple(F.get(both, F.lit(i)) for i in range(len(whole) + 1))


def prefix_kept(t: Template, messages: Column, size: Column, tools: Column | None = None, options: Column | None = None) -> Column:
    """Whether the first ``size`` messages are written the same alone and as the start of the whole conversation."""
    alone = F.concat(F.lit(t.start), _joined(turns_with(t, F.slice(messages, F.lit(1), size), tools, options)))
    return F.startswith(render_with(t, messages, tools=tools, options=options), alone)
