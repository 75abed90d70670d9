import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tunetable.functions import templates as T
from tunetable.plans.templates import FOLDED, REASONING, TITLED

CHAT = "array<struct<role:string,content:string>>"


def chats(spark, *rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"id long, m {CHAT}").orderBy("id")


def texts(df, column):
    return [r[0] for r in df.select(column).collect()]


def plainly(t, messages, ask=False, options=None):
    """The same template by a loop over one conversation."""
    messages = [(r or "", c or "") for r, c in messages or []]
    if t.system is not None and (not messages or messages[0][0] != "system"):
        messages = [("system", t.system)] + messages
    late = max([i + 1 for i, (r, _) in enumerate(messages) if r == "user"], default=0)
    fits = lambda wanted, role: wanted == "*" or (role != wanted[1:] if wanted[0] == "!" else role == wanted)
    out = t.start
    for i, (role, text) in enumerate(messages):
        before, behind = (messages[i - 1][0] if i else None), (messages[i + 1][0] if i + 1 < len(messages) else None)
        for rule in t.rules:
            given = [(rule.first, i == 0), (rule.last, i == len(messages) - 1), (rule.late, i >= late)]
            if not (fits(rule.role, role) and fits(rule.after, before) and fits(rule.before, behind)):
                continue
            if any(want is not None and want != have for want, have in given):
                continue
            if (rule.holds and rule.holds not in text) or (rule.lacks and rule.lacks in text):
                continue
            body = text if rule.reasoning else re.sub(r"(?s)^.*</think>\n*", "", text, count=1)
            body = body.strip() if rule.trim else body
            named = lambda s: s.replace("{role}", role).replace("{Role}", role.title())
            out += named(rule.open) + body + named(rule.close)
            break
        else:
            raise AssertionError(f"no rule for {role}")
    if not ask:
        return out + t.end
    for a in t.asks:
        if a.option is None or (options or {}).get(a.option) == a.value:
            return out + a.text
    return out


@pytest.mark.parametrize("t", [FOLDED, REASONING, TITLED], ids=lambda t: t.name)
def test_random_chats_match_a_plain_loop(spark, t):
    rng = random.Random(5)
    said = ["", " hi ", "<think>\nso\n</think>\n\nyes", "a\nb", "</think>", "é🙂", None]
    rows = [[(rng.choice(["user", "assistant", "tool", "system"]), rng.choice(said)) for _ in range(rng.randrange(0, 9))] for _ in range(200)]
    df = chats(spark, *rows, None)
    assert texts(df, T.render_with(t, F.col("m"))) == [plainly(t, r) for r in [*rows, None]]
    options = F.create_map(F.lit("enable_thinking"), F.when(F.col("id") % 2 == 0, "false").otherwise("true"))
    want = [plainly(t, r, True, {"enable_thinking": "true" if i % 2 else "false"}) for i, r in enumerate([*rows, None])]
    assert texts(df, T.render_with(t, F.col("m"), ask=True, options=options)) == want
    assert texts(df.limit(0), T.render_with(t, F.col("m"))) == []


def test_results_of_tools_share_a_turn(spark):
    df = chats(spark, [("user", "q"), ("assistant", "call"), ("tool", "1"), ("tool", "2"), ("assistant", "done")])
    text = texts(df, T.render_with(REASONING, F.col("m")))[0]
    grouped = "<|im_start|>user\n<tool_response>\n1\n</tool_response>\n<tool_response>\n2\n</tool_response><|im_end|>\n"
    assert grouped in text and text.count("<|im_start|>user") == 2


def test_tools_join_the_system_text(spark):
    t = T.template({"name": "x", "rules": [{"open": "{role}:", "close": ";"}], "tools_open": "tools[", "tools_between": ",", "tools_close": "]"})
    df = chats(spark, [("user", "q")], [("system", "s"), ("user", "q")], [("system", ""), ("user", "q")])
    tools = F.array(F.lit("a"), F.lit("b"))
    assert texts(df, T.render_with(t, F.col("m"), tools=tools)) == ["system:tools[a,b];user:q;", "system:s\n\ntools[a,b];user:q;", "system:tools[a,b];user:q;"]
    none = F.array().cast("array<string>")
    assert texts(df.limit(1), T.render_with(t, F.col("m"), tools=none)) == ["user:q;"]
    assert texts(df.limit(1), T.render_with(t, F.col("m"), tools=F.lit(None).cast("array<string>"))) == ["user:q;"]


def test_prompts_and_pairs(spark):
    t = T.template({"name": "x", "start": "^", "rules": [{"open": "{role}:", "close": ";"}], "asks": [{"text": "assistant:"}]})
    df = chats(spark, [("user", "q")], [("user", "q"), ("assistant", "so")], [("user", "q"), ("tool", "r")])
    assert texts(df, T.prompt_with(t, F.col("m"))) == ["^user:q;assistant:", "^user:q;assistant:so", "^user:q;tool:r;assistant:"]
    with pytest.raises(Exception, match="cannot end with the role system"):
        texts(chats(spark, [("system", "s")]), T.prompt_with(t, F.col("m")))
    answer = lambda x: F.array(F.struct(F.lit("assistant").alias("role"), F.lit(x).alias("content")))
    got = chats(spark, [("user", "q")]).select(*T.pair_with(t, F.col("m"), answer("yes"), answer("no"))).first()
    assert tuple(got) == ("^user:q;assistant:", "yes;", "no;")
    # A header that asks for more than the answer brings is cut to the shared start.
    long = T.template({"name": "y", "rules": [{"open": "{role}:", "close": ";"}], "asks": [{"text": "assistant:<go>"}]})
    got = chats(spark, [("user", "q")]).select(*T.pair_with(long, F.col("m"), answer("<g"), answer("no"))).first()
    assert tuple(got) == ("user:q;assistant:", "<g;", "no;")


def test_training_variant_keeps_prefixes(spark):
    assert T.keeps_prefixes(T.template({"name": "x", "rules": [{"open": "a"}]}))
    assert not T.keeps_prefixes(REASONING) and not T.keeps_prefixes(TITLED)
    training = T.training_variant(REASONING)
    assert T.keeps_prefixes(training)
    chat = [("user", "sky?"), ("assistant", "<think>\nhm\n</think>\n\nBlue."), ("user", "At night?"), ("assistant", "Black.")]
    df = chats(spark, chat)
    for size in (1, 2, 3):
        kept = lambda t: texts(df, T.prefix_kept(t, F.col("m"), F.lit(size)))[0]  # noqa: B023, E731
        assert kept(training) and kept(REASONING) == (size != 2)
    assert "hm" in texts(df, T.render_with(training, F.col("m")))[0] and "hm" not in texts(df, T.render_with(REASONING, F.col("m")))[0]
    with pytest.raises(ValueError, match="no rule for a last turn"):
        T.training_variant(T.template({"name": "x", "rules": [{"last": False}]}))


def test_pieces_are_what_the_model_says(spark):
    turns = T.turns_with(FOLDED, F.col("m"))
    got = chats(spark, [("system", "s"), ("user", " q "), ("assistant", "a")]).select(turns).first()[0]
    assert [tuple(x) for x in got] == [("system", "[INST] <<SYS>>\n", "s", "\n<</SYS>>\n\n"), ("user", "", "q", " [/INST]"), ("assistant", " ", "a", " </s>")]


def test_templates_from_json_and_table(spark):
    entry = {
        "name": "x", "start": "^", "rules": [{"role": "user", "open": "u:", "close": ";", "trim": True}, {"open": "{role}>", "close": "."}],
        "asks": [{"text": "off", "option": "think", "value": "no"}, {"text": "on"}],
    }
    rows = [
        ("x", "rule", 2, None, "{role}>", ".", None, None, None), ("x", "rule", 1, "user", "u:", ";", True, None, None), ("x", "start", 0, None, "^", None, None, None, None),
        ("x", "ask", 4, None, "on", None, None, None, None), ("x", "ask", 3, None, "off", None, None, "think", "no"),
    ]
    schema = "template string, part string, place int, role string, open string, close string, trim boolean, option string, value string"
    read = T.templates_from_table(spark.createDataFrame(rows, schema))
    assert read == {"x": T.template(json.loads(json.dumps(entry)))}
    name = F.when(F.col("id") == 0, "x").otherwise("z")
    df = chats(spark, [("user", " q ")], [("user", "q")])
    both = read | {"z": T.template({"name": "z", "rules": [{"close": "!"}]})}
    assert texts(df, T.render_by_name(both, name, F.col("m"))) == ["^u:q;", "q!"]
    with pytest.raises(Exception, match="no template z"):
        texts(df, T.render_by_name(read, name, F.col("m")))


@pytest.mark.parametrize(
    "entry, message",
    [
        ({"name": "x", "rules": [{"opens": ""}]}, "unknown rule fields: opens"),
        ({"name": "x", "rules": []}, "has no rules"),
        ({"name": "x", "rules": [{"value": "a"}]}, "a value needs an option"),
        ({"name": "x", "rules": [{}], "asks": [{"text": "", "role": "user"}]}, "unknown ask fields: role"),
    ],
)
def test_faulty_templates_are_errors(entry, message):
    with pytest.raises(ValueError, match=message):
        T.template(entry)


def test_messages_without_a_rule_are_errors(spark):
    t = T.template({"name": "strict", "rules": [{"role": "user"}]})
    with pytest.raises(Exception, match="template strict has no rule for the role tool"):
        texts(chats(spark, [("user", "q"), ("tool", "r")]), T.render_with(t, F.col("m")))


def test_tables_of_templates_are_bounded(spark):
    rows = spark.range(T.MOST_RULES + 1).select(F.lit("x").alias("template"), F.lit("rule").alias("part"), F.col("id").alias("place"), F.lit("").alias("open"))
    with pytest.raises(ValueError, match="at most"):
        T.templates_from_table(rows)
