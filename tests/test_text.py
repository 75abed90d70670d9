"""Small exact cases for messages, rendering and token lists."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tunetable import schema
from tunetable.functions import messages as M
from tunetable.functions import render, tokens
from tunetable.operators import convert
from tunetable.operators.batches import flush, pad_to_longest
from tunetable.schema import MESSAGES

MSG = "array<struct<role:string,content:string>>"


def chat(*turns):
    return [{"role": r, "content": c} for r, c in turns]


def as_pairs(messages):
    return [(m["role"], m["content"]) for m in messages]


def ints(*xs):
    return F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<int>")


# --- prompt extraction ------------------------------------------------------


@pytest.mark.parametrize(
    ("chosen", "rejected", "prompt"),
    [
        ("Tea or milk? Tea.", "Tea or milk? Milk.", "Tea or milk?"),
        ("abc", "xbc", ""),  # differs at once
        ("abc", "abd", "ab"),
        ("ab", "abcd", "a"),  # one is a start of the other: its last element stays
        ("same", "same", "sam"),
        ("a", "a", ""),
        ("né à Paris", "né à Rome", "né à"),
    ],
)
def test_extract_text_prompt(spark, chosen, rejected, prompt):
    row = convert.extract_prompt(spark.createDataFrame([(chosen, rejected)], "chosen string, rejected string")).first()
    assert row.prompt == prompt
    assert row.prompt + row.chosen == chosen
    assert row.prompt + row.rejected == rejected


def test_extract_message_prompt(spark):
    ask = ("user", "Which bus goes to the port?")
    df = spark.createDataFrame(
        [(chat(ask, ("assistant", "Take line nine.")), chat(ask, ("assistant", "Any bus will do.")))], f"chosen {MSG}, rejected {MSG}"
    )
    row = convert.extract_prompt(df).first()
    assert as_pairs(row.prompt) == [ask]
    assert as_pairs(row.chosen) == [("assistant", "Take line nine.")]
    assert as_pairs(row.rejected) == [("assistant", "Any bus will do.")]


def test_explicit_prompt_is_kept_only_in_the_same_format(spark):
    same = spark.createDataFrame([("p", "ax", "ay")], "prompt string, chosen string, rejected string")
    assert convert.maybe_extract_prompt(same).first().prompt == "p"
    mixed = spark.createDataFrame(
        [("p", chat(("user", "q"), ("assistant", "a")), chat(("user", "q"), ("assistant", "b")))],
        f"prompt string, chosen {MSG}, rejected {MSG}",
    )
    assert as_pairs(convert.maybe_extract_prompt(mixed).first().prompt) == [("user", "q")]


def test_unpair(spark):
    df = spark.createDataFrame([("p1", "c1", "r1"), ("p2", "c2", "r2")], "prompt string, chosen string, rejected string")
    rows = {(r.prompt, r.completion, r.label) for r in convert.unpair(df).collect()}
    assert rows == {("p1", "c1", True), ("p1", "r1", False), ("p2", "c2", True), ("p2", "r2", False)}


def test_stepwise_conversions(spark):
    df = spark.createDataFrame(
        [("p", ["a", "b"], [True, False]), ("q", ["c", "d"], [True, True])], "prompt string, completions array<string>, labels array<boolean>"
    )
    assert {(r.completion, r.label) for r in convert.to_unpaired(df).collect()} == {("ab", False), ("cd", True)}
    assert [r.text for r in convert.to_language_modeling(df).collect()] == ["qcd"]
    assert [(r.prompt, r.completion) for r in convert.to_prompt_completion(df).collect()] == [("q", "cd")]
    assert [(r.prompt, r.step, r.completion, r.label) for r in convert.explode_steps(df).collect()][:2] == [("p", 0, "a", True), ("p", 1, "b", False)]


# --- formats ----------------------------------------------------------------


@pytest.mark.parametrize(
    ("ddl", "kind", "conversational"),
    [
        ("text string", "language_modeling", False),
        (f"messages {MSG}", "language_modeling", True),
        (f"prompt {MSG}", "prompt_only", True),
        ("prompt string, completion string", "prompt_completion", False),
        (f"prompt {MSG}, chosen {MSG}, rejected {MSG}", "preference", True),
        ("chosen string, rejected string", "implicit_preference", False),
        ("prompt string, completion string, label boolean", "unpaired_preference", False),
        ("prompt string, completions array<string>, labels array<boolean>", "stepwise", False),
        ("prompt array<struct<from:string,value:string>>", "prompt_only", False),
    ],
)
def test_dataset_types(spark, ddl, kind, conversational):
    s = spark.createDataFrame([], ddl).schema
    assert schema.dataset_type(s) == kind
    assert schema.is_conversational(s) is conversational


def test_unknown_columns_are_an_error(spark):
    with pytest.raises(ValueError):
        schema.dataset_type(spark.range(1).schema)


def test_chatml(spark):
    df = spark.createDataFrame(
        [([{"from": "user", "value": "Hi"}, {"from": "assistant", "value": "Hello"}],)], "conversations array<struct<from:string,value:string>>"
    )
    out = M.to_chatml(df)
    assert out.columns == ["messages"]
    assert as_pairs(out.first().messages) == [("user", "Hi"), ("assistant", "Hello")]
    assert schema.is_conversational_from_value(df.schema)
    plain = spark.createDataFrame([(chat(("user", "x")),)], f"messages {MSG}")
    assert M.to_chatml(plain).first() == plain.first()


@pytest.mark.parametrize(
    ("ddl", "row", "want"),
    [
        ("instruction string, output string", ("do", "done"), [("user", "do"), ("assistant", "done")]),
        ("question string, answer string, system string", ("q", "a", "s"), [("system", "s"), ("user", "q"), ("assistant", "a")]),
        ("question string, answer string, system string", ("q", "a", ""), [("user", "q"), ("assistant", "a")]),
        ("dialog array<string>", (["x", "y"],), [("user", "x"), ("assistant", "y")]),
        ("dialogue array<struct<from:string,value:string>>", ([("human", "h"), ("gpt", "g"), (None, "z")],), [("user", "h"), ("assistant", "g")]),
    ],
)
def test_infer_messages(spark, ddl, row, want):
    df = spark.createDataFrame([row], ddl)
    assert as_pairs(df.select(M.infer_messages(df.schema).alias("m")).first().m) == want


def test_infer_messages_needs_known_columns(spark):
    with pytest.raises(ValueError):
        M.infer_messages(spark.range(1).schema)


def test_trailing_turns(spark):
    df = spark.createDataFrame(
        [(chat(("user", "a"), ("assistant", "b"), ("assistant", "c")),), (chat(("user", "a")),), (chat(("assistant", "a")),), ([],)], f"m {MSG}"
    )
    rows = df.select(M.to_last_assistant(F.col("m")).alias("a"), M.drop_trailing_assistant(F.col("m")).alias("b")).collect()
    assert [len(r.a) for r in rows] == [3, 0, 1, 0]
    assert [len(r.b) for r in rows] == [1, 1, 0, 0]


def test_null_entries(spark):
    df = spark.createDataFrame([({"a": None, "b": 1},), ({"a": 2, "b": None},)], "x struct<a:int,b:int>")
    df = df.select(F.struct("x", F.array(F.lit(None).cast("int"), F.lit(1)).alias("l"), F.create_map(F.lit("k"), F.lit(None).cast("int"), F.lit("v"), F.lit(1)).alias("m")).alias("y"))
    got = [json.loads(r.j) for r in df.select(M.drop_nulls(F.col("y"), df.schema["y"].dataType).alias("j")).collect()]
    assert got == [{"x": {"b": 1}, "l": [None, 1], "m": {"v": 1}}, {"x": {"a": 2}, "l": [None, 1], "m": {"v": 1}}]


def test_thinking(spark):
    df = spark.createDataFrame([([("assistant", "why", "a"), ("user", " ", "b"), ("user", None, "c")],)], "m array<struct<role:string,thinking:string,content:string>>")
    assert as_pairs(df.select(M.merge_thinking(F.col("m")).alias("m")).first().m) == [("assistant", "<think>why</think>a"), ("user", "b"), ("user", "c")]


def test_image_blocks(spark):
    df = spark.createDataFrame([(chat(("system", "s"), ("user", "u"), ("assistant", "a"), ("user", "v")), ["i", "j"])], f"m {MSG}, img array<string>")
    got = df.select(M.image_blocks(F.col("m"), F.col("img")).alias("m")).first().m
    assert [[(b.type, b.text, b.image_ref) for b in x.content] for x in got] == [
        [("text", "s", None)],
        [("image", None, "i"), ("image", None, "j"), ("text", "u", None)],
        [("text", "a", None)],
        [("text", "v", None)],
    ]


@pytest.mark.parametrize("turns", [[("tool", "t")], [("system", "s")]])
def test_image_blocks_errors(spark, turns):
    df = spark.createDataFrame([(chat(*turns), ["i"])], f"m {MSG}, img array<string>")
    with pytest.raises(PySparkException):
        df.select(M.image_blocks(F.col("m"), F.col("img"))).collect()


# --- rendering --------------------------------------------------------------


def test_render_styles(spark):
    df = spark.createDataFrame([(chat(("user", "Hi"), ("assistant", "Yo")),)], f"m {MSG}")
    m = F.col("m")
    row = df.select(
        render.render_chat(m).alias("im"), render.render_chat(m, "simple", ask=True).alias("simple"), render.render_prompt(m).alias("open")
    ).first()
    assert row.im == "<|im_start|>user\nHi<|im_end|>\n<|im_start|>assistant\nYo<|im_end|>\n"
    assert row.simple == "User: Hi\n\nAssistant: Yo\n\nAssistant:"
    assert row.open == "<|im_start|>user\nHi<|im_end|>\n<|im_start|>assistant\nYo"


def test_prompt_role_is_checked(spark):
    df = spark.createDataFrame([(chat(("system", "s")),)], f"m {MSG}")
    with pytest.raises(PySparkException):
        df.select(render.render_prompt(F.col("m"))).collect()


@pytest.mark.parametrize(("a", "b", "n"), [("", "", 0), ("", "x", 0), ("abc", "abd", 2), ("abc", "abc", 3), ("ab", "abc", 2), ("xa", "ya", 0), ("é" * 1000 + "a", "é" * 1000 + "b", 1000)])
def test_common_prefix(one, a, b, n):
    assert one(n=render.common_prefix_length(F.lit(a), F.lit(b))).n == n


def test_strip_repeated_header(one):
    h = "<|im_start|>assistant"
    cut = lambda p, c: one(x=render.strip_repeated_header(F.lit(p), F.lit(c))).x
    assert cut(f"q {h}\n", f" {h}\nhello") == "hello"
    assert cut("q", f"{h}\nhello") == f"{h}\nhello"
    assert cut(f"q {h}", "hello") == "hello"


# --- token lists ------------------------------------------------------------


def test_truncate_lists(spark):
    df = spark.createDataFrame([([9, 8, 7, 6],), ([],), ([5, 4, 3],), ([2, 1],)], "ids array<int>")
    assert [r.ids for r in tokens.truncate_lists(df, 3).collect()] == [[9, 8, 7], [], [5, 4, 3], [2, 1]]


def test_ends_of_lists(one):
    ids = ints(1, 2, 3)
    row = one(a=tokens.last_n(ids, 2), b=tokens.last_n(ids, 5), c=tokens.last_n(ids, 0), d=tokens.first_n(ids, 0), e=tokens.after(ids, 1), f=tokens.after(ids, 9), g=tokens.last_n(ints(), 2))
    assert tuple(row) == ([2, 3], [1, 2, 3], [], [], [2, 3], [], [])


@pytest.mark.parametrize(
    ("side", "masks", "ids", "want_ids", "want_masks"),
    [
        ("left", [[1, 0, 0, 1], [0, 0, 1, 0]], [[7, 0, 0, 8], [0, 0, 9, 0]], [[7, 8], [9, 0]], [[1, 1], [1, 0]]),
        ("right", [[0, 1, 0, 0], [1, 1, 0, 1]], [[0, 6, 0, 0], [3, 4, 0, 5]], [[0, 0, 6], [3, 4, 5]], [[0, 0, 1], [1, 1, 1]]),
    ],
)
def test_flush(spark, side, masks, ids, want_ids, want_masks):
    df = spark.createDataFrame(list(zip(range(2), ids, masks)), "k int, ids array<int>, mask array<int>")
    rows = flush(df, "ids", "mask", side).orderBy("k").collect()
    assert [r.ids for r in rows] == want_ids
    assert [r["mask"] for r in rows] == want_masks


def test_pad_to_multiple(spark):
    df = spark.createDataFrame([(0, [1]), (1, [1, 2, 3, 4, 5])], "k int, ids array<int>")
    rows = pad_to_longest(df, "ids", "p", 9, multiple=4, side="left").orderBy("k").collect()
    assert [r.p for r in rows] == [[9] * 7 + [1], [9] * 3 + [1, 2, 3, 4, 5]]


def test_special_ids(one):
    row = one(a=tokens.add_special(ints(5, 6), 1, 2), b=tokens.add_special(ints(1, 6, 2), 1, 2), c=tokens.add_special(ints(), 1, 2))
    assert tuple(row) == ([1, 5, 6, 2], [1, 6, 2], [1, 2])


def test_stop(one):
    ids, mask = tokens.truncate_at_stop(ints(5, 2, 6, 2), 2, 0)
    none, all_ones = tokens.truncate_at_stop(ints(5, 6), 2, 0)
    row = one(a=ids, b=mask, c=none, d=all_ones, e=tokens.first_true(F.array(F.lit(False), F.lit(True))), f=tokens.first_true(F.array(F.lit(False), F.lit(False))))
    assert tuple(row) == ([5, 2, 0, 0], [1, 1, 0, 0], [5, 6], [1, 1], 1, 2)


def test_boundary_and_pair_check(one, spark):
    row = one(a=tokens.answer_boundary(ints(1, 2), ints(1, 2, 3)), b=tokens.answer_boundary(ints(1, 2), ints(1, 9, 3)), c=tokens.checked_pair_prompts(ints(1, 2), ints(1, 3)))
    assert tuple(row) == (2, 1, 1)
    with pytest.raises(PySparkException):
        spark.range(1).select(tokens.checked_pair_prompts(ints(1, 2, 3), ints(1))).collect()


def test_masks(one, spark):
    first, n = tokens.answer_span(ints(-100, -100, 4, 5))
    none_first, none_n = tokens.answer_span(ints(-100))
    row = one(a=tokens.completion_mask(ints(1, 2), ints(1, 2, 3)), b=tokens.masked_labels(ints(1, 2), ints(0, 1)), c=first, d=n, e=none_first, f=none_n, g=tokens.position_ids(ints(2, 3)))
    assert tuple(row) == ([0, 0, 1], [-100, 2], 2, 2, 0, 0, [0, 1, 0, 1, 2])
    df = spark.createDataFrame([(chat(("user", "only me")),)], MESSAGES.simpleString().join(["m ", ""]))
    with pytest.raises(PySparkException):
        df.select(tokens.assistant_mask(F.col("m"))).collect()


def test_two_stage_truncation(one):
    p, a = tokens.truncate_two_stage(ints(3, 4, 5, 6), ints(7, 8, 9), 6, 2, "keep_end", first=1, last=2)
    cut, c, r = tokens.truncate_pair_two_stage(ints(3, 4, 5, 6), ints(7), ints(7, 8, 9), 5, 2, "keep_start")
    row = one(p=p, a=a, cut=cut, c=c, r=r)
    # Room is 6 less the two special ids; the prompt goes to 2, the answer to 4 - 2.
    assert tuple(row) == ([5, 6], [7, 8], [3, 4], [7], [7, 8, 9])


def test_stepwise_labels(one):
    steps = F.array(ints(3, 4), ints(5))
    good = F.array(F.lit(True), F.lit(False))
    ids, labels = tokens.stepwise_labels(ints(1), steps, good, 9, first=0)
    _, last = tokens.stepwise_labels(ints(1), steps, good, 9, last_only=True)
    row = one(a=ids, b=labels, c=last)
    assert tuple(row) == ([0, 1, 3, 4, 9, 5, 9], [-100, -100, -100, -100, 1, -100, 0], [-100, -100, -100, -100, -100, 0])


def test_flush_of_several_columns_and_of_the_mask_alone(spark):
    rows = [(0, [4, 5, 6, 7], [0.4, 0.5, 0.6, 0.7], [1, 0, 0, 1]), (1, [8, 9, 1, 2], [0.8, 0.9, 0.1, 0.2], [0, 0, 1, 0])]
    df = spark.createDataFrame(rows, "k int, ids array<int>, p array<double>, mask array<int>")
    both = flush(df, ["ids", "p"], "mask", "right").orderBy("k").collect()
    assert [(r.ids, r.p, r["mask"]) for r in both] == [([4, 7], [0.4, 0.7], [1, 1]), ([0, 1], [0.0, 0.1], [0, 1])]
    alone = flush(df.select("k", "mask"), [], "mask", "left").orderBy("k").collect()
    assert [r["mask"] for r in alone] == [[1, 1], [1, 0]]


def test_tools_calls_names_and_template_options(spark):
    call = {"name": 'find "x"', "arguments": '{"a":1}'}
    rows = [
        (
            [
                {"role": "user", "content": "Where?", "name": "bo", "tool_calls": None},
                {"role": "assistant", "content": None, "name": None, "tool_calls": [call, {"name": "now", "arguments": None}]},
                {"role": "tool", "content": "here", "name": "find", "tool_calls": []},
            ],
            ['{"name":"now"}'],
            {"enable_thinking": "false"},
        ),
        ([{"role": "user", "content": "Hi", "name": None, "tool_calls": None}], [], None),
    ]
    df = spark.createDataFrame(rows, f"m {schema.CALLING_MESSAGES.simpleString()}, tools array<string>, options map<string,string>")
    plain = render.calling_chat(F.col("m"))
    one, two = df.select(render.render_prompt(plain, "im", F.col("tools"), F.col("options")).alias("t"), render.render_chat(plain).alias("c")).collect()
    assert one.c == (
        "<|im_start|>user bo\nWhere?<|im_end|>\n<|im_start|>assistant\n"
        '<tool_call>\n{"name":"find \\"x\\"","arguments":{"a":1}}\n</tool_call>\n<tool_call>\n{"name":"now","arguments":{}}\n</tool_call><|im_end|>\n'
        "<|im_start|>tool find\nhere<|im_end|>\n"
    )
    assert one.t == (
        '<|im_start|>system\n# Tools\n\n<tools>\n{"name":"now"}\n</tools><|im_end|>\n' + one.c + "<|im_start|>assistant\n<think>\n\n</think>\n\n"
    )
    assert two.t == "<|im_start|>user\nHi<|im_end|>\n<|im_start|>assistant\n"


BLOCKED = "array<struct<role:string,content:string,blocks:array<struct<type:string,text:string>>>>"


def test_prepared_image_blocks(spark):
    image, say = {"type": "image", "text": None}, lambda t: {"type": "text", "text": t}
    rows = [
        (0, [("user", None, [say("left"), image, say("right"), image]), ("assistant", "two", None), ("user", None, [image])], ["a", "b", "c"]),
        (1, [("system", "be kind", None), ("user", "one", None), ("user", "more", None)], ["a", "b"]),
        (2, [("user", "none", None)], []),
        (3, [], []),
    ]
    df = spark.createDataFrame(rows, f"k int, m {BLOCKED}, images array<string>")
    out = df.select("k", M.rename_image_blocks(M.prepared_image_blocks(F.col("m"), F.col("images")), "pic").alias("m")).orderBy("k").collect()
    shown = [[(m.role, [b.pic if b.type == "pic" else b.text for b in m.content]) for m in r.m] for r in out]
    assert shown == [
        [("user", ["left", "a", "right", "b"]), ("assistant", ["two"]), ("user", ["c"])],
        [("system", ["be kind"]), ("user", ["a", "b", "one"]), ("user", ["more"])],
        [("user", ["none"])],
        [],
    ]
    for bad in ([("user", None, [image])], ["a", "b"]), ([("user", None, [image, image])], ["a"]), ([("narrator", "x", None)], []):
        with pytest.raises(PySparkException):
            spark.createDataFrame([bad], f"m {BLOCKED}, images array<string>").select(M.prepared_image_blocks(F.col("m"), F.col("images"))).collect()
