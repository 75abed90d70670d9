import hashlib
import random
import time

from pyspark.sql import functions as F

from tests.conftest import SF
from tunetable.llm import chat_parts as cp
from tunetable.llm.queries import QUERIES

CONTROL = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "&lt;&amp;&lsqb;", "[INST]", "\n", "", None, "é🙂 漢", "<|end|>\n", "a&amp;lt;b"]


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", cp.text_part(F.coalesce("text", F.lit(""))))


def test_round_trip_and_mask(spark):
    rng = random.Random(1)
    rows = []
    for c in [*range(40), None]:
        for t in range(rng.randrange(1, 8)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", None, "<|end|>"]), rng.choice(CONTROL) or "" if rng.random() < 0.8 else None))
    rows += [(90, t, "user" if t % 2 else "assistant", f"turn {t} [x]") for t in range(2000)] + [(91, 0, "assistant", "x" * 200000), (92, 0, "assistant", "same"), (92, 0, "assistant", "same")]
    out = cp.format_conversations(table(spark, rows))
    got = out.select("conv_id", "n_turns", "formatted", "spans", cp.read_back(F.col("formatted")).alias("read"), cp.masked_text(F.col("formatted"), F.col("spans")).alias("loss")).collect()
    assert {r["conv_id"] for r in got} == {r[0] for r in rows}
    for r in got:
        turns = sorted((t, role or "", x or "") for c, t, role, x in rows if c == r["conv_id"])
        assert [(x["role"], x["text"]) for x in r["read"]] == [(a, b) for _, a, b in turns]
        assert r["n_turns"] == len(turns)
        assert r["loss"] == "".join(x for _, role, x in turns if role == "assistant")
        assert len(r["spans"]) == sum(role == "assistant" for _, role, _ in turns)
        assert r["formatted"].count("<|turn|>") == r["formatted"].count("<|end|>") == len(turns)
    assert cp.format_conversations(table(spark, []).limit(0)).count() == 0


def test_parts_of_every_type(spark):
    rows = [
        (1, 0, "user", [("text", "see <", None, None, None, None, None), ("image", None, "a.png", 900, 448, None, None), ("text", "and", None, None, None, None, None), ("audio", None, "b.wav", None, None, 2.5, None)]),
        (1, 1, "assistant", [(None, "fine", None, None, None, None, None), ("document", "kept out", "c.pdf", None, None, None, 3)]),
        (1, 2, "user", [("image", None, None, None, None, None, None), ("video", None, "d.mp4", None, None, None, None)]),
        (2, 0, "user", None),
        (2, 1, "user", [("image", None, "e.png", 10, 10, None, None)]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{cp.PART}>")
    got = {r["conv_id"]: r for r in cp.format_conversations(df).collect()}
    assert got[1]["formatted"] == (
        "<|turn|>user<|text|>see &lt;<|image:1|>and<|audio:2|><|end|>"
        "<|turn|>assistant<|text|>fine<|document:3|><|end|>"
        "<|turn|>user<|text|><|image:4|><|video:5|><|end|>"
    )
    assert [tuple(a) for a in got[1]["attachments"]] == [
        (1, "image", "a.png", 3 * 256), (2, "audio", "b.wav", 63), (3, "document", "c.pdf", 3072), (4, "image", None, 256), (5, "video", "d.mp4", 1),
    ]
    assert [tuple(a) for a in got[2]["attachments"]] == [(1, "image", "e.png", 256)]
    s = got[1]["spans"][0]
    assert got[1]["formatted"][s["start"] : s["start"] + s["size"]] == "fine<|document:3|>"


def test_long_conversations_in_linear_time(spark):
    n = 100_000
    turns = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("\ufeff漢🙂 <turn "), F.col("id").cast("string"), F.lit("> "), F.repeat(F.lit("words "), 30)).alias("text"),
    )
    out = cp.format_conversations(turns.withColumn("parts", cp.text_part(F.col("text"))))
    began = time.monotonic()
    got = out.select(F.sha2(cp.masked_text(F.col("formatted"), F.col("spans")), 256).alias("h"), F.size("spans").alias("n")).first()
    assert time.monotonic() - began < 60
    said = "".join(f"\ufeff漢🙂 <turn {i}> " + "words " * 30 for i in range(1, n, 2))
    assert (got["h"], got["n"]) == (hashlib.sha256(said.encode()).hexdigest(), n // 2)


def test_clashing_columns_and_many_parts(spark):
    names = ["before", "at", "visits", "places", "head", "body", "p", "start", "piece"]
    df = table(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b")])
    for name in names:
        df = df.withColumn(name, F.lit("other"))
    assert cp.format_conversations(df).first()["formatted"] == "<|turn|>user<|text|>a<|end|><|turn|>assistant<|text|>b<|end|>"
    one = ("image", None, "a.png", 1, 1, None, None)
    many = [x for _ in range(2000) for x in (("text", "t", None, None, None, None, None), one)]
    got = cp.format_conversations(spark.createDataFrame([(1, 0, "user", many)], f"conv_id long, turn long, role string, parts array<{cp.PART}>")).first()
    assert [a["number"] for a in got["attachments"]] == list(range(1, 2001))


def test_query(spark):
    got = {r["conv_id"]: r for r in QUERIES["op6_chat_parts"](spark, SF).collect()}
    text = "</s>[INST] ok [/INST]"
    r = got[-1]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (2, 21, sha(text))
    assert r["turns_sha256"] == sha(f"user\n{text}\nassistant\n{text}\n")
    turns = {}
    for t in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns.setdefault(t["conv_id"], []).append((t["turn"], t["role"], t["text"] or ""))
    assert set(got) == set(turns) | {-1}
    for c, rows in turns.items():
        rows.sort()
        loss = "".join(x for _, role, x in rows if role == "assistant")
        assert got[c]["turns_sha256"] == sha("".join(f"{a}\n{b}\n" for _, a, b in rows))
        assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(rows), len(loss), sha(loss))
