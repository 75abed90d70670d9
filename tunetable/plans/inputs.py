"""Training-data shapes derived from the given tables, and the same shapes as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetable.functions.distributions import half_shares
from tunetable.functions.messages import first_index, head, last_index, turns_to_messages
from tunetable.functions.objectives import array_sum
from tunetable.functions.tokens import TOKEN_PATTERN, hashed_ids, words
from tunetable.operators.skew import join_unique
from tunetable.operators.vocab import count_tokens, tokens_of
from tunetable.session import settle
from tunetable.sources.scan import spread, table
from tunetable.sources.stored import stored

SEP = "\x1f"


def num(col: Column, places: int = 6) -> Column:
    """Rounded, so that sums in another order compare equal."""
    return F.round(col.cast("double"), places)


def sql_num(expr: str, places: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {places}) + 0.0)"


def show_messages(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.concat(m.role, F.lit(":"), m.content)), SEP)


def sql_messages(expr: str) -> str:
    return f"coalesce(array_to_string(list_transform({expr}, lambda m: m.role || ':' || m.content), chr(31)), '')"


def show_ids(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), ",", "null")


def sql_ids(expr: str) -> str:
    return f"coalesce(array_to_string(list_transform({expr}, lambda x: coalesce(CAST(x AS VARCHAR), 'null')), ','), '')"


def sql_words(expr: str) -> str:
    return f"regexp_extract_all({expr}, '{TOKEN_PATTERN}')"


def sql_hashed(expr: str) -> str:
    return f"list_transform({sql_words(expr)}, lambda t: CAST(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) // 2 AS INTEGER))"


def sql_last_index(msgs: str, test: str) -> str:
    """1-based index of the last message passing a test on ``m``; 0 if none."""
    return f"coalesce(list_max(list_transform({msgs}, lambda m, i: CASE WHEN {test} THEN i ELSE 0 END)), 0)"


# --- conversations ----------------------------------------------------------


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "conversations"), "conv_id")


def message_table(spark: SparkSession, sf: str) -> DataFrame:
    """``conv_id, messages``."""
    return turns_to_messages(conversations(spark, sf), "conv_id", "turn")


SQL_MESSAGES = (
    "msgs AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS messages "
    "FROM conversations GROUP BY conv_id)"
)


def rollouts(spark: SparkSession, sf: str) -> DataFrame:
    """Assistant turns as completions of the turn before: ``group_id, idx, prompt, completion`` and rewards."""
    turns = conversations(spark, sf)
    asked = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt"))
    df = turns.filter("role = 'assistant'").join(asked, ["conv_id", "turn"])
    c = F.col("text")
    commas, lines = F.regexp_count(c, F.lit(",")), F.regexp_count(c, F.lit("\n"))
    return df.select(
        F.col("conv_id").alias("group_id"),
        F.col("turn").alias("idx"),
        "prompt",
        c.alias("completion"),
        F.least(F.length(c) / 1000.0, F.lit(1.0)).alias("r_length"),
        F.when(commas > 2, commas / 10.0).alias("r_comma"),
        F.when(lines > 0, 1.0 / (lines + 1)).alias("r_lines"),
    )


SQL_ROLLOUTS = (
    "rollouts AS (SELECT a.conv_id AS group_id, a.turn AS idx, p.text AS prompt, a.text AS completion, "
    "least(length(a.text) / 1000.0::DOUBLE, 1.0) AS r_length, "
    "CASE WHEN length(a.text) - length(replace(a.text, ',', '')) > 2 "
    "THEN (length(a.text) - length(replace(a.text, ',', ''))) / 10.0::DOUBLE END AS r_comma, "
    "CASE WHEN contains(a.text, chr(10)) THEN 1.0::DOUBLE / (length(a.text) - length(replace(a.text, chr(10), '')) + 1) END AS r_lines "
    "FROM conversations a JOIN conversations p ON p.conv_id = a.conv_id AND p.turn = a.turn - 1 WHERE a.role = 'assistant')"
)


def preference_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """``conv_id, prompt (messages), chosen, rejected (messages)``: last against first assistant turn."""
    is_assistant = lambda m: m.role == "assistant"
    m = F.col("messages")
    df = message_table(spark, sf).withColumn("_f", first_index(m, is_assistant)).withColumn("_l", last_index(m, is_assistant))
    one = lambda at: F.slice(m, F.greatest(at, F.lit(1)), 1)
    return df.filter("_l > _f AND _f > 0").select(
        "conv_id", head(m, F.col("_f") - 1).alias("prompt"), one(F.col("_l")).alias("chosen"), one(F.col("_f")).alias("rejected")
    )


_ROLES = "list_transform(messages, lambda m: m.role)"
SQL_PAIRS = (
    SQL_MESSAGES
    + f", ends AS (SELECT *, list_position({_ROLES}, 'assistant') AS f, {sql_last_index('messages', "m.role = 'assistant'")} AS l FROM msgs)"
    + ", pairs AS (SELECT conv_id, messages[1:f-1] AS prompt, messages[l:l] AS chosen, messages[f:f] AS rejected FROM ends WHERE l > f AND f > 0)"
)


def text_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The same pairs as strings, with the prompt's last message as the prompt."""
    text = lambda c: F.try_element_at(F.col(c), F.lit(-1)).content
    df = preference_pairs(spark, sf).filter(F.size("prompt") > 0)
    return df.select("conv_id", text("prompt").alias("prompt"), text("chosen").alias("chosen"), text("rejected").alias("rejected"))


SQL_TEXT_PAIRS = (
    SQL_PAIRS
    + ", tpairs AS (SELECT conv_id, prompt[-1].content AS prompt, chosen[1].content AS chosen, rejected[1].content AS rejected "
    "FROM pairs WHERE len(prompt) > 0)"
)


# --- documents --------------------------------------------------------------


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    df = table(spark, sf, "documents", *columns)
    # Texts are tokenised; the other columns are only read.
    return spread(df, "doc_id") if {"doc_id", "text"} <= set(df.columns) else df


def unpaired(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, prompt, completion, label`` from labelled documents: the first line asks, the rest answers."""
    labels = table(spark, sf, "labels", "doc_id", "quality")
    text = F.col("text")
    first = F.substring_index(text, "\n", 1)
    return documents(spark, sf, "doc_id", "text").join(labels, "doc_id").select(
        "doc_id", first.alias("prompt"), F.substr(text, F.length(first) + 1, F.length(text)).alias("completion"),
        (F.col("quality") == 1).alias("label"),
    )


SQL_UNPAIRED = (
    "unpaired AS (SELECT d.doc_id, string_split(d.text, chr(10))[1] AS prompt, "
    "substr(d.text, length(string_split(d.text, chr(10))[1]) + 1) AS completion, l.quality = 1 AS label "
    "FROM documents d JOIN labels l USING (doc_id))"
)


def stepwise(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, prompt, completions, labels``: lines as steps, a step is right unless it is very short."""
    lines = F.split("text", "\n")
    steps = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    df = documents(spark, sf, "doc_id", "text").select("doc_id", lines[0].alias("prompt"), steps.alias("completions"))
    return df.withColumn("labels", F.transform("completions", lambda s: F.length(s) >= 40))


SQL_STEPWISE = (
    "stepwise AS (SELECT doc_id, lines[1] AS prompt, lines[2:] AS completions, "
    "list_transform(lines[2:], lambda s: length(s) >= 40) AS labels "
    "FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))"
)


def token_rows(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, input_ids`` with hashed ids over whole documents."""
    return documents(spark, sf, "doc_id", "text").select("doc_id", hashed_ids(F.col("text")).alias("input_ids"))


def stored_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The same, written once like any tokenised dataset, for jobs that read the ids more than once."""
    return settle(token_rows(spark, sf))


SQL_TOKENS = f"toks AS (SELECT doc_id, {sql_hashed('text')} AS input_ids FROM documents)"


def turn_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """``group_id, idx, prompt_ids, completion_ids`` of the rollouts."""
    return rollouts(spark, sf).select(
        "group_id", "idx", hashed_ids(F.col("prompt")).alias("prompt_ids"), hashed_ids(F.col("completion")).alias("completion_ids")
    )


SQL_TURN_TOKENS = (
    SQL_ROLLOUTS
    + f", tt AS (SELECT group_id, idx, {sql_hashed('prompt')} AS prompt_ids, {sql_hashed('completion')} AS completion_ids FROM rollouts)"
)


def pair_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """``conv_id, prompt_ids, chosen_ids, rejected_ids``."""
    return text_pairs(spark, sf).select(
        "conv_id", *[hashed_ids(F.col(c)).alias(f"{c}_ids") for c in ("prompt", "chosen", "rejected")]
    )


SQL_PAIR_TOKENS = SQL_TEXT_PAIRS + ", ptoks AS (SELECT conv_id, " + ", ".join(
    f"{sql_hashed(c)} AS {c}_ids" for c in ("prompt", "chosen", "rejected")
) + " FROM tpairs)"


# --- logged log-probabilities -----------------------------------------------
# Add-one unigram models: "policy" counts assistant turns, "old" the other turns,
# "ref" all turns.


def logged_turns(spark: SparkSession, sf: str) -> DataFrame:
    """One row per assistant turn, with parallel arrays ``token, policy, old, ref``: what a run logs.

    Written once, bucketed by conversation, so its readers neither compute nor shuffle it again.
    """
    tokens = tokens_of(conversations(spark, sf), "text", "conv_id", "turn", "role")
    mine = F.col("role") == "assistant"
    counts = count_tokens(tokens, {"c_policy": mine, "c_old": ~mine, "c_ref": F.lit(True)})
    size = F.struct(
        F.count("*").alias("v"), *[F.sum(f"c_{m}").alias(m) for m in ("policy", "old", "ref")]
    )
    totals = counts.agg(size.alias("t")).scalar()
    models = counts.withColumn("_t", totals).select(
        "token", "c_ref", *[F.log((F.col(f"c_{m}") + 1.0) / (F.col(f"_t.{m}") + F.col("_t.v"))).alias(m) for m in ("policy", "old", "ref")]
    )
    rows = join_unique(tokens.filter(mine).drop("role"), models, ["token"], "c_ref", ["policy", "old", "ref"])
    listed = rows.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("pos", "token", "policy", "old", "ref"))).alias("_w"))
    turns = listed.select("conv_id", "turn", *[F.col(f"_w.{c}").alias(c) for c in ("token", "policy", "old", "ref")])
    return stored(turns, ["conv_id"], ["conv_id", "turn"])


def token_logps(spark: SparkSession, sf: str) -> DataFrame:
    """Long form ``conv_id, turn, pos, token, policy, old, ref`` of the assistant turns."""
    each = F.posexplode(F.arrays_zip("token", "policy", "old", "ref")).alias("pos", "x")
    return logged_turns(spark, sf).select("conv_id", "turn", each).select("conv_id", "turn", "pos", "x.*")


SQL_LOGPS = (
    f"ctok AS (SELECT conv_id, turn, role, unnest({sql_words('text')}) AS token, "
    f"generate_subscripts({sql_words('text')}, 1) - 1 AS pos FROM conversations), "
    "cnt AS (SELECT token, count(*) FILTER (role = 'assistant') AS cp, count(*) FILTER (role <> 'assistant') AS co, count(*) AS cr FROM ctok GROUP BY token), "
    "tot AS (SELECT count(*) AS v, sum(cp) AS np, sum(co) AS no, sum(cr) AS nr FROM cnt), "
    "mdl AS (SELECT token, ln((cp + 1.0::DOUBLE) / (np + v)) AS policy, ln((co + 1.0::DOUBLE) / (no + v)) AS old, ln((cr + 1.0::DOUBLE) / (nr + v)) AS ref FROM cnt, tot), "
    "tlp AS (SELECT conv_id, turn, pos, token, policy, old, ref FROM ctok JOIN mdl USING (token) WHERE role = 'assistant')"
)


def sequence_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One row per assistant turn: parallel arrays ``policy, old, ref``, a 0/1 ``mask`` and an ``advantage``.

    The mask leaves out punctuation; the advantage is the turn's mean log-ratio against the reference.
    """
    mask = F.transform("token", lambda t: F.when(F.rlike(t, F.lit(r"^[\p{L}\p{N}]")), 1).otherwise(0))
    df = logged_turns(spark, sf).select("conv_id", "turn", "policy", "old", "ref", mask.alias("mask"))
    gap = F.zip_with("policy", "ref", lambda p, r: p - r)
    return df.withColumn("advantage", F.round(array_sum(gap) / F.size("policy"), 6))


# Long form with the same mask and advantage, for oracles that aggregate tokens.
SQL_TOKEN_ROWS = (
    SQL_LOGPS
    + ", adv AS (SELECT conv_id, turn, round(sum(policy - ref) / count(*), 6) AS a, count(*) AS n FROM tlp GROUP BY conv_id, turn)"
    r", tr AS (SELECT t.*, CASE WHEN regexp_matches(token, '^[\p{L}\p{N}]') THEN 1 ELSE 0 END AS mask, a.a, a.n "
    "FROM tlp t JOIN adv a USING (conv_id, turn))"
)


def sequence_logps(spark: SparkSession, sf: str) -> DataFrame:
    """Mean log-prob of each assistant turn: ``conv_id, turn, n, policy, old, ref``."""
    n = F.size("policy").cast("long")
    return logged_turns(spark, sf).select("conv_id", "turn", n.alias("n"), *[(array_sum(F.col(m)) / n).alias(m) for m in ("policy", "old", "ref")])


SQL_SEQ_LOGPS = (
    SQL_LOGPS
    + ", sl AS (SELECT conv_id, turn, count(*) AS n, avg(policy) AS policy, avg(old) AS old, avg(ref) AS ref FROM tlp GROUP BY conv_id, turn)"
)


def pair_logps(spark: SparkSession, sf: str) -> DataFrame:
    """``conv_id, chosen, rejected, ref_chosen, ref_rejected``: last against first assistant turn."""
    seqs = sequence_logps(spark, sf)
    ends = seqs.groupBy("conv_id").agg(
        F.count("*").alias("k"),
        *[f(m, "turn").alias(n) for m, p in (("policy", ""), ("ref", "ref_"))
          for f, n in ((F.max_by, f"{p}chosen"), (F.min_by, f"{p}rejected"))],
    )
    return ends.filter("k > 1").drop("k")


SQL_PAIR_LOGPS = (
    SQL_SEQ_LOGPS
    + ", pl AS (SELECT conv_id, arg_max(policy, turn) AS chosen, arg_min(policy, turn) AS rejected, arg_max(ref, turn) AS ref_chosen, "
    "arg_min(ref, turn) AS ref_rejected FROM sl GROUP BY conv_id HAVING count(*) > 1)"
)


def sql_ls(x: str) -> str:
    """Stable log-sigmoid."""
    return f"(-(greatest(-({x}), 0.0) + ln(1.0 + exp(-abs({x})))))"


def sql_sig(x: str) -> str:
    return f"exp({sql_ls(x)})"


# --- numeric groups ---------------------------------------------------------


def order_rollouts(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as rollouts of their order: a large table of groups with numeric rewards."""
    cols = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")
    li = spread(table(spark, sf, "lineitem", *cols), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return li.select(
        F.col("l_orderkey").alias("group_id"), "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("r_quantity"),
        F.when(F.col("l_discount") > 0.02, F.col("l_discount") * 100).alias("r_discount"),
        F.when(F.col("l_tax") > 0.04, F.col("l_tax") * 100).alias("r_tax"),
    ).withColumn("reward", F.col("r_quantity") + F.coalesce("r_discount", F.lit(0.0)) * 0.5)


ROLLOUT_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]

SQL_ORDER_ROLLOUTS = (
    "orr AS (SELECT *, r_quantity + coalesce(r_discount, 0.0) * 0.5 AS reward FROM (SELECT l_orderkey AS group_id, l_linenumber, l_partkey, l_suppkey, "
    "l_quantity AS r_quantity, CASE WHEN l_discount > 0.02 THEN l_discount * 100 END AS r_discount, "
    "CASE WHEN l_tax > 0.04 THEN l_tax * 100 END AS r_tax FROM lineitem))"
)


# --- distributions ----------------------------------------------------------


def half_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document with words: ``doc_id, halves``, the ``token, p, q`` of its first and second half."""
    docs = documents(spark, sf, "doc_id", "text").filter(F.rlike("text", F.lit(TOKEN_PATTERN)))
    return docs.select("doc_id", half_shares(words(F.col("text"))).alias("halves"))


def half_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same in long form: ``doc_id, token, p, q``."""
    return half_counts(documents(spark, sf, "doc_id", "text")).drop("row")


def half_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, row, token, p, q`` of the given documents, laid out by ``doc_id``; ``row`` tells rows of one ``doc_id`` apart.

    The texts are shuffled, not their tokens: the counts, and groups by document after them, stay where a text is.
    """
    split = docs.repartition("doc_id").select("doc_id", F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("w"))
    tokens = split.select("doc_id", "row", F.size("w").alias("n"), F.posexplode("w").alias("pos", "token"))
    counts = tokens.groupBy("doc_id", "row", "n", "token").agg(F.count_if(F.col("pos") * 2 < F.col("n")).alias("a"), F.count("*").alias("c"))
    first = F.ceil(F.col("n") / 2).cast("double")
    share = lambda n, size: F.coalesce(F.try_divide(n.cast("double"), size), F.lit(0.0))
    return counts.select("doc_id", "row", "token", share(F.col("a"), first).alias("p"), share(F.col("c") - F.col("a"), F.col("n") - first).alias("q"))


def half_distributions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The same as student (first half) and teacher (second half): ``doc_id, token, p``."""
    both = half_table(spark, sf)
    return both.filter("p > 0").select("doc_id", "token", "p"), both.filter("q > 0").select("doc_id", "token", F.col("q").alias("p"))


SQL_HALVES = (
    f"hw AS (SELECT doc_id, {sql_words('text')} AS w FROM documents), "
    "hr AS (SELECT doc_id, len(w) AS n, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos FROM hw), "
    "hc AS (SELECT doc_id, token, pos * 2 >= n AS late, count(*) AS c FROM hr GROUP BY ALL), "
    "hd AS (SELECT *, c / sum(c) OVER (PARTITION BY doc_id, late) AS p FROM hc), "
    "stu AS (SELECT doc_id, token, p FROM hd WHERE NOT late), tea AS (SELECT doc_id, token, p FROM hd WHERE late)"
)
