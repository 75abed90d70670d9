"""Builders of preference and stepwise datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.functions.binding import let
from tunetable.functions.messages import message
from tunetable.functions.objectives import backward_scan
from tunetable.functions.render import common_prefix_length
from tunetable.operators.ordering import running_totals
from tunetable.operators.skew import with_group_stats

# Batch names of the two source families, and the marker of a step.
NEWS_BATCHES = ("batch0_cnndm", "cnndm0", "cnndm2")
FORUM_BATCHES = (*(f"batch{i}" for i in range(3, 23)), "edit_b2_eval_test")
STEP_MARK = "ки"
ASSISTANT_HEADER = "\n\nAssistant: "
BARE_ANSWERS = ("True", "False", "Yes", "No")


def summary_prompt(subreddit: Column, title: Column, post: Column) -> Column:
    return F.concat(F.lit("SUBREDDIT: r/"), subreddit, F.lit("\n\nTITLE: "), title, F.lit("\n\nPOST: "), post, F.lit("\n\nTL;DR:"))


def summary_completion(summary: Column) -> Column:
    return F.concat(F.lit(" "), summary)


def batch_prompt(batch: Column, subreddit: Column, title: Column, post: Column, article: Column) -> Column:
    """Prompt by source batch, blank lines collapsed; an unknown batch is an error."""
    tight = lambda x: F.replace(x, F.lit("\n\n"), F.lit("\n"))
    news = F.concat(F.lit("TITLE: "), title, F.lit("\n\n"), tight(article), F.lit("\n\nTL;DR:"))
    return (
        F.when(batch.isin(*NEWS_BATCHES), news)
        .when(batch.isin(*FORUM_BATCHES), summary_prompt(subreddit, title, tight(post)))
        .otherwise(F.raise_error(F.concat(F.lit("unknown batch "), F.coalesce(batch, F.lit("NULL")))))
    )


def choose(samples: Column, choice: Column) -> tuple[Column, Column]:
    """Chosen and rejected of two by the 0-based choice."""
    return F.get(samples, choice), F.get(samples, 1 - choice)


def best_and_first_other(samples: Column, best: Column) -> tuple[Column, Column]:
    """The best sample and the first that differs from it."""
    chosen = F.get(samples, best)
    other = let(chosen, lambda c: F.get(F.filter(samples, lambda s: s != c), F.lit(0)))
    return chosen, other


def transcript_pair(df: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Two transcripts with a common start to prompt, chosen and rejected messages."""
    c, r = F.col(chosen), F.col(rejected)
    size = len(ASSISTANT_HEADER)
    shared = F.substr(c, F.lit(1), common_prefix_length(c, r))
    # The prompt ends at the last assistant header of the common start.
    history = F.substring_index(shared, ASSISTANT_HEADER, -1)
    df = df.withColumn("_cut", F.length(shared) - F.length(history)).filter("_cut > 0")
    text = F.substr(c, F.lit(1), F.col("_cut") - size)
    pattern = r"(?s)\n\n(Human|Assistant): (.*?)(?=\n\nHuman: |\n\nAssistant: |\z)"
    roles = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    contents = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    turn = lambda who, said: message(F.when(who == "Human", "user").otherwise("assistant"), said)
    answer = lambda x: F.array(message("assistant", F.substr(x, F.col("_cut") + 1, F.length(x))))
    return df.select(
        *[x for x in df.columns if x not in (chosen, rejected, "_cut")],
        F.zip_with(roles, contents, turn).alias("prompt"),
        answer(c).alias("chosen"),
        answer(r).alias("rejected"),
    )


def rated_label(models: Column, ratings: Column, model: str, threshold: float = 5) -> Column:
    """Whether the named model's rating reaches the threshold."""
    at = F.array_position(models, model).cast("int")
    return F.when(at > 0, F.get(ratings, at - 1).cast("double") >= threshold)


def best_and_worst(df: DataFrame, keys: Sequence[str], reward: str, index: str, columns: Sequence[str]) -> DataFrame:
    """Best and worst row per group, first row first on ties of the best.

    A pre-aggregating maximum, so a group of any size is fine. In a group of equal
    rewards the worst is the last row.
    """
    rows = F.struct(*columns, reward)
    key = F.struct(F.col(reward), -F.col(index))
    return df.groupBy(*keys).agg(
        F.max_by(rows, key).alias("chosen"), F.min_by(rows, key).alias("rejected"), F.count("*").alias("n")
    )


def expand_step_tree(df: DataFrame, prompt: str, steps: str) -> DataFrame:
    """All labelled paths of a step tree.

    ``steps``: ``completions`` (text, rating), ``chosen_completion`` (0-based) and
    ``human_completion`` (text). Every completion not chosen ends a path; the
    chosen or human one extends it; a step with neither is the last.
    """
    right = lambda c: F.coalesce(c.rating == 1, F.lit(False))
    kept = lambda text, label: F.struct(text.alias("text"), label.alias("label"))
    picked = lambda s: F.get(s.completions, s.chosen_completion)
    none_left = lambda s: s.completions.isNull() & s.human_completion.isNull() & s.chosen_completion.isNull()
    stuck = lambda s: s.chosen_completion.isNull() & s.human_completion.isNull()

    def onward(s: Column) -> Column:
        chosen = kept(picked(s).text, right(picked(s)))
        return F.when(s.chosen_completion.isNotNull(), chosen).otherwise(kept(s.human_completion.text, F.lit(True)))

    def first(test) -> Column:
        return F.array_position(F.transform(steps, lambda s: F.coalesce(test(s), F.lit(False))), True).cast("int")

    n = F.size(steps)
    null_at = F.when(first(none_left) > 0, first(none_left) - 1).otherwise(n)
    stuck_at = F.when(first(stuck) > 0, first(stuck) - 1).otherwise(n)
    df = df.withColumn("_extended", F.least(null_at, stuck_at)).withColumn("_seen", F.least(null_at, stuck_at + 1))
    df = df.withColumn("_spine", F.transform(F.slice(steps, 1, F.col("_extended")), onward))

    def endings(s: Column, i: Column) -> Column:
        others = F.filter(
            F.transform(s.completions, lambda c, j: F.struct(j.alias("j"), kept(c.text, right(c)).alias("c"))),
            lambda x: ~x.j.eqNullSafe(s.chosen_completion),
        )
        return F.transform(others, lambda x: F.concat(F.slice(F.col("_spine"), 1, i), F.array(x.c)))

    ends = F.flatten(F.transform(F.slice(steps, 1, F.col("_seen")), endings))
    paths = F.concat(ends, F.array(F.col("_spine")))
    rest = [c for c in df.columns if c not in (prompt, steps, "_extended", "_seen", "_spine")]
    return df.select(*rest, F.col(prompt).alias("prompt"), F.posexplode(paths).alias("path", "_p")).select(
        *rest, "prompt", "path",
        F.transform("_p", lambda x: x.text).alias("completions"),
        F.transform("_p", lambda x: x.label).alias("labels"),
    )


def marked_steps(text: Column, marks: Column, first_is_extra: Column | None = None) -> tuple[Column, Column, Column]:
    """``(prompt, completions, labels)`` of a solution with a mark after every step.

    ``marks`` is a parallel string that has ``+`` or ``-`` where a step ends. The first
    step is cut off the prompt at "Step 1:", "step 1:" or the question mark. Where
    ``first_is_extra`` holds, the first mark is an annotation error and is dropped.
    """
    parts = F.split(text, STEP_MARK)
    steps = F.slice(parts, 1, F.size(parts) - 1)
    # In the parallel string a mark takes one character.
    widths = F.transform(steps, lambda s: (F.length(s) + 1).cast("double"))
    ends = F.reverse(backward_scan(F.reverse(widths), 1.0))
    labels = F.transform(ends, lambda e: F.substr(marks, e.cast("int"), F.lit(1)) == "+")
    lead = F.get(parts, F.lit(0))
    trim = lambda x: F.regexp_replace(x, r"\A\s+|\s+\z", "")
    rest = F.transform(F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))), trim)
    cut = lambda mark, before, after: F.struct(
        F.concat(F.substring_index(lead, mark, 1), F.lit(before)).alias("prompt"),
        F.concat(F.lit(after), F.substr(lead, F.length(F.substring_index(lead, mark, 1)) + len(mark) + 1, F.length(lead))).alias("step"),
    )
    has = lambda mark: F.contains(lead, F.lit(mark))
    split = (
        F.when(has("Step 1:"), cut("Step 1:", "", "Step 1:"))
        .when(has("step 1:"), cut("step 1:", "", "step 1:"))
        .when(has("?"), cut("?", "?", ""))
        .otherwise(F.raise_error(F.lit("no first step in the prompt")))
    )
    extra = F.lit(False) if first_is_extra is None else first_is_extra
    prompt = F.when(extra, trim(lead)).otherwise(trim(split.prompt))
    completions = F.when(extra, rest).otherwise(F.concat(F.array(trim(split.step)), rest))
    return prompt, completions, F.when(extra, F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(0)))).otherwise(labels)


def wrap_solution(answer: Column) -> Column:
    """Math delimiters around an answer, unless it is a bare truth value."""
    return F.when(answer.isin(*BARE_ANSWERS), answer).otherwise(F.concat(F.lit("$"), answer, F.lit("$")))


def image_turn(text: Column) -> Column:
    """One user turn with an image slot and the text."""
    block = lambda kind, t: F.struct(F.lit(kind).alias("type"), t.cast("string").alias("text"))
    blocks = F.array(block("image", F.lit(None)), block("text", text))
    return F.array(F.struct(F.lit("user").alias("role"), blocks.alias("content")))


def parse_messages(text: Column) -> Column:
    return F.from_json(text, "array<struct<role:string,content:string>>")


def rotate_in_batch(df: DataFrame, batch: str, order: str, value: str, out: str) -> DataFrame:
    """Each row gets the previous row's value, the first row the last one's.

    Rows are matched by their rank in the batch, so a batch of any size is split.
    """
    ranked = running_totals(df, [order], {"_pos": F.lit(1).cast("long")}, [batch])
    donors = with_group_stats(ranked, [batch], {"_n": F.count("*")}).select(
        F.col(batch).alias("_batch"), F.pmod(F.col("_pos") + 1, F.col("_n")).alias("_to"), F.col(value).alias(out)
    )
    same = F.col(batch).eqNullSafe(F.col("_batch")) & (F.col("_pos") == F.col("_to"))
    return ranked.join(donors, same).drop("_pos", "_batch", "_to")


def class_balance(df: DataFrame, label: str, good_weight: float = 1.0, bad_weight: float = 1.0) -> DataFrame:
    """Class counts and recommended weight ranges."""
    counts = df.agg(F.count_if(F.col(label)).alias("g"), F.count("*").alias("n"))
    good = F.greatest(F.col("g"), F.lit(1))
    counts = counts.withColumn("n_desirable", good).withColumn("n_undesirable", F.greatest(F.col("n") - good, F.lit(1)))
    per_good = F.col("n_undesirable") * bad_weight / F.col("n_desirable")
    per_bad = F.col("n_desirable") * good_weight / F.col("n_undesirable")
    return counts.select(
        "n_desirable",
        "n_undesirable",
        F.round(per_good, 2).alias("desirable_low"),
        F.round(per_good * 1.33, 2).alias("desirable_high"),
        F.round(per_bad / 1.33, 2).alias("undesirable_low"),
        F.round(per_bad, 2).alias("undesirable_high"),
    )
