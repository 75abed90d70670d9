"""Column expressions over token arrays: masks, labels, truncation, padding."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

IGNORED = -100  # label of a position that takes no part in the objective
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"


def words(text: Column) -> Column:
    """Words and single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN_PATTERN))


def hashed_ids(text: Column) -> Column:
    """Token ids of 31 bits from a hash: no vocabulary, so it also works on streams."""
    slot = lambda t: F.shiftright(F.conv(F.substr(F.md5(t), F.lit(1), F.lit(8)), 16, 10).cast("long"), 1).cast("int")
    return F.transform(words(text), slot)


def token_id(token: str) -> int:
    """The id that ``hashed_ids`` gives a token."""
    return int(hashlib.md5(token.encode()).hexdigest()[:8], 16) >> 1


def _n(n: Column | int) -> Column:
    return F.lit(n) if isinstance(n, int) else n


def first_n(ids: Column, n: Column | int) -> Column:
    return F.slice(ids, 1, F.greatest(_n(n), F.lit(0)))


def last_n(ids: Column, n: Column | int) -> Column:
    kept = F.least(F.greatest(_n(n), F.lit(0)), F.size(ids))
    return F.slice(ids, F.greatest(F.size(ids) - kept + 1, F.lit(1)), kept)


def after(ids: Column, n: Column | int) -> Column:
    """All but the first ``n``."""
    return F.slice(ids, _n(n) + 1, F.greatest(F.size(ids) - _n(n), F.lit(0)))


def round_up(n: Column, multiple: int) -> Column:
    return (F.ceil(n / F.lit(multiple)) * multiple).cast("int")


def pad(ids: Column, n: Column | int, value: Column | int, side: str = "right") -> Column:
    """Fill up to ``n`` entries."""
    fill = F.array_repeat(_n(value), F.greatest(_n(n) - F.size(ids), F.lit(0)))
    if side not in ("left", "right"):
        raise ValueError("side is 'left' or 'right'")
    return F.concat(ids, fill) if side == "right" else F.concat(fill, ids)


def add_special(ids: Column, first: int | None = None, last: int | None = None) -> Column:
    """Add a start or end id where it is missing."""
    if first is not None:
        there = (F.size(ids) > 0) & (F.get(ids, F.lit(0)) == first)
        ids = F.when(there, ids).otherwise(F.concat(F.array(F.lit(first)), ids))
    if last is not None:
        there = (F.size(ids) > 0) & (F.get(ids, F.size(ids) - 1) == last)
        ids = F.when(there, ids).otherwise(F.concat(ids, F.array(F.lit(last))))
    return ids


def completion_mask(prompt: Column, full: Column) -> Column:
    """0 over the prompt, 1 over the rest."""
    return F.concat(F.array_repeat(F.lit(0), F.size(prompt)), F.array_repeat(F.lit(1), F.size(full) - F.size(prompt)))


def is_prefix(prompt: Column, full: Column) -> Column:
    return first_n(full, F.size(prompt)) == prompt


def answer_boundary(prompt: Column, full: Column) -> Column:
    """Where the answer starts: one earlier if the last prompt token merged with the answer."""
    return F.size(prompt) - F.when(is_prefix(prompt, full), 0).otherwise(1)


def checked_pair_prompts(chosen: Column, rejected: Column) -> Column:
    """Count of differing prompt positions of a pair; more than one, in content or length, is an error."""
    shared = F.least(F.size(chosen), F.size(rejected))
    differing = F.size(F.filter(F.zip_with(first_n(chosen, shared), first_n(rejected, shared), lambda a, b: a != b), lambda x: x))
    apart = F.abs(F.size(chosen) - F.size(rejected))
    return F.when(
        (differing > 1) | (apart > 1), F.raise_error(F.lit("the two prompts of a pair may differ by one token only"))
    ).otherwise(differing)


def answer_span(labels: Column) -> tuple[Column, Column]:
    """0-based first labelled position and number of labelled positions; 0 and 0 if none."""
    marks = F.transform(labels, lambda x: x != IGNORED)
    return F.greatest(F.array_position(marks, True) - 1, F.lit(0)).cast("int"), F.size(F.filter(marks, lambda x: x))


def assistant_mask(messages: Column) -> Column:
    """1 on the tokens of assistant turns; a conversation without any is an error."""
    runs = F.transform(messages, lambda m: F.array_repeat(F.when(m.role == "assistant", 1).otherwise(0), n_words(m.content)))
    mask = F.flatten(runs)
    return F.when(F.array_contains(mask, 1), mask).otherwise(F.raise_error(F.lit("no assistant token in the conversation")))


def masked_labels(ids: Column, mask: Column) -> Column:
    return F.zip_with(ids, mask, lambda i, m: F.when(m == 1, i).otherwise(IGNORED))


def truncate_lists(df: DataFrame, n: int) -> DataFrame:
    """Cut every list column to ``n`` entries."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: first_n(F.col(c), n) for c in lists})


def truncate_pair(prompt: Column, completion: Column, n_prompt: int, n_completion: int) -> tuple[Column, Column]:
    """The last prompt ids and the first completion ids."""
    return last_n(prompt, n_prompt), first_n(completion, n_completion)


def _cut_prompt(prompt: Column, n: int, mode: str) -> Column:
    if mode not in ("keep_start", "keep_end"):
        raise ValueError("mode is 'keep_start' or 'keep_end'")
    return first_n(prompt, n) if mode == "keep_start" else last_n(prompt, n)


def truncate_two_stage(
    prompt: Column, answer: Column, max_length: int, max_prompt: int, mode: str, first: int | None = None, last: int | None = None
) -> tuple[Column, Column]:
    """Cut the prompt first, then the answer, with room for special ids still to come."""
    room = F.lit(max_length)
    if first is not None:
        room = room - F.when((F.size(prompt) > 0) & (F.get(prompt, F.lit(0)) != first), 1).otherwise(0)
    if last is not None:
        room = room - F.when((F.size(answer) > 0) & (F.get(answer, F.size(answer) - 1) != last), 1).otherwise(0)
    return _two_stage(prompt, answer, F.size(answer), room, max_prompt, mode)


def truncate_pair_two_stage(
    prompt: Column, chosen: Column, rejected: Column, max_length: int, max_prompt: int, mode: str
) -> tuple[Column, Column, Column]:
    """Two-stage truncation driven by the longer response, so both sides keep one prompt."""
    longer = F.greatest(F.size(chosen), F.size(rejected))
    cut, c = _two_stage(prompt, chosen, longer, F.lit(max_length), max_prompt, mode)
    _, r = _two_stage(prompt, rejected, longer, F.lit(max_length), max_prompt, mode)
    return cut, c, r


def _two_stage(prompt: Column, answer: Column, answer_size: Column, room: Column, max_prompt: int, mode: str):
    cut = F.when(F.size(prompt) + answer_size > room, _cut_prompt(prompt, max_prompt, mode)).otherwise(prompt)
    short = F.when(F.size(cut) + answer_size > room, first_n(answer, room - max_prompt)).otherwise(answer)
    return cut, short


def truncate_joined(prompt: Column, completion: Column, n: int, mode: str) -> tuple[Column, Column]:
    """Ids and completion mask of the joined sequence, cut at one end."""
    ids = F.concat(prompt, completion)
    mask = completion_mask(prompt, ids)
    keep = first_n if mode == "keep_start" else last_n
    return keep(ids, n), keep(mask, n)


def valid_only(values: Column, mask: Column) -> Column:
    """The entries whose mask is 1, in order."""
    pairs = F.filter(F.zip_with(values, mask, lambda v, m: F.struct(v.alias("v"), m.alias("m"))), lambda x: x.m == 1)
    return F.transform(pairs, lambda x: x.v)


def first_true(flags: Column) -> Column:
    """0-based index of the first true; the length if none."""
    return F.coalesce(F.nullif(F.array_position(flags, True), F.lit(0)) - 1, F.size(flags)).cast("int")


def truncate_at_stop(ids: Column, stop: int, fill: int) -> tuple[Column, Column]:
    """Fill after the first stop id; also the mask of what is kept."""
    end = F.least(first_true(F.transform(ids, lambda x: x == stop)) + 1, F.size(ids))
    mask = pad(F.array_repeat(F.lit(1), end), F.size(ids), 0)
    return pad(first_n(ids, end), F.size(ids), fill), mask


def position_ids(seq_lengths: Column) -> Column:
    """Positions that restart at every packed sequence."""
    nonempty = F.filter(seq_lengths, lambda n: n > 0)
    return F.flatten(F.transform(nonempty, lambda n: F.sequence(F.lit(0), n - 1)))


def mask_sequence_starts(labels: Column, positions: Column) -> Column:
    return F.zip_with(labels, positions, lambda x, p: F.when(p == 0, IGNORED).otherwise(x))


def stepwise_labels(
    prompt: Column,
    steps: Column,
    labels: Column,
    separator: int,
    first: int | None = None,
    max_prompt: int | None = None,
    max_completion: int | None = None,
    max_length: int | None = None,
    last_only: bool = False,
) -> tuple[Column, Column]:
    """Ids and labels: the label of a step sits on the separator that ends it."""
    marked = F.transform(labels, lambda x, i: F.when(F.lit(not last_only) | (i + 1 == F.size(labels)), x.cast("int")).otherwise(IGNORED))
    ids = F.flatten(F.transform(steps, lambda s: F.concat(s, F.array(F.lit(separator)))))
    marks = F.flatten(F.zip_with(steps, marked, lambda s, m: F.concat(F.array_repeat(F.lit(IGNORED), F.size(s)), F.array(m))))
    if first is not None:
        prompt = F.concat(F.array(F.lit(first)), prompt)
    if max_prompt is not None:
        prompt = last_n(prompt, max_prompt)
    if max_completion is not None:
        ids, marks = first_n(ids, max_completion), first_n(marks, max_completion)
    ids, marks = F.concat(prompt, ids), F.concat(F.array_repeat(F.lit(IGNORED), F.size(prompt)), marks)
    if max_length is not None:
        ids, marks = first_n(ids, max_length), first_n(marks, max_length)
    return ids, marks


def ended(ids: Column, end_ids: list[int]) -> Column:
    """Whether the last id is an end (or fill) id."""
    return F.coalesce(F.get(ids, F.size(ids) - 1).isin(*end_ids), F.lit(False))


def drop_truncated(mask: Column, ids: Column, end_ids: list[int]) -> Column:
    """Zero the mask of rows that did not end."""
    return F.when(ended(ids, end_ids), mask).otherwise(F.transform(mask, lambda m: m * 0))
