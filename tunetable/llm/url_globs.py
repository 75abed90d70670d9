"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed into the bits of a few 64-bit words. One pass over a URL simulates them
all: a Shift-And step moves every state to the next character of its rule, and states in front of
a wildcard also stay where they are. URLs of a batch are stepped together, longest first, so the
work is the number of characters times the number of words.

Globs are matched against the whole canonical URL, host (A-Z lower-cased) and path without
scheme, query or fragment. ``*`` stands for any run of characters but ``/``, ``**`` for any run,
``?`` for one character but ``/``; ``\\`` takes the next character as it is.

Scale: the rules are the only thing a task holds; their size is that of the rule list. URLs
are judged where they are, nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.llm.text import whole

_SLASH = ord("/")
# Below this many URLs still running, they are stepped one by one.
_FEW = 4


@dataclass(frozen=True)
class Rule:
    """A verdict for the URLs that the globs match. Among the rules that match, the one of the
    highest rank decides, among equals the first."""

    name: str | None
    verdict: str
    globs: tuple[str, ...]
    rank: int = 0


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and its subdomains if the path starts with ``path``; longer rules win."""
    exact = "".join("\\" + c if c in "*?\\" else c for c in host + path)
    return Rule(host + path, verdict, (exact + "**", "*." + exact + "**"), 1 + len(host + path))


def canonical_parts(url: Column) -> tuple[Column, Column]:
    """Host and path. NULL and URLs without ``://`` have empty ones."""
    rest = F.regexp_extract(whole(url), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    # A-Z only, whatever the locale.
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


class Automaton:
    """The packed rules. A rule of n elements takes n + 1 bits: bit i is set when i elements are matched."""

    def __init__(self, globs: Sequence[str]) -> None:
        elements = [self._parse(g) for g in globs]
        bits = sum(len(e) for e, _ in elements) + len(elements)
        self.words = max(1, -(-bits // 64))
        step = [0] * 256  # states that may be entered on a byte
        stay = [0] * 256  # states that may remain on a byte
        start, self.ends, at = 0, [], 0
        for parts, loops in elements:
            start |= 1 << at
            for i, part in enumerate(parts):
                for byte in range(256):
                    if part == byte or part is None and byte != _SLASH and not 128 <= byte < 192:
                        step[byte] |= 1 << (at + i + 1)
                    if part is None and 128 <= byte < 192:  # the rest of a UTF-8 character
                        stay[byte] |= 1 << (at + i + 1)
            for i, loop in enumerate(loops):
                for byte in range(256):
                    if loop == "**" or loop == "*" and byte != _SLASH:
                        stay[byte] |= 1 << (at + i)
            self.ends.append(at + len(parts))
            at += len(parts) + 1
        self.start, self.step, self.stay = start, step, stay
        self.start_words, self.step_words, self.stay_words = self._split([start])[0], self._split(step), self._split(stay)

    @staticmethod
    def _parse(glob: str) -> tuple[list[int | None], list[str]]:
        """Elements (a byte, or None for ``?``) and the wildcard in front of each and at the end."""
        data, parts, loops, i = glob.encode("utf-8"), [], [""], 0
        while i < len(data):
            if data[i : i + 1] == b"*":
                wild = "**" if data[i : i + 2] == b"**" else "*"
                loops[-1] = max(loops[-1], wild)
                i += len(wild)
                continue
            if data[i : i + 1] == b"\\" and i + 1 < len(data):
                i += 1
                parts.append(data[i])
            else:
                parts.append(None if data[i : i + 1] == b"?" else data[i])
            loops.append("")
            i += 1
        return parts, loops

    def _split(self, values: Sequence[int]) -> np.ndarray:
        return np.array([[v >> (64 * w) & (1 << 64) - 1 for w in range(self.words)] for v in values], np.uint64)

    def _one(self, data: bytes, state: int) -> int:
        for byte in data:
            state = state << 1 & self.step[byte] | state & self.stay[byte]
            if not state:
                break
        return state

    def matched(self, urls: Sequence[bytes]) -> np.ndarray:
        """A row per URL, a column per glob."""
        size = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-size, kind="stable")
        offset = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else size
        data = np.frombuffer(b"".join(urls), np.uint8)
        state = np.repeat(self.start_words[None, :], len(urls), axis=0)
        sorted_size, sorted_offset = size[order], offset[order]
        final = np.zeros_like(state)
        live, t = int((sorted_size > 0).sum()), 0
        final[live:] = state[live:]
        while live > _FEW:
            byte = data[sorted_offset[:live] + t]
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = moved & self.step_words[byte] | now & self.stay_words[byte]
            t += 1
            left = int(np.searchsorted(-sorted_size, -t, "left"))  # how many are longer than t
            final[left:live] = state[left:live]
            live = left
        for i in range(live):
            first = sum(int(w) << (64 * k) for k, w in enumerate(state[i]))
            ended = self._one(data[sorted_offset[i] + t : sorted_offset[i] + sorted_size[i]].tobytes(), first)
            final[i] = self._split([ended])[0]
        ends = np.array(self.ends, np.int64)
        hits = (final[:, ends // 64] >> (ends % 64).astype(np.uint64)) & np.uint64(1) == 1 if len(ends) else np.zeros((len(urls), 0), bool)
        out = np.empty_like(hits)
        out[order] = hits
        return out


def filter_urls(df: DataFrame, rules: Sequence[Rule], default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """``<key>, host, path, rule, verdict`` for every row; ``rule`` is the deciding rule's name.

    URLs that no rule matches get the default and no rule. Repeated rows are repeated; an empty
    table gives an empty result.
    """
    owners = np.array([i for i, r in enumerate(rules) for _ in r.globs], np.int64)
    by_rank = sorted(range(len(rules)), key=lambda i: (-rules[i].rank, i))
    place = np.empty(len(rules) + 1, np.int64)
    place[by_rank] = np.arange(len(rules))
    place[-1] = len(rules)
    names = [rules[i].name for i in by_rank] + [None]
    verdicts = [rules[i].verdict for i in by_rank] + [default]
    globs = [g for r in rules for g in r.globs]

    host, path = canonical_parts(F.col(url))
    rows = df.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        for batch in batches:
            urls = [(h.as_py() + p.as_py()).encode("utf-8", "surrogatepass") for h, p in zip(batch.column("host"), batch.column("path"), strict=True)]
            hits = automaton.matched(urls)
            ranks = np.where(hits, place[owners][None, :], len(rules)) if len(globs) else np.full((len(urls), 1), len(rules))
            best = ranks.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([names[b] for b in best], pa.string()), pa.array([verdicts[b] for b in best], pa.string())],
                names=["key", "host", "path", "rule", "verdict"],
            )

    schema = f"key {rows.schema['key'].dataType.simpleString()}, host string, path string, rule string, verdict string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
