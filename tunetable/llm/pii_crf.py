"""Personal data by patterns and a skip-chain conditional random field.

Patterns with checks give the base spans: mail addresses, IPv4 addresses, card and phone
numbers. Around them a CRF labels the tokens that hold a digit or ``@``: a token's shape gives the
node potential; neighbours in the text share a chain potential, and equal or similar tokens
(the same letters and digits), however far apart, share a skip potential. Loopy belief propagation then makes labels
agree across the document. A token that ends with a personal label and that no base span touches is an
added span; base spans stay.

Training is piecewise, in closed form: each potential is the smoothed log frequency of labels
given by the base spans, for each shape, each neighbour pair and each skip pair, counted by Spark over all documents.
Bare mentions of a base span's token are what the field is to label, so they and their pairs are not counted.
The tables are bounded by the number of shapes (2^15) times labels.

Scale: texts are read once. Only documents with candidate tokens leave the scan, as short arrays; a
document's graph has as many edges as tokens (a token is linked to its last equal one, never to all).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetable.llm.text import whole
from tunetable.session import settle

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
ROUNDS = 8
DAMPING = 0.3
# Belief from which a token is a span.
CERTAIN = 0.9
# Share of the corpus's label frequencies in a shape's, and of chance in a label pair's. Shares, so that
# what is found does not depend on the corpus's size.
SMOOTH = 0.01
# Share of a label that no token has.
RARE = 1e-4

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Possessive, and looked at once: a long run of characters without a digit costs its length.
_WORD = re.compile(r"[^\x20\x09-\x0D]++")
_ANY = re.compile(r"[0-9@]")
_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ the name is read backwards, so that long words without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        left = text[done:at]
        name = len(left) - len(left.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if name else None
        if domain:
            yield at - name, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` by kind, then start: leftmost matches of each kind that pass its checks."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def _shape(token: str, before: str, after: str) -> int:
    """Bits of a token's look and its neighbours'; at most 2^15 values."""
    n = sum("0" <= c <= "9" for c in token)
    size = sum(n >= k for k in (1, 4, 7, 8, 12, 16, 20))
    digit = lambda s: any("0" <= c <= "9" for c in s)
    bits = (
        "@" in token, token.startswith("+"), "(" in token, "-" in token, any(c.isalpha() for c in token),
        min(token.count("."), 3) & 1, min(token.count("."), 3) >> 1, digit(before), digit(after), before.startswith("+"), before.startswith("("), "-" in after,
    )
    return size << 12 | sum(bool(b) << i for i, b in enumerate(bits))


def _tokens(text: str, spans: list[tuple[int, int, int]]) -> dict[str, list[int]]:
    """Candidate tokens: place, shape, skip key, label, and whether the token before is a candidate too."""
    found = [(m.start(), m.end()) for m in _WORD.finditer(text) if _ANY.search(text, m.start(), m.end())]
    out: dict[str, list[int]] = {"start": [], "end": [], "shape": [], "same": [], "label": [], "next": []}
    by_start = sorted((a, b, k) for k, a, b in spans)
    at = 0
    for i, (a, b) in enumerate(found):
        token = text[a:b]
        core = token.strip(".,;:!?\"'()[]{}<>#*$%&|")
        a, b = (a + token.index(core), a + token.index(core) + len(core)) if core else (a, b)
        near = lambda j, gap: text[found[j][0] : min(found[j][1], found[j][0] + 64)] if 0 <= j < len(found) and abs(gap) <= 1 else ""
        before = near(i - 1, found[i][0] - found[i - 1][1] if i else 9)
        after = near(i + 1, found[i + 1][0] - found[i][1] if i + 1 < len(found) else 9)
        while at < len(by_start) and by_start[at][1] <= a:
            at += 1
        label = by_start[at][2] + 1 if at < len(by_start) and by_start[at][0] < b else 0
        similar = "".join(c for c in core.lower() if c.isalnum() or c == "@")
        for name, value in zip(out, (a, b, _shape(core[:256], before, after), xxhash.xxh64_intdigest(similar.encode("utf-8", "surrogatepass")) >> 1, label, int(bool(before))), strict=True):
            out[name].append(value)
    return out


_FOUND = "spans array<struct<kind:int,start:int,end:int>>, start array<int>, end array<int>, shape array<int>, same array<long>, label array<int>, next array<int>"


def _scan(rows: DataFrame) -> DataFrame:
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        for batch in batches:
            spans, tokens = [], []
            for value in batch.column("text"):
                text = value.as_py()
                own = base_spans(text) if _ANY.search(text) else []
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
                tokens.append(_tokens(text, own) if _ANY.search(text) else dict.fromkeys(("start", "end", "shape", "same", "label", "next"), []))
            column = lambda n, t: pa.array([x[n] for x in tokens], t)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(spans, pa.list_(_SPAN)), *[column(n, longs if n == "same" else ints) for n in ("start", "end", "shape", "same", "label", "next")]],
                names=["key", "spans", "start", "end", "shape", "same", "label", "next"],
            )

    return rows.mapInArrow(run, f"key {kind}, {_FOUND}")


def _graph(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Tokens of a batch of documents as one graph: row, shape, label, chain edges, skip edges (later node of each, then earlier)."""
    size = np.array([len(x) if x.is_valid else 0 for x in batch.column("shape")], np.int64)
    flat = lambda n: batch.column(n).flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(size)), size)
    shape, label, same = flat("shape"), flat("label"), flat("same")
    chain = np.flatnonzero(flat("next").astype(bool))
    chain = chain[chain > 0]
    chain = chain[row[chain] == row[chain - 1]]
    order = np.lexsort((np.arange(len(same)), same, row))
    twin = (row[order][1:] == row[order][:-1]) & (same[order][1:] == same[order][:-1])
    late, early = order[1:][twin], order[:-1][twin]
    apart = (late != early + 1) | ~np.isin(late, chain)  # neighbours in the text have their chain edge
    return row, shape, label, (chain, chain - 1), (late[apart], early[apart])


def _mentions(row: np.ndarray, shape: np.ndarray, same: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Unlabelled tokens equal to a labelled one of their document. One to three digits alone mention nothing."""
    _, key = np.unique(np.stack((row, same)), axis=1, return_inverse=True)
    known = np.zeros(len(row), bool)
    known[key[label > 0]] = True
    return (label == 0) & known[key] & ((shape >> 12 >= 2) | (shape & 1 == 1))


def _counts(found: DataFrame) -> DataFrame:
    """``table, a, b, n``: label counts by shape (table 0), by chain pair (1) and by skip pair (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, shape, label, chain, skip = _graph(batch)
            sure = ~_mentions(row, shape, batch.column("same").flatten().to_numpy(zero_copy_only=False), label)
            chain, skip = ((a[both], b[both]) for a, b in (chain, skip) for both in (sure[a] & sure[b],))
            parts = [(0, shape[sure], label[sure])] + [(k, label[e[1]], label[e[0]]) for k, e in ((1, chain), (2, skip))]
            for kind, a, b in parts:
                pair, n = np.unique(a.astype(np.int64) * 8 + b, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), pa.array((pair >> 3).astype(np.int32)), pa.array((pair & 7).astype(np.int32)), pa.array(n.astype(np.int64))], names=["table", "a", "b", "n"])

    counted = found.select("shape", "same", "label", "next").mapInArrow(run, "table int, a int, b int, n long")
    return counted.groupBy("table", "a", "b").agg(F.sum("n").alias("n"))


class Model:
    """Log potentials of the field."""

    def __init__(self, shapes: Mapping[int, np.ndarray], chain: np.ndarray, skip: np.ndarray) -> None:
        size = len(LABELS)
        prior = self._mixed(sum(shapes.values(), np.zeros(size)), np.full(size, 1 / size), RARE)
        self.unseen = np.log(prior)
        self.shapes = {s: np.log(self._mixed(c, prior)) for s, c in shapes.items()}
        self.chain, self.skip = self._pairs(chain, prior), self._pairs(skip, prior)

    @staticmethod
    def _mixed(counts: np.ndarray, chance: np.ndarray, share: float = SMOOTH) -> np.ndarray:
        """Frequencies with a share of chance; nothing but chance if nothing was counted."""
        total = counts.sum()
        return (1 - share) * counts / total + share * chance if total else chance

    @classmethod
    def _pairs(cls, counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
        """How much more often two labels meet than by chance, smoothed towards chance, either way round."""
        both = cls._mixed(counts + counts.T, np.outer(prior, prior))
        side = both.sum(axis=1)
        return np.log(both / np.outer(side, side))

    def beliefs(self, shape: np.ndarray, chain: tuple[np.ndarray, np.ndarray], skip: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Label probabilities of every token after loopy belief propagation."""
        kinds, at = np.unique(shape, return_inverse=True)
        node = np.array([self.shapes.get(int(k), self.unseen) for k in kinds]).reshape(-1, len(LABELS))[at]
        # Every edge both ways: message k goes from source[k] to target[k]; its reverse is half the list away.
        a, b = np.concatenate((chain[0], skip[0])), np.concatenate((chain[1], skip[1]))
        source, target = np.concatenate((a, b)), np.concatenate((b, a))
        edges = len(a)
        potential = np.exp(np.concatenate((np.repeat(self.chain[None], len(chain[0]), 0), np.repeat(self.skip[None], len(skip[0]), 0))))
        reverse = np.concatenate((np.arange(edges, 2 * edges), np.arange(edges)))
        message = np.zeros((2 * edges, len(LABELS)))
        for _ in range(ROUNDS if edges else 0):
            gathered = node.copy()
            np.add.at(gathered, target, message)
            out = gathered[source] - message[reverse]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.einsum("kij,ki->kj", np.concatenate((potential, potential)), out) + 1e-30)
            new -= new.max(axis=1, keepdims=True)
            message = DAMPING * message + (1 - DAMPING) * new
        total = node.copy()
        np.add.at(total, target, message)
        total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / total.sum(axis=1, keepdims=True)


def fit(found: DataFrame) -> Model:
    """The field's potentials; at most a row per shape and label comes to the driver."""
    size = len(LABELS)
    shapes: dict[int, np.ndarray] = {}
    pairs = {1: np.zeros((size, size)), 2: np.zeros((size, size))}
    for r in _counts(found).collect():
        if r["table"]:
            pairs[r["table"]][r["a"], r["b"]] = r["n"]
        else:
            shapes.setdefault(r["a"], np.zeros(size))[r["b"]] = r["n"]
    return Model(shapes, pairs[1], pairs[2])


def find(df: DataFrame, key: str = "doc_id", text: str = "text", certain: float = CERTAIN) -> DataFrame:
    """``<key>, base, added`` for every row: lists of ``kind, start, end`` by kind, then start (code points, end exclusive).

    NULL and empty texts have none. Repeated rows are repeated in the result. An empty table gives
    an empty result.
    """
    found = settle(_scan(df.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))))
    model = fit(found)
    kind = found.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, shape, label, chain, skip = _graph(batch)
            added: list[list[dict[str, int]]] = [[] for _ in range(batch.num_rows)]
            if len(row):
                belief = model.beliefs(shape, chain, skip)
                best = belief.argmax(axis=1)
                start, end = (batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in ("start", "end"))
                for i in np.flatnonzero((best > 0) & (label == 0) & (belief.max(axis=1) >= certain)):
                    added[row[i]].append({"kind": int(best[i]) - 1, "start": int(start[i]), "end": int(end[i])})
            for spans in added:
                spans.sort(key=lambda s: (s["kind"], s["start"]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("spans"), pa.array(added, pa.list_(_SPAN))], names=["key", "base", "added"])

    spans = "array<struct<kind:int,start:int,end:int>>"
    return found.mapInArrow(run, f"key {kind}, base {spans}, added {spans}").withColumnRenamed("key", key)
