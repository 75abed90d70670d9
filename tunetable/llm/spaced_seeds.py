"""Benchmark decontamination by spaced-seed hashing.

A seed is a mask over a few tokens; positions with 0 are ignored, so a substituted word there
does not change the hash. The masks of an item's length leave no gap: every pattern of equal words that
the verifier accepts has a hit. Every window of every document is hashed under the masks of all lengths
that occur in the benchmark, and every window of an item under its own. Document windows first pass a Bloom filter of the benchmark's hashes, whose size is fixed;
the regions around the hits go through an exact join on the hash, and the overlap along the
hit's diagonal is verified: some stretch of ``STRETCH`` tokens (the whole item if it is
shorter) must agree in ``SIMILARITY`` of its tokens or more, position by position.

Tokens are runs of letters, digits and any non-ASCII characters, lower-cased, so case, white space
and ASCII punctuation do not hide a passage. Characters of scripts without blanks are a token each. Items
with fewer than ``SPAN`` tokens may not differ in any, so their one seed is the whole item.

Scale: the documents are read once and only regions with a hit leave the scan. What each task
holds besides is the Bloom filter (``BLOOM_BITS`` / 8 bytes); a benchmark too large for it makes
more regions, not other results. The joins are left to Spark: small benchmarks are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetable.llm.text import whole
from tunetable.session import settle

# Any SPAN words of which at most one differs: some such stretch is in every pattern that is similar enough.
MASKS = ("11110", "01111", "11101", "11011", "10111")
SPAN = 5
# Heavier masks for the lengths that allow them: any 13 of 16 words, 12 of 15, and 10 of 12 have a hit.
LONG_MASKS = (
    (16, ("1110100111", "11101111", "1110000010111", "101100011011", "11110100011")),
    (15, ("1111011", "11010001011", "1010001000111")),
    (12, ("11101011", "101100111", "10100011101")),
)
STRETCH = 16
SIMILARITY = 0.8
BLOOM_BITS = 26

_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK64 = (1 << 64) - 1
_IS_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
# Scripts written without blanks: Thai and Lao, Myanmar, Khmer, kana and Han.
_UNSPACED = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * np.uint64(pow(base, have, 1 << 64))
        have += take
    return out


class _Tokens:
    """Hashes of the tokens of UTF-8 text, by prefix sums of a polynomial over the bytes."""

    def __init__(self) -> None:
        self.up = _powers(_BASE, _BLOCK + 1)
        self.down = _powers(pow(_BASE, -1, 1 << 64), _BLOCK + 1)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        parts, at = [], 0
        while at < len(data):
            end = min(at + _BLOCK, len(data))
            if end < len(data):  # cut where no token is cut; a token longer than a block is cut alike everywhere
                gaps = np.flatnonzero(~_IS_WORD[data[at:end][::-1]][: _BLOCK - 1])
                if len(gaps):
                    end -= int(gaps[0])
                else:  # nor a character
                    end -= next((k for k in range(min(4, end - at)) if data[end - k] & 0xC0 != 0x80), 0)
            parts.append(self.block(data[at:end]))
            at = end
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def block(self, data: np.ndarray) -> np.ndarray:
        word = np.zeros(len(data) + 2, np.int8)
        word[1:-1] = _IS_WORD[data]
        edge = np.diff(word)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        cut = _character_cuts(data)
        if len(cut):
            cut = cut[(word[cut] == 1) & (word[cut + 1] == 1)]
            start, end = np.union1d(start, cut), np.union1d(end, cut)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        h = (sums[end] - sums[start]) * self.down[start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h | np.uint64(1)  # 0 stands for no token


def _character_cuts(data: np.ndarray) -> np.ndarray:
    """Bytes before and after each character of a script without blanks."""
    lead = np.flatnonzero(data >= 0xE0)
    lead = lead[lead + 2 < len(data)]
    if not len(lead):
        return lead
    tail = lambda k: (data[np.minimum(lead + k, len(data) - 1)] & 0x3F).astype(np.int64)
    first, four = data[lead].astype(np.int64), data[lead] >= 0xF0
    code = np.where(four, (first & 7) << 18 | tail(1) << 12 | tail(2) << 6 | tail(3), (first & 15) << 12 | tail(1) << 6 | tail(2))
    alone = np.zeros(len(lead), bool)
    for low, high in _UNSPACED:
        alone |= (code >= low) & (code <= high)
    return np.union1d(lead[alone], np.minimum(lead[alone] + 3 + four[alone], len(data)))


def _masks(words: int) -> tuple[str, ...]:
    """The masks of an item of so many words, each from a 1 to a 1."""
    if words < SPAN:
        return ("1" * words,) if words else ()
    return next((m for least, m in LONG_MASKS if words >= least), tuple(sorted({m.strip("0") for m in MASKS})))


def _seeds(tokens: np.ndarray, masks: Sequence[str]) -> Iterator[np.ndarray]:
    """For each mask the hashes of all windows."""
    for mask in masks:
        n = max(0, len(tokens) - len(mask) + 1)
        total = np.full(n, int(mask, 2) * 0xD6E8FEB86659FD93 & _MASK64, np.uint64)
        for j, bit in enumerate(mask):
            if bit == "1":
                total += tokens[j : j + n] * np.uint64(pow(_BASE, 2 * j + 3, 1 << 64))
        total ^= total >> np.uint64(31)
        total *= np.uint64(0x94D049BB133111EB)
        yield total ^ (total >> np.uint64(30))


def _slots(seeds: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two Bloom slots of each hash."""
    return seeds >> np.uint64(64 - bits), (seeds * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - bits)


def _has(bloom: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bloom[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _bytes_of(column: pa.Array) -> Iterator[np.ndarray]:
    for value in column:
        yield np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.empty(0, np.uint8)


def _benchmark_seeds(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``item, tokens`` and ``seed, item, at`` of ``item, text`` rows."""

    def run(batches):
        hashed = _Tokens()
        for batch in batches:
            tokens = [hashed(x).view(np.int64) for x in _bytes_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(tokens, pa.list_(pa.int64()))], names=["item", "tokens"])

    def seeds(batches):
        for batch in batches:
            for item, value in zip(batch.column("item"), batch.column("tokens"), strict=True):
                tokens = np.array(value.as_py(), np.int64).view(np.uint64)
                for h in _seeds(tokens, _masks(len(tokens))):
                    at = pa.array(np.arange(len(h), dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array([item.as_py()] * len(h), batch.schema.field("item").type), at], names=["seed", "item", "at"])

    kind = items.schema["item"].dataType.simpleString()
    tokens = settle(items.select("item", F.lower(whole(F.col("text"))).alias("text")).mapInArrow(run, f"item {kind}, tokens array<long>"))
    return tokens, settle(tokens.mapInArrow(seeds, f"seed long, item {kind}, at int"))


def _bloom(seeds: DataFrame, bits: int) -> np.ndarray:
    """A filter of 2^bits bits, combined by Spark; at most 2^bits / 64 words come to the driver."""

    def run(batches):
        for batch in batches:
            both = np.concatenate(_slots(batch.column("seed").to_numpy(zero_copy_only=False).view(np.uint64), bits))
            bit = np.uint64(1) << (both & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((both >> np.uint64(6)).view(np.int64)), pa.array(bit.view(np.int64))], names=["word", "bit"])

    words = seeds.select("seed").mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(max(1, (1 << bits) // 64), np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def _regions(docs: DataFrame, bloom: np.ndarray, bits: int, masks: Sequence[str]) -> DataFrame:
    """Stretches of the ``key, text`` rows around windows that pass the filter: ``key, start, tokens,
    hits`` with each hit's seed and its place in the stretch."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def found(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, seed = [], []
        for h in _seeds(tokens, masks):
            one, two = _slots(h, bits)
            hit = np.flatnonzero(_has(shared.value, one))
            hit = hit[_has(shared.value, two[hit])]
            at.append(hit)
            seed.append(h[hit])
        at, seed = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (at, seed))
        order = np.argsort(at, kind="stable")
        return at[order], seed[order]

    def run(batches):
        hashed = _Tokens()
        schema = pa.schema([("key", out_key), ("start", pa.int32()), ("text_words", pa.int64()), ("tokens", pa.list_(pa.int64())), ("hits", pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))])
        for batch in batches:
            rows: list[dict] = []
            # Texts are hashed together, with a stretch of no tokens between two of them.
            for first, tokens, owner in _joined(batch.column("text"), hashed):
                at, seed = found(tokens)
                if not len(at):
                    continue
                cuts = np.flatnonzero((np.diff(at) > 2 * STRETCH) | (np.diff(owner[at]) != 0)) + 1
                for a, s in zip(np.split(at, cuts), np.split(seed, cuts), strict=True):
                    doc = owner[a[0]]
                    low, high = np.searchsorted(owner, doc), np.searchsorted(owner, doc, "right")
                    start, end = max(low, a[0] - STRETCH), min(high, a[-1] + 2 * STRETCH)
                    rows.append({"key": batch.column("key")[first + int(doc)].as_py(), "start": int(start - low), "text_words": int(high - low), "tokens": tokens[start:end].view(np.int64), "hits": [{"seed": int(x), "at": int(p - start)} for x, p in zip(s.view(np.int64), a, strict=True)]})
            yield pa.RecordBatch.from_pylist(rows, schema)

    from pyspark.sql.pandas.types import to_arrow_type

    key = docs.schema["key"].dataType
    out_key = to_arrow_type(key)
    return docs.select("key", F.lower(whole(F.col("text"))).alias("text")).mapInArrow(
        run, f"key {key.simpleString()}, start int, text_words long, tokens array<long>, hits array<struct<seed:long,at:int>>"
    )


def _joined(column: pa.Array, hashed: _Tokens) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Tokens of runs of texts of about a block, and the text (counted from the first) of each token.

    Texts are joined by blanks; windows over a border are harmless, as hits are verified inside one text.
    """
    first, size, parts, counts = 0, 0, [], []
    for i, data in enumerate(_bytes_of(column)):
        tokens = hashed(data)
        parts.append(tokens)
        counts.append(len(tokens))
        size += len(tokens)
        if size >= _BLOCK // 8:
            yield first, np.concatenate(parts), np.repeat(np.arange(len(counts)), counts)
            first, size, parts, counts = i + 1, 0, [], []
    if parts:
        yield first, np.concatenate(parts), np.repeat(np.arange(len(counts)), counts)


def _overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, similarity: float) -> tuple[int, int, int, int]:
    """Best stretch along a diagonal: (equal tokens, its length, start in the region, tokens of the item
    inside verified stretches); zeros if none is similar enough. The item's tokens before or behind
    the document count as differing, so a passage that the document cuts off is judged like any other."""
    low, high = max(0, diagonal), min(len(doc), diagonal + len(item))
    if high <= low:
        return 0, 0, 0, 0
    size = min(STRETCH, len(item))
    same = np.zeros(len(item), bool)
    same[low - diagonal : high - diagonal] = doc[low:high] == item[low - diagonal : high - diagonal]
    sums = np.concatenate(([0], np.cumsum(same)))
    equal = sums[size:] - sums[:-size]
    good = np.flatnonzero(equal >= np.ceil(similarity * size - 1e-9))
    if not len(good):
        return 0, 0, 0, 0
    best = good[np.argmax(equal[good])]
    covered = np.zeros(len(item), bool)
    for g in good:
        covered[g : g + size] = True
    return int(equal[best]), size, int(max(low, diagonal + best)), int(covered.sum())


def _verified(candidates: DataFrame, similarity: float) -> DataFrame:
    schema = candidates.select("key", "item").schema.simpleString()[7:-1].replace("key:", "key ", 1).replace("item:", "item ", 1)

    def run(batches):
        for batch in batches:
            kept, values = [], []
            for i in range(batch.num_rows):
                doc, item = (np.array(batch.column(c)[i].as_py(), np.int64) for c in ("tokens", "item_tokens"))
                best = max((_overlap(doc, item, d, similarity) for d in batch.column("diagonals")[i].as_py()), key=lambda x: (x[3], x[0]))
                if best[1]:
                    kept.append(i)
                    values.append((best[0], best[1], batch.column("start")[i].as_py() + best[2], best[3], len(item), batch.column("text_words")[i].as_py()))
            part = batch.select(["key", "item"]).take(pa.array(kept, pa.int64()))
            found = [pa.array([v[k] for v in values], pa.int64()) for k in range(len(_FOUND))]
            yield pa.RecordBatch.from_arrays([*part.columns, *found], names=["key", "item", *_FOUND])

    return candidates.mapInArrow(run, f"{schema}, " + ", ".join(f"{c} long" for c in _FOUND))


_FOUND = ("equal_words", "stretch_words", "start_word", "covered_words", "item_words", "text_words")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
    bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """One row for each document and benchmark item that overlap: ``key, item`` and the best stretch
    (``equal_words`` of ``stretch_words`` agree, from word ``start_word``), ``covered_words`` of ``item_words``, and the document's ``text_words``.

    NULL and empty texts overlap with nothing. Rows with the same key give one row. A NULL key or item
    id is a value like any other. Empty tables give an empty result.
    """
    items, seeds = _benchmark_seeds(benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text")))
    bloom = _bloom(seeds, bloom_bits)
    # Only masks of lengths that occur: a number of rows that does not grow with the benchmark.
    lengths = [r[0] for r in items.select(F.least(F.size("tokens"), F.lit(STRETCH)).alias("n")).distinct().collect()]
    masks = sorted({m for n in lengths for m in _masks(n)})
    regions = settle(_regions(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), bloom, bloom_bits, masks).withColumn("region", F.monotonically_increasing_id()))
    hits = regions.select("region", F.explode("hits").alias("hit")).select("region", "hit.*")
    met = hits.withColumnRenamed("at", "doc_at").join(seeds, "seed")
    pairs = met.groupBy("region", "item").agg(F.collect_set(F.col("doc_at") - F.col("at")).alias("diagonals"))
    full = pairs.join(regions.drop("hits"), "region").join(
        items.select(F.col("item").alias("i"), F.col("tokens").alias("item_tokens")), F.col("item").eqNullSafe(F.col("i"))
    )
    found = _verified(full.select("key", "item", "start", "text_words", "tokens", "diagonals", "item_tokens"), similarity)
    best = F.max(F.struct("covered_words", "equal_words", (-F.col("start_word")).alias("late"), "stretch_words", "item_words", "text_words")).alias("b")
    return found.groupBy("key", "item").agg(best).select(
        "key", "item", "b.equal_words", "b.stretch_words", (-F.col("b.late")).alias("start_word"), "b.covered_words", "b.item_words", "b.text_words"
    )


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = SPAN, **options
) -> DataFrame:
    """The documents that overlap with no benchmark item, with the columns of the input.

    An item of fewer than ``least_words`` words is too little evidence inside a longer text, where anyone may write
    them: it removes only documents that are that item and nothing else. ``leaks`` reports it everywhere.
    """
    named = F.struct(F.xxhash64(F.col(key)).alias("id_hash"), F.xxhash64(F.col(text)).alias("text_hash"))
    found = leaks(docs.select(named.alias("key"), F.col(text).alias("text")), benchmark, "key", "text", **options)
    found = found.filter((F.col("item_words") >= least_words) | (F.col("item_words") == F.col("text_words")))
    gone = settle(found.select("key.id_hash", "key.text_hash").distinct())
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), named.alias("k"))
    left = packed.join(gone, (F.col("k.id_hash") == F.col("id_hash")) & (F.col("k.text_hash") == F.col("text_hash")), "left_anti")
    return left.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
