"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits; two link at ``DISTANCE`` = 3 or fewer differing bits. Split in two
halves, a linked pair differs by at most one bit in one of them. In a half, the anchors are a
covering code: the perfect Hamming code of length 31 with its covering radius 1, times one
free bit. A half is replicated to every anchor within covering radius plus threshold, 1 + 1,
which is 17 anchors of 2^27 (2 for the 1 in 32 halves that are anchors themselves). The anchor next to
one end of a pair (its home) is then within 2 of the other end, so the two meet there. Within
an anchor only pairs with a home end are compared, by all 64 bits.

Scale: only different fingerprints are replicated, 8 bytes each, so exact copies cost nothing.
An anchor with more than ``TILE`` fingerprints is cut in blocks, and every pair of blocks
is a task unit of bounded size. What leaves a unit is a spanning forest of its links,
never all pairs. Components are found by joins, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetable.llm.components import component_roots
from tunetable.operators.skew import join_unique
from tunetable.session import settle

DISTANCE = 3
SHINGLE = 3
SEED = 42
TILE = 1024
_CHUNK = 1 << 15

_ONE = np.uint64(1)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the whole text: a bit is set if it is set in over half of the shingle hashes. Without words 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    first, last = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for k in range(0, len(first), _CHUNK):
        part = [digest(joined[a:b], SEED) for a, b in zip(first[k : k + _CHUNK], last[k : k + _CHUNK], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int32)
    set_bits = 2 * total > len(first)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """All columns of the input but the text, and ``fingerprint`` as a signed long."""
    kept = [c for c in df.columns if c != text]
    schema = df.select(*kept).withColumn("fingerprint", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(text)], np.uint64).view(np.int64)
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(prints)], names=[*kept, "fingerprint"])

    return df.select(*kept, text).mapInArrow(run, schema)


def _code_tables() -> tuple[np.ndarray, np.ndarray]:
    """Check masks of the Hamming code on bits 0 to 30 (bit i has the index i + 1), and for each
    syndrome the flips that lead to its anchors within distance 2, the home first, padded with 0."""
    checks = np.array([sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1) for k in range(5)], np.uint64)
    flips = np.zeros((32, 17), np.uint64)
    free = 1 << 31
    flips[0, 1] = free
    for s in range(1, 32):
        own = 1 << (s - 1)
        pairs = [1 << (a - 1) | 1 << ((a ^ s) - 1) for a in range(1, 32) if a != s and a < a ^ s]
        flips[s] = [own, own | free, *pairs]
    return checks, flips


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of 32-bit halves: a row of 17 for each, the home first, and which of them count."""
    checks, flips = _code_tables()
    syndrome = np.zeros(len(half), np.int64)
    for k, mask in enumerate(checks):
        syndrome |= (np.bitwise_count(half & mask).astype(np.int64) & 1) << k
    found = half[:, None] ^ flips[syndrome]
    valid = np.ones(found.shape, bool)
    valid[syndrome == 0, 2:] = False
    return found, valid


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
        for side in (0, 1):
            half = (prints >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)
            found, valid = anchors(half)
            home = np.zeros(found.shape, bool)
            home[:, 0] = True
            key = (found | np.uint64(side << 32))[valid].view(np.int64)
            copies = np.broadcast_to(prints[:, None], found.shape)[valid].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(copies), pa.array(home[valid])], names=["anchor", "fingerprint", "home"])


def _forest(key: np.ndarray, prints: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``key``, as (member, smallest member of its component in the run)."""
    left, right = [], []
    at = np.arange(len(key))
    for lag in range(1, len(key)):
        at = at[: np.searchsorted(at, len(key) - lag)]
        at = at[key[at] == key[at + lag]]
        if not len(at):
            break
        near = at[(home[at] | home[at + lag]) & (np.bitwise_count(prints[at] ^ prints[at + lag]) <= distance)]
        left.append(near)
        right.append(near + lag)
    if not left:
        return prints[:0], prints[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(key))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(key)))
    return prints[moved], prints[label[moved]]


def _compare(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)]

        def out(parts):
            a, b = _forest(*parts, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            unit, prints, home = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("unit", "fingerprint", "home"))
            joined = [np.concatenate(x) for x in zip(held, (unit, prints.view(np.uint64), home), strict=True)]
            if not len(joined[0]):
                continue
            last = np.searchsorted(joined[0], joined[0][-1])  # the last unit may go on in the next batch
            yield out([x[:last] for x in joined])
            held = [x[last:] for x in joined]
        yield out(held)

    return run


def links(prints: DataFrame, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """``a, b`` links that connect what the links of the different ``fingerprint`` values connect.

    The halves meet any pair up to distance 3.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the two halves cover distances 0 to 3")
    replicas = prints.mapInArrow(_replicate, "anchor long, fingerprint long, home boolean")
    # Only anchors that are the home of a fingerprint can hold a link found there.
    counts = replicas.groupBy("anchor").agg(F.count("*").alias("n"), F.max("home").alias("lived")).filter("n > 1 AND lived")
    # Stored, so that its size is known when Spark chooses how to join it.
    counts = settle(counts.select("anchor", F.ceil(F.col("n") / tile).cast("int").alias("blocks")))
    met = replicas.join(counts, "anchor")
    block = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    units = met.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A unit is an anchor and two of its blocks; numbering it by hash can only put units together.
    units = units.select(
        F.xxhash64("anchor", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "fingerprint", "home"
    )
    placed = units.repartition("unit").sortWithinPartitions("unit")
    return placed.mapInArrow(_compare(distance), "a long, b long")


def near_duplicates(df: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``<ident>, fingerprint, component`` (fingerprint as long), one row per input row.

    ``component`` is the smallest id among the rows that links reach. NULL and blank texts have the
    fingerprint 0 and link like any other; a NULL id never is the smallest, unless all are NULL.
    Repeated rows are repeated in the result; an empty table gives an empty one.
    """
    rows = df.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    prints = settle(with_fingerprint(rows, "text", shingle))
    apart = settle(prints.groupBy("fingerprint").agg(F.min("ident").alias("least"), F.count("*").alias("rows")))
    roots = component_roots(links(apart.select("fingerprint"), distance))
    return _attach(prints, apart, settle(roots)).withColumnRenamed("ident", ident)


def _attach(prints: DataFrame, apart: DataFrame, roots: DataFrame) -> DataFrame:
    linked = apart.join(roots, F.col("fingerprint") == F.col("node"))
    groups = linked.groupBy("root").agg(F.min("least").alias("component"))
    known = linked.select("fingerprint", "root").join(groups, "root").select(F.col("fingerprint").alias("node"), "component")
    table = apart.join(known, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("component", "least").alias("component"), "rows"
    )
    # Rows of a fingerprint that many copies share are spread.
    return join_unique(prints, table, ["fingerprint"], "rows", ["component"])


def hex_print(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def one_per_group(df: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The input without its near-duplicates: of each component one row of the smallest id stays.

    Rows that share that id are told apart by their text's hash, the smallest of which stays, once.
    """
    # A row is known by the hashes of its id and its text; its id counts when the smallest is chosen.
    least = F.struct(F.col(ident).isNull().alias("no"), F.col(ident).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"))
    prints = settle(with_fingerprint(df.select(least.alias("key"), F.col(text).alias("text")), "text", shingle))
    apart = settle(prints.groupBy("fingerprint").agg(F.min("key").alias("least")))
    roots = settle(component_roots(links(apart.select("fingerprint"), distance)))
    linked = apart.join(roots, F.col("fingerprint") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fingerprint"))
    stay = settle(linked.groupBy("root").agg(F.min("least").alias("l")).select(F.xxhash64("l.id").alias("id_hash"), F.col("l.text_hash").alias("text_hash")))
    packed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.xxhash64(F.col(ident)).alias("id_hash"), F.xxhash64(F.col(text)).alias("text_hash")
    )
    found = packed.join(stay, ["id_hash", "text_hash"], "left_semi")
    once = found.groupBy("id_hash", "text_hash").agg(F.first("row").alias("row"))
    return once.select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns])
