"""Hard-negative mining with bounds along a spanning tree of the anchors.

Anchors are cut into blocks, and a spanning tree of short edges joins those of a block. A candidate's
score with an anchor lies within its score with the parent, plus or minus the edge's length times
the candidate's norm. Walking down the tree, only candidates whose bounds overlap the anchor's windows
are scored again; the others carry their bounds to the next edge. All scores are whole numbers, so
results are exact: the bounds only save work, and where the vectors give no short edges they save none.

Scale: anchors are a share of the rows, so anchors against rows is the work asked for. It is dealt out in blocks of anchors and slices of
rows, both cut by a hash of the id and of bounded size, which meet in one task: the rows are sent once to each block and
the anchors once to each slice. A task keeps the best few of its slice for each anchor; windows with a bounded number of rows
a slice choose among them. Labels share no task beyond these cuts, however common; copies of a vector differ in
their ids and are cut like others. Blocks and slices are parameters: larger ones send less and need more memory in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetable.llm.vectors import scaled, sound_rows
from tunetable.session import settle

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# The window in per cent of the positive's score.
LOW, HIGH = 80, 100
# Anchors of a block and rows of a slice, about: both are cut by a hash.
BLOCK, SLICE = 8192, 8192
# Edges from the root to any anchor, at most: a task holds the bounds of one path.
DEPTH = 16
# Whole products must be exact in doubles; rounding of the real-valued bounds is covered by this share.
_EXACT, _SLACK = float(1 << 53), 1e-9

_ROW = "key long, label {label}, q array<int>"


def _sound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that take part, with whole numbers for entries."""
    for batch in batches:
        lengths, owner, values = sound_rows(batch.column("v"))
        fits = lengths > 0
        offsets = np.concatenate([[0], np.cumsum(lengths[fits])]).astype(np.int32)
        q = pa.ListArray.from_arrays(pa.array(offsets), pa.array(scaled(values, SCALE, (1 << 31) - 1).astype(np.int32)))
        keep = pa.array(fits)
        yield pa.RecordBatch.from_arrays([batch.column("key").filter(keep), batch.column("label").filter(keep), q], ["key", "label", "q"])


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, 0))


def _by_key(table: pa.Table) -> pa.Table:
    return table.sort_by([("key", "ascending")])


def spanning_tree(a: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """``parent, edge`` of every row: Prim's tree in which no row is more than ``depth`` edges from the root.

    The root, whose parent is -1, is the row nearest to the mean.
    """
    n, square = len(a), (a * a).sum(axis=1)
    far = lambda v: np.maximum(square + square[v] - 2 * (a @ a[v]), 0)
    mean = a.mean(axis=0)
    root = int(np.argmin(square - 2 * (a @ mean)))
    parent, level, nearest = np.full(n, -1), np.zeros(n, int), far(root)
    parent[:] = root
    parent[root] = -1
    edge, out = np.zeros(n), np.zeros(n, bool)
    out[root] = True
    for _ in range(n - 1):
        v = int(np.argmin(np.where(out, np.inf, nearest)))
        out[v], edge[v], level[v] = True, np.sqrt(nearest[v]), level[parent[v]] + 1
        if level[v] < depth:
            d = far(v)
            closer = ~out & (d < nearest)
            nearest[closer], parent[closer] = d[closer], v
    return parent, edge


def _tree(table: pa.Table) -> pa.Table:
    table = _by_key(table)
    parent, edge = spanning_tree(_matrix(table))
    place = pa.array(np.arange(table.num_rows), pa.int32())
    return table.append_column("place", place).append_column("parent", pa.array(parent, pa.int32())).append_column("edge", pa.array(edge, pa.float64()))


def walk(a: np.ndarray, parent: np.ndarray, edge: np.ndarray, c: np.ndarray, wanted):
    """Yields ``anchor, rows, scores`` of the rows scored for each anchor, parents before children.

    ``wanted(anchor, low, high)`` gives a mask of the rows whose bounds overlap the anchor's windows.
    """
    norm = np.sqrt((c * c).sum(axis=1))
    if len(a) and len(c) and norm.max() * np.sqrt((a * a).sum(axis=1).max()) >= _EXACT:
        raise ValueError("inner products are too large to be exact")
    children: dict[int, list[int]] = {}
    for v, p in enumerate(parent.tolist()):
        children.setdefault(p, []).append(v)
    stack = [(v, None, None) for v in children.get(-1, [])]
    while stack:
        v, low, high = stack.pop()
        if low is None:
            low = high = c @ a[v]
            need = wanted(v, low, high)
            yield v, np.flatnonzero(need), low[need]
        else:
            reach = edge[v] * norm * (1 + _SLACK) + _SLACK
            low, high = low - reach, high + reach
            rows = np.flatnonzero(wanted(v, low, high))
            # Gathering more than half of the rows costs more than scoring all of them.
            scores = (c @ a[v])[rows] if 2 * len(rows) > len(c) else c[rows] @ a[v]
            low[rows] = high[rows] = scores
            yield v, rows, scores
        stack += [(w, low, high) for w in children.get(v, [])]


def _best(keys: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first rows by falling score, then by key. The keys rise, so a stable sort keeps their order."""
    if len(scores) > 4 * k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= limit)
        return near[np.argsort(-scores[near], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")[:k]


def _arrow_rows(names: list[str], parts: list[tuple]) -> pa.Table:
    columns = [np.concatenate(x) if parts else np.zeros(0, np.int64) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(names)
    return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(names, columns, strict=True)})


def _positives_task(k: int):
    def task(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        anchors, rows = anchors.sort_by([("place", "ascending")]), _by_key(rows)
        a, c = _matrix(anchors), _matrix(rows)
        ids, keys = anchors.column("key").to_numpy(), rows.column("key").to_numpy()
        found = []
        if len(a) and len(c):

            def wanted(v, low, high):
                others = keys != ids[v]
                sure = low[others]
                if len(sure) <= k:
                    return others
                return others & (high >= np.partition(sure, len(sure) - k)[len(sure) - k])

            parent, edge = anchors.column("parent").to_numpy(), anchors.column("edge").to_numpy()
            for v, at, scores in walk(a, parent, edge, c, wanted):
                top = _best(keys[at], scores, k)
                found.append((np.full(len(top), ids[v]), keys[at][top], scores[top].astype(np.int64)))
        return _arrow_rows(["anchor_id", "positive_id", "positive_score"], found)

    return task


def _negatives_task(k: int, low_share: int, high_share: int):
    def task(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        anchors, rows = anchors.sort_by([("place", "ascending")]), _by_key(rows)
        a, c = _matrix(anchors), _matrix(rows)
        ids, keys = anchors.column("key").to_numpy(), rows.column("key").to_numpy()
        _, codes = np.unique(np.array(anchors.column("label").to_pylist() + rows.column("label").to_pylist(), dtype=object).astype(str), return_inverse=True)
        own, label = codes[: len(ids)], codes[len(ids) :]
        windows = [[(w["positive_id"], w["positive_score"]) for w in x or []] for x in anchors.column("windows").to_pylist()]
        found = []
        if len(a) and len(c):

            def wanted(v, low, high):
                need = np.zeros(len(keys), bool)
                for _, p in windows[v]:
                    need |= (100 * high >= low_share * p) & (100 * low <= high_share * p)
                return need & (label != own[v])

            parent, edge = anchors.column("parent").to_numpy(), anchors.column("edge").to_numpy()
            for v, at, scores in walk(a, parent, edge, c, wanted):
                for positive, p in windows[v]:
                    inside = np.flatnonzero((100 * scores >= low_share * p) & (100 * scores <= high_share * p))
                    top = inside[_best(keys[at][inside], scores[inside], k)]
                    one = lambda x: np.full(len(top), x)  # noqa: B023, E731
                    found.append((one(ids[v]), one(positive), keys[at][top], one(p), scores[top].astype(np.int64)))
        return _arrow_rows(["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"], found)

    return task


def _cut(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), key), F.lit(parts)).cast("int")


def _every(parts: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))


def mine(
    df: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block: int = BLOCK,
    slice_rows: int = SLICE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, all by falling score, then id.

    ``is_anchor`` is a condition on the key, named as in ``df``. A score is the inner product of ``floor(256 x)`` entries. Each of an anchor's
    first ``positives`` other rows of its label is met with the first ``negatives`` rows of other labels
    that score between ``low`` and ``high`` per cent of it; one without any gives no row, nor does an anchor without positives.

    Rows with a NULL key, label or vector, a NULL or non-finite entry, or an empty vector take no part, nor do vectors of another
    length than most have (of two equally frequent ones the longer counts). A key is one row: repeated
    rows count once, and of different rows with one key the smallest label, then vector, counts. Ties
    go to the smaller key. An empty table gives an empty result. Other columns are not looked at.
    """
    named = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("v"))
    kind = named.schema["label"].dataType.simpleString()
    whole = named.filter("key IS NOT NULL AND label IS NOT NULL").mapInArrow(_sound, _ROW.format(label=kind))
    marked = df.select(F.col(f"`{key}`").cast("long").alias("key"), is_anchor.alias("anchor")).filter("anchor").select("key").distinct()
    unique = settle(whole.groupBy("key").agg(F.min(F.struct("label", "q")).alias("row")).select("key", "row.label", "row.q"))
    length = unique.groupBy(F.size("q").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = unique.filter(F.size("q") == F.lit(length["d"] if length else 0))
    anchors = settle(rows.join(marked, "key", "left_semi"))
    blocks = max(1, -(-anchors.count() // block))
    slices = max(1, -(-(length["count"] if length else 0) // slice_rows))

    sliced = rows.withColumn("slice", _cut(F.col("key"), slices))
    cut = anchors.withColumn("block", _cut(F.xxhash64("key"), blocks))
    treed = "key long, label " + kind + ", q array<int>, block int, place int, parent int, edge double"

    # Own label: anchors and rows of a label meet, cut like all others.
    near = settle(cut.groupBy("label", "block").applyInArrow(_tree, treed))
    meet = ["label", "block", "slice"]
    sides = near.select("*", _every(slices).alias("slice")), sliced.select("*", _every(blocks).alias("block"))
    found = (
        sides[0].groupBy(*meet).cogroup(sides[1].groupBy(*meet)).applyInArrow(_positives_task(positives), "anchor_id long, positive_id long, positive_score long")
    )
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = settle(found.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= positives).drop("n"))

    # Other labels: every block meets every slice.
    windows = best.groupBy(F.col("anchor_id").alias("key")).agg(F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("windows"))
    every = cut.groupBy("block").applyInArrow(_tree, treed).join(windows, "key", "left")
    meet = ["block", "slice"]
    sides = every.select("*", _every(slices).alias("slice")), sliced.select("*", _every(blocks).alias("block"))
    found = (
        sides[0]
        .groupBy(*meet)
        .cogroup(sides[1].groupBy(*meet))
        .applyInArrow(_negatives_task(negatives, low, high), "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
