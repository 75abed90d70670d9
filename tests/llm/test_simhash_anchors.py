import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.data import awkward, documents, prose
from tunetable.llm import simhash_anchors as sa
from tunetable.llm.components import component_roots


def brute_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=3):
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    groups = {}
    for i, (ident, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(ident)
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(ident, f"{p:016x}", least[find(i)]) for i, ((ident, _), p) in enumerate(zip(rows, prints, strict=True))]


def near_rows(seed=3):
    rng = random.Random(seed)
    rows = [(i, t) for i, t, _ in awkward(seed)]
    long = prose(rng, 600).split()
    for i in range(80):  # a cluster of near copies
        words = list(long)
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(len(words))] = "changed%d" % i
        rows.append((1000 - i, " ".join(words)))
    return rows


def test_components_match_brute_force(spark):
    rows = near_rows()
    df = documents(spark, [(i, t, "s") for i, t in rows])
    got = sa.near_duplicates(df).withColumn("fingerprint", sa.hex_print(sa.F.col("fingerprint"))).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute_components(rows), key=key)


def test_one_stays(spark):
    rows = near_rows(9)
    df = documents(spark, [(i, t, "s") for i, t in rows])
    left = sa.one_per_group(df)
    assert left.columns == df.columns
    want = {c for _, _, c in brute_components(rows)}
    got = [r["doc_id"] for r in left.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_empty(spark):
    df = documents(spark, [])
    assert sa.near_duplicates(df).count() == 0 and sa.one_per_group(df).count() == 0


def test_code_covers():
    rng = np.random.default_rng(1)
    half = rng.integers(0, 1 << 32, 500, dtype=np.uint64)
    found, valid = sa.anchors(half)
    again, _ = sa.anchors(found[:, 0])
    assert (again[:, 0] == found[:, 0]).all()  # the home is a code word
    for k in range(32):  # and any half one bit away meets it
        other, ok = sa.anchors(half ^ np.uint64(1 << k))
        assert (((other == found[:, :1]) & ok).any(axis=1)).all()
    gaps = np.bitwise_count(found ^ half[:, None])
    assert gaps[:, 0].max() <= 1 and gaps[valid].max() == 2


@pytest.mark.parametrize("tile", [4, 1024])
def test_links_connect_alike_whatever_the_tile(spark, tile):
    rng = random.Random(2)
    center = rng.getrandbits(64)
    prints = {center}
    for _ in range(150):
        p = center
        for _ in range(rng.randrange(0, 6)):
            p ^= 1 << rng.randrange(40)
        prints.add(p)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    edges = sa.links(df, tile=tile)
    roots = {r["node"]: r["root"] for r in component_roots(edges).collect()}
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for p in prints:
        for q in prints:
            if (p ^ q).bit_count() <= 3:
                parent[find(p)] = find(q)
    sign = lambda p: p - (1 << 64) if p >> 63 else p
    groups = {}
    for p in prints:
        groups.setdefault(find(p), set()).add(sign(p))
    want = {x: min(g) for g in groups.values() if len(g) > 1 for x in g}
    assert roots == want


def test_component_roots(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 7), (200, 90), (90, 200), (60, 90)]
    got = {r["node"]: r["root"] for r in component_roots(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 200: 60, 90: 60, 60: 60}
