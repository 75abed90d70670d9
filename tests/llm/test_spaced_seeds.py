import itertools
import random
import re

from tests.llm.data import awkward, documents, prose
from tunetable.llm import spaced_seeds as ss


def tokens(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def brute(rows, items):
    out = set()
    for i, t, _ in rows:
        doc = tokens(t)
        for j, u in items:
            item = tokens(u)
            if len(item) < ss.SPAN:
                continue
            size = min(ss.STRETCH, len(item))
            for d in range(-len(item), len(doc)):
                same = [0 <= k + d < len(doc) and doc[k + d] == w for k, w in enumerate(item)]
                # a seed must hit, and some stretch must agree
                hit = any(all(same[k + m] for m, b in enumerate(mask) if b == "1") for mask in ss.MASKS for k in range(len(same) - ss.SPAN + 1))
                if hit and any(sum(same[k : k + size]) >= ss.SIMILARITY * size - 1e-9 for k in range(len(same) - size + 1)):
                    out.add((i, j))
    return out


def case(seed=4):
    rng = random.Random(seed)
    items = [(k, prose(rng, rng.randrange(5, 40))) for k in range(12)] + [(50, None), (51, ""), (None, prose(rng, 30)), (7, prose(rng, 25))]
    rows = [(i, t, s) for i, t, s in awkward(seed, 20) if not t or len(t) < 3000]
    for k in range(30):
        words = (items[k % 12][1] or "").split()
        for _ in range(k % 6):
            words[rng.randrange(len(words))] = "other"
        text = prose(rng, rng.randrange(0, 30)) + " " + " ".join(words).upper().replace(" ", ", " if k % 2 else "\n") + " " + prose(rng, rng.randrange(0, 30))
        rows.append((500 + k, text, "s0"))
    rows += [rows[-1], (None, items[14][1], None), (600, (prose(rng, 3000) + " ") + items[3][1] + " " + prose(rng, 40), "s1"), (601, " ".join(["same"] * 400), "s1")]
    return rows, items


def test_leaks_match_brute_force(spark):
    rows, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = ss.leaks(documents(spark, rows), bench).collect()
    pairs = [(r["key"], r["item"]) for r in got]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == brute(rows, items)
    assert all(r["equal_words"] >= ss.SIMILARITY * r["stretch_words"] for r in got)
    left = ss.without_leaks(documents(spark, rows), bench)
    gone = {k for k, _ in brute([(k, t, s) for k, (_, t, s) in enumerate(rows)], items)}
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=key) == sorted(((i, t) for k, (i, t, _) in enumerate(rows) if k not in gone), key=key)


def test_a_full_filter_changes_nothing(spark):
    rows, items = case(6)
    bench = spark.createDataFrame(items, "item_id long, text string")
    few = {(r["key"], r["item"]) for r in ss.leaks(documents(spark, rows), bench, bloom_bits=6).collect()}
    assert few == {(r["key"], r["item"]) for r in ss.leaks(documents(spark, rows), bench).collect()}


def test_blocks_do_not_cut_tokens(monkeypatch):
    import numpy as np

    text = np.frombuffer(("alpha beta, gamma delta " * 50).encode(), np.uint8)
    whole = ss._Tokens()(text)
    monkeypatch.setattr(ss, "_BLOCK", 37)
    assert (ss._Tokens()(text) == whole).all() and len(whole) == 200


def test_empty(spark):
    rows, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert ss.leaks(documents(spark, []), bench).count() == 0
    assert ss.leaks(documents(spark, rows), bench.limit(0)).count() == 0
    assert ss.without_leaks(documents(spark, rows), bench.limit(0)).count() == len(rows)


def rule(doc, item):
    """The stated rule alone, with no seed condition."""
    size = min(ss.STRETCH, len(item))
    for d in range(-len(item), len(doc) + 1):
        same = [0 <= k + d < len(doc) and doc[k + d] == w for k, w in enumerate(item)]
        if item and any(sum(same[k : k + size]) >= ss.SIMILARITY * size - 1e-9 for k in range(len(same) - size + 1)):
            return True
    return False


def test_masks_miss_no_accepted_pattern():
    for n in range(1, 41):
        size = min(n, ss.STRETCH)
        wrong = int(size * (1 - ss.SIMILARITY) + 1e-9)
        for bad in itertools.combinations(range(size), wrong):
            same = [k not in bad for k in range(size)]
            assert any(all(same[k + j] for j, b in enumerate(m) if b == "1") for m in ss._masks(n) for k in range(size - len(m) + 1)), (n, bad)


def test_leaks_follow_the_rule_alone(spark):
    rng = random.Random(12)
    items = [(k, prose(rng, k)) for k in range(1, 41)] + [(60, "\u6f22\u5b57\u306e\u554f\u984c\u3067\u3059")]
    rows = [(1, "x " + items[-1][1] + "\u3002 y", "s"), (2, "\u6f22\u5b57 \u306e\u554f", "s"), (3, "", "s")]
    for k, t in items[:-1]:
        words = t.split()
        for j in range(8):
            some = list(words)
            for at in rng.sample(range(k), min(k, j % 5)):
                some[at] = "other"
            rows.append((100 * k + j, " ".join(["left"] * (j % 3) + some + ["right"] * (j % 2)), "s"))
        every = ["other" if i % 6 == 5 else w for i, w in enumerate(words)]
        rows.append((100 * k + 8, " ".join(["left", *every, "right"]), "s"))
        rows += [(100 * k + 9 + c, prose(rng, 30) + " " + " ".join(words[:c]), "s") for c in range(11, 16)]
        rows += [(100 * k + 30 + c, " ".join(words[-c:]) + " " + prose(rng, 30), "s") for c in range(11, 16)]
    got = {(r["key"], r["item"]) for r in ss.leaks(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    split = lambda t: re.findall("[a-z0-9]+|[\u3040-\u30ff\u4e00-\u9fff]|\u3002", t)
    docs, bench = [(i, split(t)) for i, t, _ in rows], [(i, split(t)) for i, t in items]
    assert got == {(i, j) for i, d in docs for j, u in bench if set(d) & set(u) and rule(d, u)}
    assert (1, 60) in got and (2, 60) not in got


def test_passages_cut_off_by_the_document(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(20)]
    cases = {1: prose(rng, 30).split() + words[:13], 2: words[-13:] + prose(rng, 30).split(), 3: words[:13], 4: prose(rng, 30).split() + words[:12], 5: words[-12:] + prose(rng, 30).split()}
    docs = documents(spark, [(i, " ".join(w), "s") for i, w in cases.items()])
    got = {r["key"]: r for r in ss.leaks(docs, spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")).collect()}
    assert set(got) == {1, 2, 3}
    assert all((r["equal_words"], r["stretch_words"], r["text_words"]) == (13, 16, len(cases[i])) for i, r in got.items())
    assert [got[i]["start_word"] for i in (1, 2, 3)] == [30, 0, 0]


def test_short_items_remove_only_their_copies(spark):
    docs = documents(spark, [(1, "say yes to it", "s"), (2, "Yes!", "s"), (3, "no", "s"), (4, "so one two three four five go", "s"), (5, None, "s")])
    bench = spark.createDataFrame([(1, "yes"), (2, "one two three four five")], "item_id long, text string")
    assert {(r["key"], r["item"]) for r in ss.leaks(docs, bench).collect()} == {(1, 1), (2, 1), (4, 2)}
    assert {r["doc_id"] for r in ss.without_leaks(docs, bench).collect()} == {1, 3, 5}
    assert {r["doc_id"] for r in ss.without_leaks(docs, bench, least_words=1).collect()} == {3, 5}
