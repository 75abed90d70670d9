import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.data import awkward, documents, prose
from tunetable.llm import line_dedup as ld

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def brute(rows, least_docs=10, least_chars=1):
    counts = Counter(k for _, t, _ in rows for k in {key(x) for x in (t or "").split("\n")} if len(k) >= least_chars)
    common = {k for k, n in counts.items() if n >= least_docs}
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in common]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def run(spark, rows, **limits):
    got = ld.without_common_lines(documents(spark, rows), **limits).collect()
    return sorted(((r["row"]["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in got), key=repr)


def boiler(seed=3, n=60):
    """Texts with shared lines in several spellings, blanks around them, and repeats inside a text."""
    rng = random.Random(seed)
    shared = ["All Rights Reserved", "ÄÖ gehört uns", "menu | home", "***", "ﬁne print", "一 行"]
    rows = []
    for i in range(n):
        lines = [prose(rng, rng.randrange(1, 9)) for _ in range(rng.randrange(0, 6))]
        for s in shared:
            if rng.random() < 0.4:
                s = rng.choice([s, s.translate(UPPER), f"  {s}\t", f"{s}\r", f"\x0b{s}\x0c"])
                lines.insert(rng.randrange(len(lines) + 1), s)
        rows.append((i, "\n".join(lines * rng.choice([1, 1, 2])), f"s{i % 3}"))
    return rows


@pytest.mark.parametrize("least_docs, least_chars", [(10, 1), (2, 1), (10, 5), (1, 1), (1000, 1)])
def test_matches_brute_force(spark, least_docs, least_chars):
    rows = boiler() + awkward()
    assert run(spark, rows, least_docs=least_docs, least_chars=least_chars) == brute(rows, least_docs, least_chars)


def test_empty_keys_may_be_dropped_where_asked(spark):
    rows = boiler() + awkward()
    assert run(spark, rows, least_docs=3, least_chars=0) == brute(rows, 3, 0)


def test_only_ascii_letters_fold(spark):
    rows = [(i, "É\nK\nx", "s") for i in range(6)] + [(i + 10, "é\nK\nX", "s") for i in range(6)]  # U+212A lowers to k in full folding
    assert run(spark, rows) == brute(rows)
    assert {r[1] for r in run(spark, rows)} == {"É\nK", "é\nK"}


def test_ten_documents_are_the_limit(spark):
    rows = [(i, f"nine\nten\nown {i}\nnine", "s") for i in range(9)] + [(9, "TEN ", "s"), (10, "nine nine\n" * 50, "s")]
    got = {r[0]: r for r in run(spark, rows)}
    assert got[0] == (0, "nine\nown 0\nnine", 4, 1) and got[9] == (9, "", 1, 1)
    assert got[10][2:] == (51, 0)  # repeats in one document are one document


def test_copies_and_hot_lines(spark):
    """A third of all rows are one text, another third repeated rows; a line stands in every document and often in one."""
    rows = [(i, "top\nsame text\nend", "s") for i in range(200)] + [(7, "top\nrow again\n\nlast", None)] * 200
    rows += [(1000 + i, f"top\nmine {i}\n" + "top\n" * (3000 if i == 5 else 1), "s") for i in range(200)]
    assert run(spark, rows) == brute(rows)


def test_very_long_text(spark):
    rng = random.Random(9)
    long = "\n".join(rng.choice(["shared a", "shared b", f"own {i}"]) for i in range(60_000))
    rows = [(0, long, "s"), (1, "x" * 2_000_000, "s"), (2, " " * 1_000_000 + "\n", "s")] + [(10 + i, "Shared A\nshared b", "s") for i in range(12)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_columns(spark):
    assert run(spark, []) == []
    df = documents(spark, boiler(n=12)).withColumns({c: F.lit("z") for c in ("k1", "t1", "gone", "docs", "key", "text_", "a.b")})
    out = ld.without_common_lines(df)
    assert out.columns == ["row", "kept_text", "n_lines", "n_dropped"] and out.select("row.*").columns == df.columns
    assert out.count() == 12
