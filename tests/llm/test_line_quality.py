import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.data import awkward, documents, prose
from tunetable.llm import line_quality as lq

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_base_measures(spark):
    rng = random.Random(5)
    rows = awkward()
    rows += [(200 + i, (prose(rng, 12) + "\n") * i + prose(rng, 30 - i) + "##$", "s0") for i in range(8)]
    rows += [(300, "a b c d e f g h " * 3000, "s1"), (301, "x\n\nx\n x\nx ", "s1"), (302, "w " * 9, None)]
    got = lq.judge(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        t = r["row"]["text"]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(t), t and t[:50]


def brute(rows, line_docs, share, left):
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", x.lower())).strip(" ")
    import hashlib

    h = lambda x: int(hashlib.md5(norm(x).encode()).hexdigest()[:15], 16)
    sets, hosts = defaultdict(set), defaultdict(set)
    for _, t, s in rows:
        hs = frozenset(h(x) for x in (t or "").split("\n") if norm(x))
        for x in hs:
            sets[s, x].add(hs)
        if hs:
            hosts[s].add(hs)
    common = {k for k, m in sets.items() if len(m) > line_docs and len(m) > share * len(hosts[k[0]])}
    out = []
    for i, t, s in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not norm(x) or (s, h(x)) not in common]
        text = t if len(stay) == len(lines) else "\n".join(stay)
        n, m = len(WORD.findall(t or "")), len(WORD.findall(text or ""))
        out.append((i, text, not base(t)[-1] and m >= left * n))
    return out


@pytest.mark.parametrize("share", [0.01, 0.2])
def test_common_lines(spark, share):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        own = "\n".join(prose(rng, 9) for _ in range(rng.randrange(1, 5)))
        rows.append((i, own + ("\nAll rights reserved  by 20%d someone" % i if i % 2 else "") + ("\nsubscribe now" if i % 5 == 0 else ""), "hot" if i % 3 else None))
    copied = "\n".join(prose(rng, 10) for _ in range(6))
    rows += [(100 + i, copied, "hot") for i in range(30)]  # copies are not boilerplate
    rows += [(200, "all rights reserved by 3 someone\n" * 9, "hot"), (201, None, None), (201, None, None)]
    df = documents(spark, rows)
    got = lq.judge(df, line_docs=5, line_share=share, min_left=0.3)
    want = brute(rows, 5, share, 0.3)
    key = lambda r: (r[0], str(r[1]), r[2])
    assert sorted([(r["row"]["doc_id"], r["clean_text"], r["kept"]) for r in got.collect()], key=key) == sorted(want, key=key)
    assert all(k for i, _, k in want if 100 <= i < 130)
    assert not next(k for i, _, k in want if i == 200)
    kept = lq.clean_documents(df, line_docs=5, line_share=share, min_left=0.3)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted((i, t) for i, t, k in want if k)


def test_documents_that_share_several_common_lines(spark):
    """Counted by whole documents: a second common line with a small hash does not hide the first."""
    rng = random.Random(11)
    for n, shared, share in ((100, 5, 0.01), (60, 10, 0.5)):
        boilerplate = ["common part %s" % prose(rng, 6) for _ in range(shared)]
        rows = [(i, "\n".join([*boilerplate, prose(rng, 12), prose(rng, 12)]), "hot" if i % 2 else None) for i in range(n)]
        rows += [(1000 + i, rows[1][1].upper(), "hot") for i in range(50)]  # copies count once
        few = "\n".join(prose(rng, 12) for _ in range(3))
        rows += [(2000 + i, few, "hot") for i in range(50)]
        got = {r["row"]["doc_id"]: r for r in lq.judge(documents(spark, rows), line_share=share).collect()}
        assert all(got[i]["n_common_lines"] == shared for i, _, _ in rows if i < 2000)
        assert all(got[i]["n_common_lines"] == 0 for i, _, _ in rows if i >= 2000)
        assert got[1]["clean_text"] == "\n".join(rows[1][1].split("\n")[shared:])


def test_empty(spark):
    df = documents(spark, [])
    assert lq.judge(df).count() == 0 and lq.clean_documents(df).count() == 0
