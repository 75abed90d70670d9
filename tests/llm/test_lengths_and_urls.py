import random
import re
from collections import Counter

import pytest

from tests.llm.data import awkward, documents
from tunetable.llm import token_lengths as tl
from tunetable.llm import url_globs as ug
from tunetable.llm.queries import URL_RULES


def test_suffix_sums(spark):
    rows = awkward() + [(900, "<|endoftext|> " * 3000, "s")]
    encode = tl.encoder(tl.TOKENIZER).encode_ordinary
    lengths = [len(encode(t or "")) for _, t, _ in rows]
    sums = tl.suffix_sums(tl.length_histogram(documents(spark, rows))).cache()
    got = {r["context_limit"]: r for r in sums.collect()}
    assert {k: r["docs"] for k, r in got.items()} == Counter(lengths)
    for k, r in got.items():
        assert r["docs_from"] == sum(x >= k for x in lengths) and r["tokens_from"] == sum(x for x in lengths if x >= k)
        assert r["docs_longer"] == sum(x > k for x in lengths) and r["tokens_within"] == sum(x for x in lengths if x <= k)
        assert r["truncated_tokens"] == sum(min(x, k) for x in lengths) == sum(lengths) - r["lost_tokens"]
        assert r["share_within"] == sum(x <= k for x in lengths) / len(lengths)
    for limit in (0, 1, 17, 500, 10**6):
        r = tl.totals_at(sums, limit).first()
        assert (r["docs_longer"], r["truncated_tokens"]) == (sum(x > limit for x in lengths), sum(min(x, limit) for x in lengths))
    for q in (0.0, 0.25, 0.5, 0.99, 1.0):
        want = min(x for x in lengths if sum(y <= x for y in lengths) >= q * len(lengths))
        assert tl.quantile(sums, q).first()["length"] == want


def test_no_documents(spark):
    sums = tl.suffix_sums(tl.length_histogram(documents(spark, [])))
    assert sums.count() == 0 and tl.totals_at(sums, 5).first()["docs_longer"] == 0


def as_regex(glob):
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(glob[i])
        elif glob.startswith("**", i):
            i += 1
            out += ".*"
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c))
        i += 1
    return re.compile(out, re.S)


def test_automaton_matches_regex():
    rng = random.Random(1)
    text = lambda n, chars: "".join(rng.choice(chars) for _ in range(n))
    for _ in range(30):
        globs = [text(rng.randrange(0, 9), "ab/é*?\\") for _ in range(rng.randrange(1, 40))]
        globs = [g for g in globs if not re.search(r"(?<!\\)(\\\\)*\\$", g)] or ["a"]
        urls = [text(rng.randrange(0, 12), "ab/é*?\\") for _ in range(60)] + ["a" * 5000, ""]
        hits = ug.Automaton(globs).matched([u.encode() for u in urls])
        for u, row in zip(urls, hits, strict=True):
            assert [bool(x) for x in row] == [bool(as_regex(g).fullmatch(u)) for g in globs], (u, globs)


def brute(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")):
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    if best:
        return host, path, *best
    bad = any(as_regex(g).fullmatch(host + path) for g in URL_RULES[-1].globs)
    return host, path, None, "block" if bad else "allow"


def test_url_rules(spark):
    rng = random.Random(2)
    hosts = ["net", "a.net", "EXAMPLE.net", "x.example.net", "badexample.com", "www.example.com", "m.adult-x.site", "casino.io", "org", "b.ORG", "ÄÖ.org", ""]
    paths = ["", "/", "/en/1", "/EN/1", "/de/", "/de", "/fr/x?y=/en/", "/x.net/y", "/a//b#c/de/", "?/en/", "/wp-login.php", "/漢字/é.exe"]
    urls = [f"{s}{h}{p}" for h in hosts for p in paths for s in ("http://", "HTTPS://", "")] + [None, "", "://", "a://b://c.net/", "http://x.net/" + "y" * 30000, "http://a.com/\n/en/"]
    rows = [(rng.randrange(10**6), u) for u in urls] + [(None, urls[0]), (1, urls[1]), (1, urls[1])]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, rule string, host string")
    got = sorted((tuple(r) for r in ug.filter_urls(df, URL_RULES).collect()), key=str)
    assert got == sorted(((i, *brute(u)) for i, u in rows), key=str)
    assert ug.filter_urls(df.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in ug.filter_urls(df, []).collect()} == {"allow"}


@pytest.mark.parametrize("n", [1, 3, 64, 200])
def test_rules_may_take_several_words(n):
    globs = [f"host{i}.example/**" for i in range(n)]
    hits = ug.Automaton(globs).matched([f"host{i}.example/p".encode() for i in range(n)])
    assert (hits == (hits.shape[0] == n) * __import__("numpy").eye(n, dtype=bool)).all()
