import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.data import awkward, documents, prose
from tunetable.llm import pii_crf as pc
from tunetable.llm import secret_owners as so
from tunetable.llm.queries import QUERIES

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    out = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def secret_rows():
    rng = random.Random(3)
    key = lambda n=30: "".join(rng.choice("abcdefABCDEFXYZ0123456789") for _ in range(n))
    shared, own = "Q1w" + key(), "R2x" + key()
    rows = awkward(2, 30)
    forms = ['token = "%s"', "API_KEY:%s", "passwd=%s", "secret=token: %s", "é token=%s🙂", "AKIA%s", "akia %s", "password='ab' %s", "Secret\t= %s", "apikey   =   %s", "x%s"]
    for i in range(60):
        value = rng.choice([key(), key().lower(), key().upper(), "0123456789abcdef" * 2, "short", key(5)])
        rows.append((500 + i, prose(rng, rng.randrange(9)) + " " + " ".join(rng.choice(forms) % value for _ in range(rng.randrange(4))), f"s{i % 5}"))
    rows += [(700 + i, f"see {shared} there", f"s{i}") for i in range(4)] + [(800 + i, f"mine {own}, {own}", "s1") for i in range(3)]
    rows += [(900, "token=abcdefgh " * 3000, "s2"), (901, "token" * 4000, "s2"), (902, "a" * 50000, "s2")]
    return rows, shared, own


def test_secret_spans(spark):
    rows, shared, own = secret_rows()
    got = so.scan(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    spans = defaultdict(list)
    for r in got:
        spans[r["doc_id"]].append(r["spans"])
    owners = defaultdict(set)
    for _, t, s in rows:
        for x in base_secrets(t or ""):
            owners[x[3]].add(s)
    for i, t, _ in rows:
        want = base_secrets(t or "")
        for found in spans[i]:
            patterned = [x for x in found if x["kind"] != "token"]
            assert [(x["start"], ("assign", "access", "hex").index(x["kind"]), x["end"]) for x in patterned] == [w[:3] for w in want]
            if all(w[1] != 2 for w in want):
                assert [x["live"] for x in patterned] == [len(owners[w[3]]) <= 1 for w in want]
            for x in found:
                if x["kind"] == "token":
                    assert x["live"] and not any(a < x["end"] and x["start"] < b for a, _, b, _ in want)
    assert all([x["kind"] for x in s] == ["token", "token"] for i in range(800, 803) for s in spans[i])
    assert all(s == [] for i in range(700, 704) for s in spans[i])
    assert so.scan(documents(spark, [])).count() == 0


def test_verdict_uses_owners_and_repositories(spark):
    key = lambda c: f"{c}a1B2c3D4e5F6g7H8i9J0k1L2m3"
    # Owner, repository, key: in 3 of 4 repositories, in 2 of 4, in 1 of 1, with two owners, and with owners NULL and empty.
    held = [("o", f"r{i}", key("M")) for i in range(3)] + [("o", f"r{i}", key("F")) for i in (0, 3)] + [("p", None, key("S"))] * 5
    held += [("o", "r0", key("T")), ("p", None, key("T")), (None, "r0", key("N")), ("", "r0", key("N")), (None, "r0", key("U")), (None, None, "")]
    rows = [(i, f"token={v}", o, r) for i, (o, r, v) in enumerate(held)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, source string, lang string")
    got = {(r["doc_id"], x["owners"], x["repositories"], x["live"]) for r in so.scan(df).collect() for x in r["spans"]}
    wanted = {"M": (1, 3, False), "F": (1, 2, True), "S": (1, 1, True), "T": (2, 2, False), "N": (2, 2, False), "U": (1, 1, True)}
    assert got == {(i, *wanted[v[0]]) for i, (_, _, v) in enumerate(held) if v}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_pii(text):
    digits = lambda x: "".join(c for c in x if c in "0123456789")
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]
    return out


def test_base_spans_match_plain_patterns():
    rng = random.Random(9)
    for _ in range(4000):
        text = "".join(rng.choice(["a", "b.c", "@", ".", "x_y", "1", "23", "456", "-", " ", "+", "(", ")", "4111111111111111", "é", "%"]) for _ in range(rng.randrange(30)))
        assert pc.base_spans(text) == base_pii(text), text
    for text in ("a" * 300000, "1" * 4000, "1." * 50000, "@" * 50000, "+" * 50000, "a@" * 50000, "1 " * 60000):
        assert len(pc.base_spans(text)) >= 0


def pii_rows():
    rng = random.Random(4)
    rows = awkward(3, 30)
    card = "4111 1111 1111 1111"
    for i in range(1200):
        bits = [f"u{i}.{rng.randrange(99)}@mail{i % 9}.example.com", f"{rng.randrange(256)}.{rng.randrange(256)}.1.9", "+1 (%03d) 555-%04d" % (rng.randrange(999), rng.randrange(9999)), card.replace(" ", "")]
        rows.append((1000 + i, prose(rng, 20) + " " + rng.choice(bits) + " " + prose(rng, 20) + " " + rng.choice(bits), "s"))
    rows.append((2000, prose(rng, 9) + " +1 (222) 555-0101 " + prose(rng, 9), "s"))
    return rows


def test_pii_query_columns(spark):
    rows = pii_rows()
    got = pc.find(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = defaultdict(list)
    for i, t, _ in rows:
        want[i].append(base_pii(t or ""))
    for r in got:
        assert [tuple(x) for x in r["base"]] in want[r["doc_id"]]
        for x in r["added"]:
            assert not any(a < x["end"] and x["start"] < b for _, a, b in want[r["doc_id"]][0])
    assert pc.find(documents(spark, [])).count() == 0


def test_skip_links_carry_labels():
    size = len(pc.LABELS)
    agree = np.full((size, size), 1.0) + 200 * np.eye(size)
    sure, vague = np.zeros(size), np.zeros(size)
    sure[4], vague[0], vague[4] = 500, 12, 10
    model = pc.Model({1: sure, 2: vague, 3: np.array([500.0, 0, 0, 0, 0])}, np.ones((size, size)), agree)
    shape = np.array([1, 3, 2, 3, 2])
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    alone = model.beliefs(shape, none, none)
    linked = model.beliefs(shape, none, (np.array([2, 4]), np.array([0, 2])))
    assert alone[2, 4] < 0.5 and linked[2, 4] > 0.9 and linked[4, 4] > 0.8
    assert linked[1, 0] > 0.9


def test_mentions_are_found_at_every_corpus_size(spark):
    """Bare mentions of a number whose full form stands in the document, in one mix of documents at two sizes."""
    plain = lambda rng, n: re.sub("[0-9]", "", prose(rng, n))

    def corpus(times):
        rng, rows = random.Random(6), []
        for k in range(times):
            phone = lambda: ("+1 (%03d) " % rng.randrange(200, 999), "%03d-%04d" % (rng.randrange(200, 999), rng.randrange(9999)))
            for i in range(2):
                code, number = phone()
                rows.append((k * 1000 + i, f"{plain(rng, 9)} {code}{number} {plain(rng, 9)} {number} {plain(rng, 5)}", "s"))
            for i in range(10, 30):
                full = "".join(phone())
                rows.append((k * 1000 + i, f"{plain(rng, 9)} {full} {plain(rng, 9)} {full} {plain(rng, 5)}", "s"))
            for i in range(100, 150):
                word = "v%d" % rng.randrange(10, 99)
                rows.append((k * 1000 + i, f"{plain(rng, 9)} {word} {plain(rng, 9)} {word} {plain(rng, 5)} 4-{i}", "s"))
        return rows

    for times in (1, 40):
        rows = corpus(times)
        got = {r["doc_id"]: [tuple(x) for x in r["added"]] for r in pc.find(documents(spark, rows)).collect()}
        for i, t, _ in rows:
            bare = re.search(r"(?<![)] )\b[0-9]{3}-[0-9]{4}", t) if i % 1000 < 2 else None
            assert got[i] == ([(3, bare.start(), bare.end())] if bare else []), (times, t)


def test_beliefs_are_exact_on_a_tree():
    rng = np.random.default_rng(1)
    size = len(pc.LABELS)
    model = pc.Model({k: rng.random(size) * 50 for k in range(4)}, rng.random((size, size)) * 40, rng.random((size, size)) * 40)
    shape = np.array([0, 1, 2, 3])
    got = model.beliefs(shape, (np.array([1, 2]), np.array([0, 1])), (np.array([3]), np.array([0])))
    total = np.zeros((4, size))
    for labels in np.ndindex(*[size] * 4):
        p = sum(model.shapes[k][l] for k, l in enumerate(labels)) + model.chain[labels[1], labels[0]] + model.chain[labels[2], labels[1]] + model.skip[labels[3], labels[0]]
        for k, l in enumerate(labels):
            total[k, l] += np.exp(p)
    want = total / total.sum(axis=1, keepdims=True)
    assert np.abs(got - want).max() < 2e-2


def test_held_out_labels(spark):
    """Fitted on one half of the documents, the field finds the base spans of the other from shapes alone."""
    rows = pii_rows()
    found = pc._scan(documents(spark, rows).select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text")))
    model = pc.fit(found.filter("key % 2 = 0"))
    right = wrong = 0
    for batch in found.filter("key % 2 = 1").toArrow().to_batches():
        row, shape, label, chain, skip = pc._graph(batch)
        if len(row):
            best = model.beliefs(shape, chain, skip).argmax(axis=1)
            right += int((best == label)[label > 0].sum())
            wrong += int((best != label)[label > 0].sum())
    assert right > 100 and right / (right + wrong) > 0.95


def test_pii_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op8_pii_crf"](spark, SF).collect()
    assert len(got) == len(texts)
    some = 0
    for r in got:
        want = base_pii(texts[r["doc_id"]])
        said = ",".join(f"{pc.KINDS[k]}:{a}:{b}" for k, a, b in want)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == n for k, _, _ in want) for n in range(4)]
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) - {""} <= set(r["spans"].split(","))
        some += bool(want)
    assert some


def test_counts_differ_by_kind(spark, tmp_path):
    documents(spark, [(1, "1.2.3.4 and 5.6.7.8 and a@b.c", "s")]).write.parquet(str(tmp_path / "documents.parquet"))
    r = QUERIES["op8_pii_crf"](spark, str(tmp_path)).first()
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 2, 0, 0)


def test_text_of_many_spans_and_a_value_of_most_rows(spark):
    rng = random.Random(8)
    token = lambda: "aB3" + "".join(rng.choice("cdEF45_") for _ in range(27))
    parts = [rng.choice([token(), "token=" + token(), "0123456789abcdef" * 2, "x"]) for _ in range(20000)]
    rows = [(i, "token = Zq1AAAAAAAAAAAAAAAAAAAAAAAAA9", f"s{i % 3}") for i in range(600)] + [(1000, " ".join(parts), "s9"), (1001, None, None)]
    got = {r["doc_id"]: r["spans"] for r in so.scan(documents(spark, rows)).collect()}
    assert len(got) == len(rows) and got[1001] == []
    assert all([(x["kind"], x["owners"], x["live"]) for x in got[i]] == [("assign", 3, False)] for i in range(600))
    want = [w[:3] for w in base_secrets(rows[600][1])]
    assert [(x["start"], ("assign", "access", "hex").index(x["kind"]), x["end"]) for x in got[1000] if x["kind"] != "token"] == want
    alone = sum(p.startswith("aB3") for p in parts)
    assert sum(x["kind"] == "token" for x in got[1000]) == alone


def test_long_words_cost_their_length():
    import time

    start = time.perf_counter()
    for text in ("字" * 1_000_000 + " 5", "x" * 1_000_000 + "@ 7 " + "y" * 500_000, ("é" * 300_000 + "\n") * 3 + "4"):
        assert len(pc._tokens(text, [])["start"]) >= 1
    assert time.perf_counter() - start < 3
