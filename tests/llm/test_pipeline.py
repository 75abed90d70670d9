import corpus_pipeline as cp
from tests.conftest import SF
from tests.llm.data import documents
from tests.llm.test_line_quality import brute as brute_quality
from tests.llm.test_simhash_anchors import brute_components
from tests.llm.test_spaced_seeds import brute as brute_leaks

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    stages = dict(cp.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "decontamination", "mixing", "sharding"]

    one = cp.settle(stages["quality_rules"](spark, docs, SF))
    assert one.columns == COLUMNS
    kept = [(i, t, next(s for j, _, s in rows if j == i)) for i, t, k in brute_quality(rows, 20, 0.01, 0.3) if k]
    assert sorted((r["doc_id"], r["text"]) for r in one.collect()) == sorted((i, t) for i, t, _ in kept)

    two = cp.settle(stages["near_duplicates"](spark, one, SF))
    assert two.columns == COLUMNS
    stay = {c for _, _, c in brute_components([(i, t) for i, t, _ in kept])}
    assert sorted(r["doc_id"] for r in two.collect()) == sorted(stay)

    three = cp.settle(stages["decontamination"](spark, two, SF))
    assert three.columns == COLUMNS
    left = [r for r in kept if r[0] in stay]
    short = [r for r in left if len(r[1]) < 3000]  # the plain comparison is slow on long texts
    gone = {i for i, _ in brute_leaks(short, items)}
    ids = {r["doc_id"] for r in three.collect()}
    assert {i for i, _, _ in short if i in ids} == {i for i, _, _ in short} - gone

    four = cp.settle(stages["mixing"](spark, three, SF))
    assert four.columns == COLUMNS and {r["doc_id"] for r in four.collect()} <= ids
    five = stages["sharding"](spark, four, SF)
    assert five.columns == [*COLUMNS, "virtual_slot", "size", "shard", "map_version"]
    assert sorted(r["doc_id"] for r in five.collect()) == sorted(r["doc_id"] for r in four.collect())


def test_run(spark):
    out = cp.run(spark, SF)
    assert out.count() > 0 and {r["shard"] for r in out.select("shard").distinct().collect()} == set(range(16))


def test_no_documents(spark):
    docs = documents(spark, [], extra=False)
    for _, stage in cp.STAGES:
        docs = cp.settle(stage(spark, docs, SF))
    assert docs.count() == 0
