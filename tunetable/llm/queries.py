"""The registered queries of this package, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetable.llm import (
    chat_parts,
    fair_mix,
    hard_negatives,
    line_dedup,
    line_quality,
    pii_crf,
    secret_owners,
    simhash_anchors,
    spaced_seeds,
    token_lengths,
    url_globs,
    virtual_slots,
    whitening,
)
from tunetable.llm.text import whole, word_count
from tunetable.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SHARDS = 16


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return judged.select(F.col("row.doc_id").alias("doc_id"), *judged.columns[2:])


@query
def op3_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_anchors.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash_anchors.hex_print(F.col("fingerprint")).alias("fingerprint"), F.col("component").alias("component_id")
    )


@query
def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spaced_seeds.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"key": "doc_id", "item": "item_id"})


@query
def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id",
        virtual_slots.byte_size(F.col("text")).alias("size"),
        F.crc32(whole(F.col("text")).cast("binary")).alias("text_crc32"),
        virtual_slots.slot_of(F.col("doc_id"), F.col("text")).alias("virtual_slot"),
    )
    placed = virtual_slots.numbered(rows, SHARDS, order=["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"
    )


@query
def op10_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored, so that the texts are read once.
    docs = settle(table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")))
    mix = fair_mix.served(docs.withColumn("row", F.lit(True)))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "finish").orderBy("finish", "doc_id")


@query
def op1_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths.suffix_sums(token_lengths.length_histogram(table(spark, sf_dir, "documents")))


# The rules of the contract, then globs of the method's own for hosts that no rule names.
URL_RULES = (
    url_globs.host_rule("net", "/", "block"),
    url_globs.host_rule("example.net", "/en/", "allow"),
    url_globs.host_rule("example.com", "/de/", "block"),
    url_globs.host_rule("org", "/fr/", "allow"),
    url_globs.Rule(None, "block", ("*cheap-pills*/**", "*free-bets*/**", "*adult-*/**", "*casino*/**", "**/wp-login*", "**/*.exe")),
)


@query
def op4_url_globs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_globs.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op6_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text")
    )
    parts = turns.unionByName(extra).withColumn("parts", chat_parts.text_part(whole(F.col("text"))))
    out = chat_parts.format_conversations(parts).withColumn("read", chat_parts.read_back(F.col("formatted")))
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = out.withColumn("loss", chat_parts.masked_text(F.col("formatted"), F.col("spans")))
    return loss.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
    )


@query
def op7_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_owners.scan(table(spark, sf_dir, "documents"))
    base = secret_owners.of_kind(F.col("spans"), "assign", "access", "hex")
    n = lambda c: F.size(c).cast("long")
    return found.select(
        "doc_id",
        *[n(secret_owners.of_kind(F.col("spans"), k)).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_owners.listed(base), 256).alias("base_sha256"),
        secret_owners.listed(F.col("spans")).alias("spans"),
        n(F.filter("spans", lambda x: x["live"])).alias("n_live"),
        n(F.filter("spans", lambda x: ~x["live"])).alias("n_copied"),
    )


@query
def op8_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_crf.find(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in pii_crf.KINDS])
    say = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    kinds = [count(k).alias(f"n_{name}") for k, name in enumerate(pii_crf.KINDS)]
    return found.select(
        "doc_id", *kinds, F.sha2(say(F.col("base")), 256).alias("base_sha256"), say(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added")
    )


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.without_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.by_component(whitening.whitened(table(spark, sf_dir, "embeddings")))
    return white.withColumnRenamed("key", "vec_id").withColumn("deviation", F.col("deviation").cast("long"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Some labels are moved on, so that the nearest rows are not all of the anchor's label.
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


# --- SQL twins ---------------------------------------------------------------

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_GAP = r"[\x20\x09-\x0D]"

SQL["op2_line_quality"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source FROM documents),
w AS (SELECT r, {_WORDS} AS w FROM d),
k AS (SELECT r, i, array_to_string(list_slice(w, i, i + 7), ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
p AS (SELECT DISTINCT r, i + j AS at FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM k), (SELECT unnest(range(8)) AS j) WHERE n > 1),
rep AS (SELECT r, count(*) AS n FROM p GROUP BY r),
li AS (SELECT r, source, i, line, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '{_GAP}+', ' ', 'g')) AS norm
       FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)),
lh AS (SELECT *, CASE WHEN norm <> '' THEN CAST('0x' || substr(md5(norm), 1, 15) AS BIGINT) END AS h FROM li),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lh WHERE h IS NOT NULL GROUP BY r),
hs AS (SELECT r, source, list_sort(list_distinct(list(h))) AS hs FROM lh WHERE h IS NOT NULL GROUP BY r, source),
different AS (SELECT DISTINCT source, hs FROM hs),
held AS (SELECT source, unnest(hs) AS h FROM different),
cnt AS (SELECT source, h, count(*) AS docs FROM held GROUP BY source, h),
host AS (SELECT source, count(*) AS n FROM different GROUP BY source),
hot AS (SELECT cnt.source, h FROM cnt JOIN host ON cnt.source IS NOT DISTINCT FROM host.source WHERE docs > {line_quality.LINE_DOCS} AND docs > {line_quality.LINE_SHARE} * host.n),
st AS (SELECT r, count(*) FILTER (WHERE hot.h IS NOT NULL) AS gone, sum(CASE WHEN hot.h IS NULL THEN len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) ELSE 0 END) AS words_left
       FROM lh LEFT JOIN hot ON lh.source IS NOT DISTINCT FROM hot.source AND lh.h = hot.h GROUP BY r),
b AS (SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{_GAP}+', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, st.gone AS n_common_lines, CAST(st.words_left AS BIGINT) AS words_left
      FROM d JOIN w ON d.r = w.r JOIN st ON d.r = st.r LEFT JOIN dup ON d.r = dup.r LEFT JOIN rep ON d.r = rep.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND words_left >= {line_quality.MIN_LEFT} * n_words AS kept, n_common_lines, words_left FROM b
"""

SQL["op4_url_globs"] = r"""
WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN path <> '' AND regexp_matches(host, 'cheap-pills|free-bets|adult-|casino') THEN 'block'
  WHEN regexp_matches(path, '(?s)/wp-login[^/]*$|/[^/]*[.]exe$') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

_CONTROL = "'</s>[INST] ok [/INST]'"
SQL["op6_chat_parts"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_CONTROL} UNION ALL SELECT -1, 1, 'assistant', {_CONTROL}),
e AS (SELECT *, length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')) + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')) AS n FROM t),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, sum(n + {len(chat_parts.TURN + chat_parts.BODY + chat_parts.END)}) AS chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars, 0::BIGINT AS n_attachments FROM g
"""

SQL["op10_fair_mix"] = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s),
l AS (SELECT *, cap / weight < (budget - coalesce(sum(cap) OVER e, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0)) AS is_out FROM w
  WINDOW e AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (budget - coalesce(sum(cap) FILTER (WHERE is_out) OVER (), 0)) / sum(weight) FILTER (WHERE NOT is_out) OVER () AS cut FROM l),
t AS (SELECT *, CASE WHEN is_out OR cut IS NULL THEN cap ELSE least(weight * cut, cap) END AS target FROM c),
x AS (SELECT d.*, CAST(t.source_size AS BIGINT) AS source_size, target,
  CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(greatest(0, least(size, CAST(round(target) AS BIGINT) - before)) + greatest(0, least(size, CAST(round(target) AS BIGINT) - before - source_size)) AS BIGINT) AS taken,
source, CASE WHEN target > 0 THEN (before + size) / target END AS finish FROM x
"""


def _sql_hits(at: int) -> str:
    _, pattern, group, least = secret_owners.KINDS[at]
    quoted = "'" + pattern.replace("'", "''") + "'"
    mixed = " AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')" if at == 3 else ""
    return f"""SELECT *, length(value) >= {least}{mixed} AS good FROM (SELECT r, owner, repo, {at} AS k, generate_subscripts(hit, 1) AS i, unnest(hit) AS hit, unnest(value) AS value, unnest(list_slice(gap, 1, len(hit))) AS gap
    FROM (SELECT r, owner, repo, regexp_extract_all(text, {quoted}, 0) AS hit, regexp_extract_all(text, {quoted}, {group}) AS value, regexp_split_to_array(text, {quoted}) AS gap FROM d))"""


SQL["op7_secret_owners"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS owner, coalesce('=' || lang, '') AS repo FROM documents),
held AS (SELECT owner, count(DISTINCT repo) AS held FROM d GROUP BY owner),
h AS ({" UNION ALL ".join(_sql_hits(k) for k in range(4))}),
p AS (SELECT *, CAST(fin - length(hit) AS BIGINT) AS beg FROM (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY r, k ORDER BY i) AS fin FROM h) WHERE good),
v AS (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repo)) AS repos, min(owner) AS owner FROM p GROUP BY value),
o AS (SELECT value, owners <= {secret_owners.LIVE_OWNERS} AND (repos <= 1 OR repos <= held * {secret_owners.LIVE_SHARE}) AS live FROM v JOIN held USING (owner)),
j AS (SELECT r, k, beg, fin, live, ['assign', 'access', 'hex', 'token'][k + 1] || ':' || beg || ':' || fin AS said FROM p JOIN o USING (value)),
f AS (SELECT * FROM j WHERE k < 3 OR (live AND NOT EXISTS (SELECT 1 FROM j b WHERE b.r = j.r AND b.k < 3 AND b.beg < j.fin AND j.beg < b.fin))),
g AS (SELECT r, count(*) FILTER (WHERE k = 0) AS a, count(*) FILTER (WHERE k = 1) AS b, count(*) FILTER (WHERE k = 2) AS c, count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_copied,
  string_agg(said, ',' ORDER BY beg, k) FILTER (WHERE k < 3) AS base, string_agg(said, ',' ORDER BY beg, k) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied FROM d LEFT JOIN g ON d.r = g.r
"""

_STRIPPED = "trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
SQL["op11_line_dedup"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate({_STRIPPED}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= {line_dedup.LEAST_CHARS} GROUP BY key HAVING count(DISTINCT r) >= {line_dedup.LEAST_DOCS}),
m AS (SELECT k.*, c.key IS NOT NULL AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY r, doc_id
"""

SQL["op13_hard_negatives"] = f"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hard_negatives.POSITIVES})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND {hard_negatives.LOW} * p.score <= 100 * s.score AND 100 * s.score <= {hard_negatives.HIGH} * p.score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY rank <= {hard_negatives.NEGATIVES}
"""
