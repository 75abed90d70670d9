"""Packing of documents into fixed-length rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunetable.functions import tokens as K
from tunetable.operators.pack import concat_batches, pack_bfd, pack_wrapped
from tunetable.operators.sampling import equal_chunks
from tunetable.plans.inputs import SQL_TOKENS, documents, show_ids, sql_hashed, sql_ids, stored_tokens
from tunetable.plans.registry import query
from tunetable.session import settle

LENGTH = 512


@query()
def pack_best_fit(spark, sf):
    packed = pack_bfd(stored_tokens(spark, sf), "doc_id", LENGTH)
    return packed.select(
        F.md5(show_ids(F.col("input_ids"))).alias("input_ids"), F.size("input_ids").alias("n"), show_ids(F.col("seq_lengths")).alias("seq_lengths")
    )


_SQL_LANG_TOKENS = f"lt AS (SELECT doc_id, lang, {sql_hashed('text')} AS input_ids FROM documents)"


def _lang_tokens(spark, sf):
    return settle(documents(spark, sf, "doc_id", "lang", "text").select("doc_id", "lang", K.hashed_ids(F.col("text")).alias("input_ids")))


@query(
    f"WITH {_SQL_LANG_TOKENS} SELECT lang, CAST(least(len(input_ids), {LENGTH}) AS INTEGER) AS seq_length, count(*) AS n, true AS fits FROM lt WHERE len(input_ids) > 0 GROUP BY 1, 2"
)
def best_fit_keeps_sequences(spark, sf):
    """Every sequence is in some row of its language, whole, and no row is too long."""
    packed = pack_bfd(_lang_tokens(spark, sf), "doc_id", LENGTH, keys=["lang"])
    total = F.aggregate("seq_lengths", F.lit(0), lambda a, x: a + x)
    fits = (F.size("input_ids") <= LENGTH) & (F.size("input_ids") == total)
    rows = packed.select("lang", fits.alias("fits"), F.explode("seq_lengths").alias("seq_length"))
    return rows.groupBy("lang", "seq_length").agg(F.count("*").alias("n"), F.bool_and("fits").alias("fits"))


@query(
    f"""WITH {SQL_TOKENS}, s AS (SELECT doc_id, input_ids, sum(len(input_ids)) OVER (ORDER BY doc_id) - len(input_ids) AS beg FROM toks),
    e AS (SELECT beg + generate_subscripts(input_ids, 1) - 1 AS ix, unnest(input_ids) AS id FROM s)
    SELECT CAST(ix // {LENGTH} AS BIGINT) AS chunk, CAST(count(*) AS INTEGER) AS n, md5({sql_ids('list(id ORDER BY ix)')}) AS input_ids FROM e GROUP BY 1"""
)
def pack_wrapped_global(spark, sf):
    packed = pack_wrapped(stored_tokens(spark, sf), "doc_id", LENGTH)
    return packed.select("chunk", F.size("input_ids").alias("n"), F.md5(show_ids(F.col("input_ids"))).alias("input_ids"))


@query(
    f"""WITH {_SQL_LANG_TOKENS}, s AS (SELECT doc_id, lang, input_ids, sum(len(input_ids)) OVER (PARTITION BY lang ORDER BY doc_id) - len(input_ids) AS beg FROM lt),
    e AS (SELECT lang, beg + generate_subscripts(input_ids, 1) - 1 AS ix, unnest(input_ids) AS id FROM s)
    SELECT lang, CAST(ix // {LENGTH} AS BIGINT) AS chunk, CAST(count(*) AS INTEGER) AS n, md5({sql_ids('list(id ORDER BY ix)')}) AS input_ids FROM e GROUP BY 1, 2"""
)
def pack_wrapped_by_language(spark, sf):
    packed = pack_wrapped(_lang_tokens(spark, sf), "doc_id", LENGTH, keys=["lang"])
    return packed.select("lang", "chunk", F.size("input_ids").alias("n"), F.md5(show_ids(F.col("input_ids"))).alias("input_ids"))


_SQL_BATCHES = (
    f"{SQL_TOKENS}, b AS (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 4 AS batch FROM toks), "
    "c AS (SELECT batch, list(len(input_ids) ORDER BY doc_id) AS lens, flatten(list(input_ids ORDER BY doc_id)) AS ids, "
    "flatten(list(range(len(input_ids)) ORDER BY doc_id)) AS positions FROM b GROUP BY batch)"
)


def _batches(spark, sf):
    rows = equal_chunks(documents(spark, sf, "doc_id"), ["doc_id"], 4).withColumnRenamed("chunk", "batch")
    return concat_batches(stored_tokens(spark, sf).join(rows, "doc_id"), "batch", "doc_id", ["input_ids"])


@query(f"WITH {_SQL_BATCHES} SELECT batch, {sql_ids('lens')} AS seq_lengths, md5({sql_ids('positions')}) AS position_ids FROM c")
def packed_position_ids(spark, sf):
    positions = K.position_ids(F.col("seq_lengths"))
    return _batches(spark, sf).select("batch", show_ids(F.col("seq_lengths")).alias("seq_lengths"), F.md5(show_ids(positions)).alias("position_ids"))


@query(
    f"""WITH {_SQL_BATCHES} SELECT batch, md5({sql_ids('ids')}) AS input_ids,
    md5({sql_ids('list_transform(list_zip(ids, positions), lambda x: CASE WHEN x[2] = 0 THEN -100 ELSE x[1] END)')}) AS labels FROM c"""
)
def concatenated_batches(spark, sf):
    df = _batches(spark, sf).withColumn("positions", K.position_ids(F.col("seq_lengths")))
    labels = K.mask_sequence_starts(F.col("input_ids"), F.col("positions"))
    return df.select("batch", F.md5(show_ids(F.col("input_ids"))).alias("input_ids"), F.md5(show_ids(labels)).alias("labels"))
