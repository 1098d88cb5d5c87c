"""The operators' queries over the supplied tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, merkle, mixing, order_minhash, pii, quality_gam, quality_rules, sentencepiece_codec, sharding, simhash, token_store, topk_search, toxicity
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> bytes:
    """Content of a public tokenizer's file, read on the driver."""
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@_register
def op1_sharding(spark, sf_dir):
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=16)


@_register
def op9_simhash(spark, sf_dir):
    return simhash.components(read_table(spark, sf_dir, "documents"), words=4, distance=4)


@_register
def op7_mixing(spark, sf_dir):
    return mixing.mix_documents(read_table(spark, sf_dir, "documents"))


@_register
def op4_quality_rules(spark, sf_dir):
    labels = read_table(spark, sf_dir, "labels")
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"), labels.filter("quality = 1").select("doc_id"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "score")


@_register
def op3_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.digests(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@_register
def op2_pii(spark, sf_dir):
    return pii.digests(read_table(spark, sf_dir, "documents"))


@_register
def op8_toxicity(spark, sf_dir):
    return toxicity.judge_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_register
def op6_quality(spark, sf_dir):
    return quality_gam.judge_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_register
def op5_topk_search(spark, sf_dir):
    return topk_search.top_k(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5)


@_register
def op10_token_store(spark, sf_dir):
    return token_store.round_trip(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@_register
def op11_merkle(spark, sf_dir):
    return merkle.verified_documents(read_table(spark, sf_dir, "documents"))


@_register
def op12_alignment(spark, sf_dir):
    return alignment.align_documents(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                     vocabulary("piece_bpe_32k.model"))


@_register
def op13_order_minhash(spark, sf_dir):
    return order_minhash.fingerprint_documents(read_table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_merkle"] = merkle.ORACLE_SQL

ORACLE_SQL["op5_topk_search"] = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda x: x[1] * x[2])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id
        WHERE q.vec_id % 50 = 0
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM s QUALIFY rank <= 5
"""

ORACLE_SQL["op7_mixing"] = r"""
    WITH d AS (
        SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
               length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS visible,
               length(regexp_replace(text, '[\p{L}\x20\x09-\x0D]+', '', 'g')) AS others,
               CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT) AS bits
        FROM documents
    ), k AS (
        SELECT doc_id, source, size,
               -ln((CAST(bits AS DOUBLE) + 0.5::DOUBLE) / 281474976710656::DOUBLE)
               / coalesce(0.25::DOUBLE + 0.75::DOUBLE * (visible - others) / nullif(visible, 0), 0.25::DOUBLE) AS key
        FROM d
    ), s AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
               (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
        FROM k GROUP BY source
    ), l AS (
        SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM s
    ), t AS (
        SELECT source, source_size, coalesce(least(weight * (
                   SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1),
                   CAST(cap AS DOUBLE)), CAST(cap AS DOUBLE)) AS target
        FROM l
    ), p AS (
        SELECT k.*, t.source_size, t.target,
               CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
               sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
        FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
    ), f AS (
        SELECT *, upto <= target - epochs * source_size AS fits,
               size * (epochs + CASE WHEN upto <= target - epochs * source_size THEN 1 ELSE 0 END) AS whole
        FROM p
    ), m AS (
        SELECT *, target - sum(whole) OVER (PARTITION BY source) AS missing FROM f
    ), n AS (
        SELECT *, NOT fits AND size > 0 AND abs(size - missing) < missing AS near FROM m
    )
    SELECT doc_id, size, source_size, target,
           CAST(whole + CASE WHEN near AND row_number() OVER (PARTITION BY source, near
                ORDER BY abs(size - missing), key, doc_id, size) = 1 THEN size ELSE 0 END AS BIGINT) AS taken
    FROM n
"""
