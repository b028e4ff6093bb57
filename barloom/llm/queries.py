"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    byte_bpe,
    decontaminate,
    divergence,
    language,
    licenses,
    merkle,
    perspectives,
    prefix_trie,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from barloom.llm.base import crc_bucket, table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES, limit=4096)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"), least=1000).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(
        table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN
    )


def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_and_compare(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        training="crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 <> 2",
    )
    held_out = F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(
        table(spark, sf_dir, "documents"), training="crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 <> 0"
    )
    held_out = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, distance=3)


def op10_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.perspective_samples(table(spark, sf_dir, "conversations"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), least_docs=30, top=50)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontaminate": op2_decontaminate,
    "op3_warc": op3_warc,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_merkle": op5_merkle,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_simhash": op9_simhash,
    "op10_perspectives": op10_perspectives,
    "op11_license_scan": op11_license_scan,
    "op12_source_divergence": op12_source_divergence,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    "op3_warc": """
        WITH payloads AS (
            SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), owned AS (
            SELECT *, CASE WHEN payload_bytes >= 1000
                           THEN max(page_id) OVER (PARTITION BY payload_digest) END AS original
            FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original <> page_id THEN original END AS refers_to
        FROM owned
    """,
    "op10_perspectives": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS speaker,
                   coalesce(text, '') AS text
            FROM conversations
        ), people AS (
            SELECT DISTINCT conv_id AS of_conv, speaker AS perspective FROM turns WHERE speaker <> 'system'
        ), seen AS (
            SELECT conv_id, perspective, turn, speaker, text, speaker = perspective AS own,
                   '<|im_start|>' || CASE WHEN speaker = perspective THEN 'assistant'
                                          WHEN speaker = 'system' THEN 'system'
                                          ELSE 'user name='
                                               || regexp_replace(speaker, '[\t\n\f\r <>|=]', '_', 'g')
                                     END || chr(10) AS head
            FROM turns JOIN people ON conv_id IS NOT DISTINCT FROM of_conv
        ), rendered AS (
            SELECT *, head || replace(text, '<|im_', '<| im_') || '<|im_end|>' || chr(10) AS segment
            FROM seen
        ), placed AS (
            SELECT *, coalesce(sum(length(segment)) OVER (
                       PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, text
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS starts
            FROM rendered
        ), packed AS (
            SELECT *, CAST(floor(starts / 32768) AS BIGINT) AS sample FROM placed
        ), based AS (
            SELECT *, min(starts) OVER (PARTITION BY conv_id, perspective, sample) AS base FROM packed
        )
        SELECT conv_id, perspective, sample, count(*) AS n_turns,
               string_agg(segment, '' ORDER BY starts) AS text,
               coalesce(string_agg(CAST(CAST(starts + length(head) - base AS BIGINT) AS VARCHAR) || '-'
                          || CAST(CAST(starts + length(segment) - 1 - base AS BIGINT) AS VARCHAR),
                          ',' ORDER BY starts) FILTER (WHERE own), '') AS masks
        FROM based GROUP BY conv_id, perspective, sample
    """,
    "op11_license_scan": licenses.oracle_sql(),
    "op12_source_divergence": divergence.ORACLE_SQL,
    "op13_prefix_trie": prefix_trie.ORACLE_SQL,
}
