"""The corpus pipeline: documents through five training-data stages, each stage a table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import byte_bpe, decontaminate, language, simhash, suffix_dedup
from barloom.llm.base import stored, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; texts without letters or unlike every language go."""
    return language.accepted(docs, training="doc_id IS NOT NULL")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies."""
    return simhash.without_near_duplicates(docs, words=3, distance=3)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat 50 bytes of an earlier document; n_chars follows."""
    cut = suffix_dedup.without_repeats(docs)
    if "n_chars" not in cut.columns:
        return cut
    chars = F.length("text").cast(cut.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", F.coalesce(chars, F.col("n_chars")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding: digests of the ids and of the decoded bytes."""
    return byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Language models, hashes and merges have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, name)
    return docs
