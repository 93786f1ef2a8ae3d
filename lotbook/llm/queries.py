"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotbook.llm import (
    ann,
    bpe,
    hard_negatives,
    jaccard,
    lattice,
    licenses,
    oracle,
    packing,
    quality,
    resampling,
    secrets,
    sharding,
    token_files,
    toxicity,
)
from lotbook.llm.common import scratch, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as flat token files in the shared folder, then counted from these alone.
    File names lose the part that differs from run to run."""
    path = scratch(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, WORD_BPE)
    name = F.regexp_replace("file", r"-[0-9a-f-]{36}-(c\d+)\.txt$", "-$1")
    return token_files.token_counts(spark, path).withColumn("file", name)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return bpe.token_digests(documents, BYTE_BPE, public_tokenizers.PATTERN)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row carries the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(
        table(spark, sf_dir, "embeddings").withColumn("label", label)
    )


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_toxicity,
        op3_token_counts,
        op4_ngram_jaccard_join,
        op5_byte_bpe,
        op6_secret_scan,
        op7_nearest_neighbours,
        op8_embedding_near_dedup,
        op9_license_scan,
        op10_quality,
        op11_hard_negatives,
        op12_resampling,
        op13_sharding,
    )
}
#: The others have no SQL: each needs a tokenizer, a model or hashing that the SQL engine lacks, or
#: is a search whose answer is found, not exact. ``tests/llm`` compares each with brute force.
ORACLE_SQL: dict[str, str] = {
    "op11_hard_negatives": oracle.HARD_NEGATIVES,
    "op12_resampling": oracle.RESAMPLING,
}
