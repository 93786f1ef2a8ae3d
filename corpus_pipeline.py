"""Documents to packed training sequences: reject, deduplicate, redact, pack.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read
again as the next one's documents. All but the last keep the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotbook.llm import jaccard, packing, quality, secrets, toxicity
from lotbook.llm.common import numbered, table, text_of, unused, written
from lotbook.llm.queries import WORD_BPE

#: Words that a worker keeps while it packs: the stages before have used the same workers.
CACHE_WORDS = 200_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score stays below the bar, as they are. Null texts stay."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.toxicity(model, text_of()) < toxicity.LEAST_SCORE)


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score reaches the bar, as they are. A null text counts as empty."""
    chain = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.quality(chain, text_of()) >= quality.LEAST_SCORE)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row, whatever its id: the one of the least doc_id, null
    ids last, and of its repeats the first in the table's files. Rows that share an id and differ
    in text belong to the groups of their texts. Rows without words stay."""
    row = unused(docs, "_row")
    rows = numbered(docs, row)
    found = jaccard.jaccard_components(rows.select(F.col(row).alias("doc_id"), "text"))
    ids = rows.select(row, "doc_id")
    groups = found.withColumnRenamed("doc_id", row).join(ids.hint("merge"), row)
    least = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row)))
    kept = groups.groupBy("component_id").agg(least.alias("least")).select(f"least.{row}")
    return rows.join(kept.hint("merge"), row, "left_semi").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, found secrets replaced in its text; n_chars follows the text."""
    redacted = docs.withColumn("text", secrets.redact(F.col("text")))
    if "n_chars" not in docs.columns:
        return redacted
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.col("text").isNotNull(), F.length("text").cast(kind))
    return redacted.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row and their places in sequences; a null or empty text is one end
    id, and ids may be null or repeat."""
    return packing.pack(docs, WORD_BPE, cache_words=CACHE_WORDS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("quality", reject_bad),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

#: SQL has no model or tokenizer; ``tests/llm`` compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; an empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
