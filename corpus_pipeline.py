"""The training-data pipeline: five operators over ``documents``, in order.

Each stage takes the rows its predecessor kept and returns the columns of
documents; the last returns each document's token ids.  ``run`` writes every
stage as Parquet into the shared folder and reads it back, so a lost executor
costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rubric.llm import bpe, mixing, near_dedup, quality, secret_scan
from rubric.llm.common import by_id, scratch_dir, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word shingles, 0.8)."""
    return near_dedup.keep_first(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets masked in the texts; ``n_chars`` follows a changed text."""
    clean = secret_scan.redact(docs.withColumn("__before", F.col("text")))
    changed = F.col("text") != F.col("__before")
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the sources' target weights takes them."""
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each document; a text that its ids do not give
    back stops the job."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_checked(by_id(docs), path, public_tokenizers.PATTERN).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("secret_scans", secret_stage),
    ("source_mix", mixing_stage),
    ("byte_bpe", bpe_stage),
]

#: SQL cannot express the near-duplicate and tokenizer stages at this size.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
