"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rubric.llm import ann, bpe, conversation_repair, licenses, mixing, near_dedup, oracle, quality, records, secret_scan, suffix_dedup, toxicity, url_filter, whitening
from rubric.llm.common import by_id, scratch_dir, table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_id(table(spark, sf_dir, "documents"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures, base verdict and cascade verdict of every document."""
    return quality.quality_report(_docs(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document and the digest of the rest."""
    return suffix_dedup.remove_repeats(_docs(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base secrets and high-entropy spans of every document."""
    return secret_scan.secret_report(_docs(spark, sf_dir))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes decoded from them."""
    import public_tokenizers

    path = _tokenizer("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_documents(_docs(spark, sf_dir), path, public_tokenizers.PATTERN)
    return bpe.decode_documents(encoded, path).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as binary records and read back."""
    folder = scratch_dir(spark, "records")
    records.write_records(_docs(spark, sf_dir), folder, _tokenizer("byte_bpe_50k.json"), special_tokens=True)
    return records.read_records(spark, folder).select(
        "doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op6_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 80 % of their 2-word shingles."""
    return near_dedup.near_duplicates(_docs(spark, sf_dir), k=2)


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence templates contained in every document."""
    return licenses.find_licenses(_docs(spark, sf_dir), licenses.full_templates(), normalize=True)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels not held out."""
    return toxicity.toxicity_report(_docs(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(rows, conversation_repair.damaged(rows))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.query_rules(pages))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every usable vector, with the fit's figures."""
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_suffix_dedup, op3_secret_scans, op4_byte_bpe, op5_token_records,
    op6_projection_forest, op7_near_duplicates, op8_license_scans, op9_toxicity, op10_source_mix, op11_conversation_repair,
    op12_url_filter, op13_embedding_whitening)}

ORACLE_SQL: dict[str, str] = dict(oracle.ORACLE_SQL)
