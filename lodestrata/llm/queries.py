"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import archives, dedup, importance, materialise, mixing, neighbours, oracles, packing, rules, secrets, urls


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance weight, perturbed key and whether the sample takes it."""
    return importance.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_sorted_digest_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return urls.judge(_read(spark, sf_dir, "pages"))


def op3_threshold_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the threshold table for every document."""
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rules.judge(_read(spark, sf_dir, "documents")).select(columns)


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return archives.archive(_read(spark, sf_dir, "pages")).select(columns)


def op5_entropy_balanced_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op6_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, which come in two arrivals: the second is scanned against the stored ledger of the first."""
    return secrets.document_findings(_read(spark, sf_dir, "documents"), arrivals=2)


def op7_nnls_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    return packing.pack(_read(spark, sf_dir, "documents"))


def op8_adaptive_scan_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose vec_id is divisible by 20."""
    vectors = _read(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.filter("vec_id % 20 = 0"))


def op9_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return dedup.near_duplicates(_read(spark, sf_dir, "documents"))


def op10_feistel_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence's slot in the training order, read back from the shards."""
    return materialise.order(_read(spark, sf_dir, "documents"))


QUERIES = (
    op1_importance_resampling,
    op2_sorted_digest_url_filter,
    op3_threshold_quality_rules,
    op4_arc_to_warc,
    op5_entropy_balanced_mix,
    op6_blob_ledger_secrets,
    op7_nnls_pattern_packing,
    op8_adaptive_scan_neighbours,
    op9_minmax_near_dedup,
    op10_feistel_training_order,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query for each operator."""
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return {
        "op2_sorted_digest_url_filter": oracles.url_filter(),
        "op3_threshold_quality_rules": oracles.quality_rules(),
        "op4_arc_to_warc": oracles.archives(),
    }
