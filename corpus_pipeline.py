"""The corpus pipeline: stages over documents, each written as Parquet before the next.

Each stage takes (spark, docs, sf_dir), works on all rows it gets, and its decisions take effect on the rows it
returns. All but the last return the columns of documents, whatever others stand beside them and however they are named.

Nulls, empty texts and repeats: the quality stage drops texts without words or signs, null ones included, and takes equal
rows together; near-dedup keeps rows without doc_id and one of equal rows, and each different text of a repeated doc_id by
itself; secrets and mixing treat a null text as empty and a null doc_id or source as any other, and a text without words is
taken once, or twice where its whole source is; packing gives each row that is left at least one piece. Texts of any length are taken whole. Of an empty
table every stage returns no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import _scratch, dedup, importance, mixing, packing, secrets

#: SQL can't express the classifier, the balancing or the packing.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling takes."""
    return importance.sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return dedup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), _scratch.made()
    for _, stage in STAGES[:-1]:
        docs = _scratch.settled(stage(spark, docs, sf_dir), "stage", since)
    return STAGES[-1][1](spark, docs, sf_dir)
