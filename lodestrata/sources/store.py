"""The corpus store: a Parquet table for each kind, partitioned by slug, so one paper is rewritten alone.

A paper that a run covers has one marker row in each kind's partition beside its data. So a paper that now yields no
rows replaces its old ones like any other, in the same distributed write; readers of this module leave markers out.
Kinds of the whole corpus aren't partitioned and are replaced whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions import text

KINDS = ("mixtures", "measurements", "references", "figures", "tables_unhandled", "skipped_rows", "sections_llm", "papers")
CORPUS_KINDS = ("components", "component_properties", "duplicates", "review_queue", "aliases", "acceptance", "invariants", "graph_nodes", "graph_relations")
MARKER = "no_rows"


def path_for(base: str, kind: str) -> str:
    """The folder of a kind; an unknown kind is an error."""
    if kind not in KINDS + CORPUS_KINDS:
        raise ValueError(f"unknown kind {kind!r}; known: {', '.join(KINDS + CORPUS_KINDS)}")
    return f"{base.rstrip('/')}/{kind}"


def exists(spark: SparkSession, base: str, kind: str) -> bool:
    """Whether a kind was ever written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path_for(base, kind))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _checked(df: DataFrame) -> DataFrame:
    key = text.blank_to_null(F.trim(F.col("paper_key")))
    return df.withColumn("paper_key", F.when(key.isNotNull(), F.col("paper_key")).otherwise(F.raise_error(F.lit("a row without paper_key"))))


def write(df: DataFrame, base: str, kind: str, papers: DataFrame | None = None) -> None:
    """Replaces the papers (slugs) that df holds, and those of papers (slug, paper_key) that it holds nothing of; others stay.

    A row without paper_key is an error.
    """
    rows = _checked(df).withColumn(MARKER, F.lit(False))
    if papers is not None:
        rows = rows.unionByName(_checked(papers.select("slug", "paper_key").distinct()).withColumn(MARKER, F.lit(True)), allowMissingColumns=True)
    rows.write.partitionBy("slug").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path_for(base, kind))


def cutter(base: str) -> tuple[Callable[[DataFrame, str], DataFrame], Callable[[], None]]:
    """(cut, drop): cut(df, name) writes df beside the store and reads it again; drop() removes all that it wrote."""
    made: list[tuple[SparkSession, str]] = []

    def cut(df: DataFrame, name: str) -> DataFrame:
        path = f"{base.rstrip('/')}/_work/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        made.append((df.sparkSession, path))
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def drop() -> None:
        for spark, path in made:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        made.clear()

    return cut, drop


def write_corpus(df: DataFrame, base: str, kind: str) -> None:
    """Replaces a kind of the whole corpus."""
    if kind not in CORPUS_KINDS:
        raise ValueError(f"{kind!r} is no kind of the whole corpus; known: {', '.join(CORPUS_KINDS)}")
    df.write.mode("overwrite").parquet(path_for(base, kind))


def read_all(spark: SparkSession, base: str, kind: str, schema: str | None = None) -> DataFrame:
    """All papers' rows; a row without paper_key is an error."""
    reader = spark.read.schema(schema) if schema else spark.read
    found = reader.option("mergeSchema", True).parquet(path_for(base, kind))
    if kind in CORPUS_KINDS:
        return found
    rows = _checked(found)
    return rows.filter(~F.coalesce(MARKER, F.lit(False))).drop(MARKER) if MARKER in rows.columns else rows


def read_paper(spark: SparkSession, base: str, kind: str, slug: str) -> DataFrame:
    """One paper's rows: one partition is read."""
    return read_all(spark, base, kind).filter(F.col("slug") == slug)


def upsert(old: DataFrame, new: DataFrame, key: str = "paper_key") -> DataFrame:
    """New rows, and the old ones whose key isn't among them."""
    return new.unionByName(old.join(new.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def keep_source(new: DataFrame, old: DataFrame, key: list[str], human: str = "human") -> DataFrame:
    """New profiles with the source of their old version where a human made that; else 'llm'."""
    kept = old.select(*key, F.col("source").alias("__source"))
    return new.join(kept, key, "left").withColumn("source", F.coalesce("__source", F.lit("llm"))).drop("__source")


def export_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """One CSV file with a header, also for no rows; arrays are joined by '|'."""
    chosen = df.select(columns or df.columns)
    flat = [F.concat_ws("|", c).alias(c) if t.startswith("array<") else F.col(c) for c, t in chosen.dtypes]
    chosen.select(flat).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def todo(wanted: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """Rows of wanted whose key is unknown: what an outside service still has to answer."""
    return wanted.join(known.select(key).distinct(), key, "left_anti")


def cached(requests: DataFrame, responses: DataFrame, key: str = "cache_key") -> tuple[DataFrame, DataFrame]:
    """(answered, to do): requests with their raw responses, and those without one."""
    newest = responses.groupBy(key).agg(F.max("raw").alias("raw"))
    return requests.join(newest, key), requests.join(newest, key, "left_anti")


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
