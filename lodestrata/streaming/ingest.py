"""A file stream over a folder of XML documents. Each micro-batch runs the batch route for its papers alone.

This adds incremental arrival to the batch stages. A batch that is run again after a failure replaces the same papers,
those included that now yield no rows, so the sink stays exact. Names in prose are resolved by what the batch and the
store's other papers use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lodestrata.functions import text
from lodestrata.plans import pipeline
from lodestrata.sources import store, xml

BINARY = "path string, modificationTime timestamp, length long, content binary"


def documents(spark: SparkSession, folder: str, pattern: str = "*.xml", per_batch: int = 1000) -> DataFrame:
    """slug, path and content of files as they arrive."""
    found = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_batch).load(folder)
    return found.select(text.slug(found["path"]).alias("slug"), "path", "content")


def start(spark: SparkSession, folder: str, base: str, checkpoint: str, inputs: Callable[[SparkSession], pipeline.Inputs]) -> StreamingQuery:
    """Writes each arriving paper's mixtures, measurements, references and figures to the store."""

    def batch(found: DataFrame, number: int) -> None:
        session = found.sparkSession
        parsed = xml.parse(found).persist()
        known = store.read_all(session, base, "mixtures") if store.exists(session, base, "mixtures") else None
        cut, drop = store.cutter(base)
        out = pipeline.run(parsed, inputs(session), known=known, cut=cut)
        slugs = out.papers.select("slug", "paper_key")
        # Claims are resolved by the stored mixtures, so these are replaced last.
        kinds = out.outputs()
        for kind in sorted(kinds, key=lambda k: k == "mixtures"):
            store.write(kinds[kind], base, kind, slugs)
        parsed.unpersist()
        drop()

    return documents(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
