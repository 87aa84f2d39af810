"""Intermediate tables in the folder that driver and executors share.

The folder is the session's ``spark.checkpoint.dir``. Where a session has none (tests on one machine), a
temporary folder is made; with a remote master that is an error, as executors would not see it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_OWN: dict[str, str] = {}
#: Each thread lists the tables that it made: runs in other threads keep theirs.
_LOCAL = threading.local()


def _made() -> list[str]:
    if not hasattr(_LOCAL, "made"):
        _LOCAL.made = []
    return _LOCAL.made


def folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        path = tempfile.mkdtemp(prefix="lodestrata-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _OWN[app] = f"file://{path}"
    return _OWN[app]


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{folder(spark)}/lodestrata/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def lean(df: DataFrame) -> DataFrame:
    """df, in a session whose batches for Python hold about ``BATCH_BYTES`` unless it has a bound: rows may be long texts.

    The setting stays, as it is read when df's plan is made, which may be later.
    """
    if df.sparkSession.conf.get(_BATCH, None) is None:
        df.sparkSession.conf.set(_BATCH, str(BATCH_BYTES))
    return df


def table(df: DataFrame, name: str, codec: str = "zstd", row_group: int | None = None) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again: its lineage ends there."""
    spark = df.sparkSession
    path = fresh(spark, name)
    writer = df.write.option("compression", codec)
    (writer.option("parquet.block.size", row_group) if row_group else writer).parquet(path)
    _made().append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str, since: int) -> DataFrame:
    """As table; then drops the tables made after ``since`` (see made), which only df's lineage used."""
    out, listed = table(df, name), _made()
    own = listed.pop()
    drop(df.sparkSession, *listed[since:])
    del listed[since:]
    listed.append(own)
    return out


def made() -> int:
    """How many tables this thread has made and not dropped."""
    return len(_made())


def clean(spark: SparkSession, since: int = 0) -> None:
    """Drops the tables that this thread made after ``since``: for callers that have read a query's result."""
    drop(spark, *_made()[since:])
    del _made()[since:]


def drop(spark: SparkSession, *paths: str) -> None:
    """Deletes tables whose readers have finished."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
