"""Joins whose keys may be hot: one key may hold a third of all rows.

Keys that hold ``1 / HOT`` or more of the rows are at most ``HOT``, whatever the rows, so these few keys are known to
every task (a broadcast of proven size). Their rows are dealt over ``SALTS`` tasks, and the other side's rows of these
keys are sent to each of them; rows without a key, which match nothing, are dealt likewise. All other rows meet by
their key alone. No row is dropped, and no key that is left alone holds more than ``1 / HOT`` of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = 200
SALTS = 64


def heavy(rows: DataFrame, key: str) -> list:
    """The keys (at most ``HOT``) that hold 1 / HOT or more of the rows (a written table: it is read twice)."""
    total = rows.count()
    counts = rows.groupBy(key).agg(F.count("*").alias("__n")).filter((F.col("__n") * HOT >= total) & F.col(key).isNotNull())
    return [r[0] for r in counts.select(key).limit(HOT).collect()]


def join(rows: DataFrame, side: DataFrame, key: str, how: str = "inner", hot: list | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """rows joined with side on key; hot: the heavy keys of rows, if they are known; by: the columns that deal their rows, else all."""
    hot = heavy(rows, key) if hot is None else hot
    salt = F.pmod(F.xxhash64(*(by or [c for c in rows.columns if c != key]), F.spark_partition_id()), F.lit(SALTS)).cast("int")
    if not hot:
        if how != "left":
            return rows.join(side, key, how)
        left = rows.withColumn("__salt", F.when(F.col(key).isNull(), salt).otherwise(F.lit(0)))
        return left.join(side.withColumn("__salt", F.lit(0)), [key, "__salt"], how).drop("__salt")
    known = F.broadcast(rows.sparkSession.createDataFrame([(k, True) for k in hot], rows.select(key, F.lit(True).alias("__hot")).schema))
    left = rows.join(known, key, "left").withColumn("__salt", F.when(F.col("__hot") | F.col(key).isNull(), salt).otherwise(F.lit(0))).drop("__hot")
    salts = F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    right = side.join(known, key, "left").withColumn("__salt", salts).drop("__hot")
    return left.join(right, [key, "__salt"], how).drop("__salt")
