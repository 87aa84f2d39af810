"""Joins on nearly equal values, and order-preserving aggregation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions import numbers

_TINY = 1e-6


def close_join(left: DataFrame, right: DataFrame, a: str, b: str, on: list[str] | None = None, relative: float = 1e-3) -> DataFrame:
    """Rows of left and right with a and b equal within a relative tolerance (1e-9 absolute), and equal ``on`` columns.

    An equi-join on logarithmic buckets: a left value has one bucket, a right value its own and the two beside it,
    so each pair meets once and no pair of distant values is built. Columns must differ in name but for ``on``.
    """
    width = 2.5 * relative

    def bucket(v: Column) -> Column:
        return F.floor(F.log(F.abs(v)) / width) * 2 + F.when(v < 0, 1).otherwise(0)

    zero = F.lit(-(1 << 60))
    mine = left.withColumn("__b", F.when(F.abs(F.col(a)) <= _TINY, zero).otherwise(bucket(F.col(a))))
    v = F.col(b)
    beside = F.array(*[bucket(v) + 2 * k for k in (-1, 0, 1)])
    small, large = F.abs(v) <= _TINY * (1 + 2 * relative), F.abs(v) > _TINY * (1 - 2 * relative)
    none = F.array().cast("array<bigint>")
    other = right.withColumn("__b", F.explode(F.concat(F.when(small, F.array(zero)).otherwise(none), F.when(large, beside).otherwise(none))))
    joined = mine.join(other, [*(on or []), "__b"])
    return joined.filter(numbers.close(F.col(a), F.col(b), relative)).drop("__b")


assert 2.5e-3 > -math.log1p(-1e-3), "neighbouring buckets must hold all close values"


def first_by(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The first row of each key in an order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def aligned(df: DataFrame, key: list[str], position: list[str], columns: list[str], separator: str = "|") -> DataFrame:
    """Lists of each key's columns, joined in order of position; the separator inside a value becomes '/'."""
    rows = F.array_sort(F.collect_list(F.struct(*position, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"__{c}") for c in columns])))
    collected = df.groupBy(*key).agg(rows.alias("__rows"))
    lists = [F.array_join(F.transform("__rows", lambda r: F.replace(r[f"__{c}"], F.lit(separator), F.lit("/"))), separator).alias(c) for c in columns]
    return collected.select(*key, *lists)


def spelling(df: DataFrame, key: str, name: str, position: list[str]) -> DataFrame:
    """The most frequent name of each key; of equally frequent ones the first met."""
    counted = df.groupBy(key, name).agg(F.count("*").alias("__uses"), F.min(F.struct(*position)).alias("__first"))
    return first_by(counted, [key], F.desc("__uses"), F.asc("__first")).select(key, name)


def top(df: DataFrame, key: list[str], k: int, *order: Column) -> DataFrame:
    """The first k rows of each key, with their rank."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def ladder(*steps: tuple[Column, str], otherwise: str) -> Column:
    """The name of the first step whose condition holds."""
    out = F.lit(otherwise)
    for condition, name in reversed(steps):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows by the least keyed SHA-256: the same on every run and split, and for anyone who knows key and seed."""
    return df.orderBy(F.sha2(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))), 256), key).limit(n)
