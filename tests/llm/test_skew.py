"""Joins with hot keys give the rows of plain joins."""

import pytest
from pyspark.sql import functions as F

from lodestrata.llm import _skew


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 7 == 0, F.lit("warm")).otherwise(F.concat(F.lit("k"), F.col("id") % 900))
    df = spark.range(6000).select(key.alias("key"), (F.col("id") % 50).alias("x"))
    return df.unionByName(df.filter("key = 'hot'").limit(100))


@pytest.fixture(scope="module")
def side(spark):
    names = spark.range(1200).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("y"))
    return names.unionByName(spark.createDataFrame([("hot", -1), ("hot", -2), ("warm", -3), (None, -4)], "key string, y long"))


def plain(df):
    return sorted(map(str, df.select("key", *sorted(c for c in df.columns if c != "key")).collect()))


def test_heavy(rows):
    total = rows.count()
    counts = {r["key"]: r["count"] for r in rows.groupBy("key").count().collect()}
    assert set(_skew.heavy(rows, "key")) == {k for k, n in counts.items() if k is not None and n * _skew.HOT >= total} >= {"hot", "warm"}
    assert _skew.heavy(rows.limit(0), "key") == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [None, [], ["hot"], ["nobody"]])
def test_equals_a_plain_join(rows, side, how, hot):
    assert plain(_skew.join(rows, side, "key", how, hot=hot)) == plain(rows.join(side, "key", how))


def test_hot_rows_are_dealt(spark, rows, side):
    merged = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in merged}
    try:
        for k, v in merged.items():
            spark.conf.set(k, v)
        parts = {how: how(rows, side).filter("key = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count() for how in (lambda a, b: a.join(b, "key", "left"), lambda a, b: _skew.join(a, b, "key", "left", by=("x",)))}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert list(parts.values())[0] == 1 and list(parts.values())[1] > 1
