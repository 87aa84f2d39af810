"""Fixture queries against DuckDB on the smallest tables, and the entry module."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from lodestrata.plans import fixtures

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the synthetic tables aren't here")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)

    def one(v):
        if isinstance(v, float):
            return None if v != v else round(v, 6)
        return v if v is None or isinstance(v, (int, str, bool)) else str(v)

    return sorted(([one(r[i]) for i in order] for r in rows), key=str)


@pytest.mark.parametrize("name", fixtures.ORACLES)
def test_query_equals_its_sql(spark, duck, name):
    got = fixtures.QUERIES[name](spark, SF)
    want = duck.execute(fixtures.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert plain([tuple(r) for r in got.collect()], got.columns) == plain(want.fetchall(), names)


def test_unresolved_counter_keeps_tokens_of_any_length(spark, tmp_path):
    texts = ["a, choline chloride-urea mixture ,a", " ,, " + "x" * 5000 + ",1,2-dimethylimidazolium", None, "", "choline chloride-urea mixture"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter(x.strip(" ") for t in texts if t for x in t.split(",") if x.strip(" "))
    got = fixtures.QUERIES["q18_unresolved_counter"](spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {r["token"]: r["n"] for r in got} == want


def test_sample_is_stable(spark):
    first = {r["doc_id"] for r in fixtures.QUERIES["q35_seeded_sample"](spark, SF).collect()}
    again = {r["doc_id"] for r in fixtures.QUERIES["q35_seeded_sample"](spark, SF).collect()}
    assert len(first) == 50 and first == again


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
