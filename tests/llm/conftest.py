import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("the synthetic tables aren't here")
    return SF


@pytest.fixture
def odd(spark):
    """Documents with nulls, empty, very long and repeated texts, ties, and columns with clashing names."""
    long = "alpha beta gamma delta " * 20_000
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one two three", "a"), (4, "one two three", "a"), (None, "null id text", None), (None, None, "b"),
        (5, long, "b"), (6, long, "b"), (7, "ONE two\nthree", "c"), (8, "word " * 60, "c"), (9, "é😀 ñ́ x" * 30, "c"),
    ]
    columns = "doc_id long, text string, source string"
    df = spark.createDataFrame(rows, columns)
    for name in ("key", "size", "label", "rank", "kept", "length", "slot", "blob", "path", "spans", "id", "piece"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df
