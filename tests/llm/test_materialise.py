"""Training order: a bijection, an exact round trip, reading on from any slot."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lodestrata.llm import _tokens, materialise


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 65_537])
def test_permutation(n):
    slots = materialise.feistel(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    assert n < 100 or (slots != materialise.feistel(np.arange(n), n, "other")).any()


def want(df, stride=2048):
    out = Counter()
    tokenizer = _tokens.pieces(_tokens.default_path()).tokenizer
    for r in df.select("doc_id", "text").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), stride)):
            cut = ids[start : start + stride]
            out[r["doc_id"], piece, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    return out


def check(df):
    rows = materialise.order(df).collect()
    assert Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows) == want(df)
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    size = rows[0]["shard_offset"] if not rows else 16 + 4 + 2048 * 2
    assert all((r["shard"], r["shard_offset"]) == (r["slot"] // materialise.SHARD, r["slot"] % materialise.SHARD * size) for r in rows)


def test_documents(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


def test_odd_rows(odd):
    check(odd)
    assert materialise.order(odd.limit(0)).count() == 0


def test_resumes_at_a_slot(spark, tmp_path):
    shards = materialise.write(spark.range(300).selectExpr("id AS doc_id", "concat('text ', id) AS text"), stride=8)
    every = {r["slot"]: (r["doc_id"], r["ids"]) for r in materialise.read(shards, stride=8).collect()}
    tail = {r["slot"]: (r["doc_id"], r["ids"]) for r in materialise.read(shards, 200, 8).collect()}
    assert len(every) == 300 and tail == {s: v for s, v in every.items() if s >= 200}
    materialise.export(shards, str(tmp_path))
    size = 20 + 8 * materialise.WIDTH
    data = b"".join(p.read_bytes() for p in sorted(tmp_path.glob("*.bin")))
    assert len(data) == 300 * size and data[7 * size + 20 :].startswith(bytes(every[7][1]))


def test_files_and_key_decide(spark, sf, tmp_path):
    """Equal slots however the files are split and read."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs.repartition(3).sortWithinPartitions("doc_id").write.option("parquet.block.size", 20_000).parquet(str(tmp_path / "docs"))
    columns = ["doc_id", "piece", "slot", "ids_crc32"]

    def slots():
        return sorted(map(tuple, materialise.order(spark.read.parquet(str(tmp_path / "docs"))).select(columns).collect()))

    whole = slots()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        assert spark.read.parquet(str(tmp_path / "docs")).rdd.getNumPartitions() > 3
        assert slots() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_wide_ids_are_an_error():
    with pytest.raises(ValueError, match="needs more than 2 bytes"):
        materialise._records(pa.array([1], pa.int64()), np.array([70_000, 0]), np.array([0, 2]), 2048)
