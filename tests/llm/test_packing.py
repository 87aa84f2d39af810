"""Token ids against the tokenizer, packing against its bounds."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lodestrata.llm import _tokens, packing

PATH = _tokens.default_path()
PARTS = ["a", "B", "é", "É", "'s", "'", "don't", ".", ",", "...", "…", "1", "23", "ß", "İ", "Σ", "́", " ", "\n", "\t", " ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "word", "Hello", "漢字", "😀", "-", "_", "\x0b", "\x1c", "\x85", "×", "!", "?", ". ", ", "]


def reference(text):
    return _tokens.pieces(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_equal_the_tokenizer():
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + [None, "", "x" * 100_000, "Word. " * 30_000]
    got = [ids for _, some in _tokens.column_ids(pa.array(texts), PATH) for ids in some]
    assert all(reference(t) == g.tolist() for t, g in zip(texts, got, strict=True))


def test_ids_with_a_small_cache():
    small = _tokens.PieceIds(PATH, 40)
    rng = random.Random(4)
    for _ in range(50):
        texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(12)) for _ in range(3)]
        assert [g.tolist() + [0] for g in small.texts([t.encode() for t in texts])] == [reference(t) for t in texts]


def test_nnls():
    rng = np.random.default_rng(0)
    a, x = rng.random((20, 8)), np.array([0, 1, 0, 2, 0, 3, 0, 0.5])
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)
    got = packing.nnls(a, -np.ones(20))
    assert (got >= 0).all() and np.allclose(got, 0)


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(2048, np.maximum(1, rng.lognormal(5.5, 1.2, 3000).astype(int)))
    counts = Counter(lengths.tolist())
    made = packing.plan(dict(counts))
    held = Counter()
    for row, n in made:
        assert sum(row) <= 2048 and n > 0
        for length in row:
            held[length] += n
    sequences, bound = sum(n for _, n in made), -(-int(lengths.sum()) // 2048)
    assert held == counts and bound <= sequences <= bound + 2


def check(df):
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = reference(r["text"])
        for piece, start in enumerate(range(0, len(ids), 2048)):
            cut = ids[start : start + 2048]
            want[r["doc_id"], piece, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    rows = packing.pack(df).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places: dict = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for row in places.values():
        at = 0
        for offset, length in sorted(row):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    return len(places), -(-total // 2048)


def test_documents(spark, sf):
    used, bound = check(spark.read.parquet(f"{sf}/documents.parquet"))
    assert used <= bound + 1


def test_odd_rows(odd):
    check(odd)
    assert packing.pack(odd.limit(0)).count() == 0


def test_one_length_of_all(spark):
    check(spark.range(2500).selectExpr("id % 50 AS doc_id", "'the same text' AS text"))
