"""Importance resampling: held-out accuracy, exact top-k, ties."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import _bytes, importance


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r["doc_id"]: r["kept"] for r in importance.resample(docs, labels.filter("doc_id % 2 = 0")).collect()}
    held = labels.filter("doc_id % 2 = 1 and toxic = 0").collect()
    good = [got[r["doc_id"]] for r in held if r["quality"] == 1]
    bad = [got[r["doc_id"]] for r in held if r["quality"] == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.15


@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1000, 2000])
def test_kth_greatest(spark, k):
    rng = random.Random(k)
    values = [rng.choice([rng.gauss(0, 1), 1.0, -3.0, 1e300]) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    got = importance.kth_greatest(df, k, bins=8, few=5)
    want = float("inf") if k == 0 else float("-inf") if k > 1000 else sorted(values, reverse=True)[k - 1]
    assert got == want


def test_noise_is_gumbel(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'same words here' AS text")
    rows = importance.resample(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), 1000)
    mean = rows.agg(F.avg(F.col("key") - F.col("log_weight")), F.count_if("kept")).first()
    assert mean[0] == pytest.approx(0.5772, abs=0.08) and mean[1] == 1000


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(7, 1, 0), (7, 1, 0), (8, 0, 0), (8, 1, 0), (None, 1, 0), (9, None, 1)], "doc_id long, quality int, toxic int")
    rows = importance.resample(odd, labels).collect()
    assert len(rows) == 12 and all(r["log_weight"] is None and not r["kept"] for r in rows if r["doc_id"] in (1, 2, 3))
    twins = {r["key"] for r in rows if r["doc_id"] == 4}
    assert len(twins) == 1
    taken = importance.sample(odd, labels)
    assert taken.columns == odd.columns and taken.count() == sum(r["kept"] for r in rows)
    assert importance.resample(odd, labels.limit(0)).filter("kept").count() == 8
    assert importance.resample(odd.limit(0), labels).count() == 0


MASK = (1 << 64) - 1


def one_hash(token):
    """The hash of a token alone: what the vectorised code must give it in any text."""
    data = np.frombuffer(token, np.uint8)
    return int(_bytes.pieces(data, np.array([0, len(data)]), _bytes.TOKENS)[0][0])


def mixed(x):
    return int(_bytes.mix(np.array([x & MASK], np.uint64))[0])


def slow_grams(text):
    """The buckets of a text's grams, token by token."""
    tokens = re.findall(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff \t\n\x0b\x0c\r]+", (text or "").encode())
    hashes = [one_hash(t) for t in tokens]
    words = [1 if len(t) > 1 and t == t.upper() and t != t.lower() else h for t, h in zip(tokens, hashes)]
    pairs = [2 if hashes[i] == hashes[i + 1] else (words[i] * 0xD6E8FEB86659FD93 + words[i + 1]) & MASK for i in range(len(words) - 1)]
    return [(mixed(x) >> 48) % importance.BUCKETS for x in words] + [(mixed(x + 7) >> 48) % importance.BUCKETS for x in pairs]


TEXTS = ["The cat, the CAT sat.", "a a a B B", "é É x_y 9 --- !!! NATO Nato", "THE END OF IT", "", None, "one", "good words here and there, good words", "spam SPAM spam $$$ $$$", "x\x0by\x0cz"]


def test_grams_equal_a_loop():
    column = __import__("pyarrow").array(TEXTS)
    for first, data, offsets in _bytes.slices(column):
        buckets, text = importance.grams(data, offsets)
        for i in range(len(offsets) - 1):
            assert Counter(buckets[text == i].tolist()) == Counter(slow_grams(TEXTS[first + i]))


def test_weights_equal_a_loop(spark):
    """Models, ratio and log weight by counting, and the cut and sample that follow from them."""
    rng = random.Random(1)
    words = "the cat sat on a mat and NATO met Spam spam $$$ !!! é x_1 of it".split()
    texts = [" ".join(rng.choice(words[: 10 if i % 2 else 16]) for _ in range(rng.randint(0, 30))) for i in range(120)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(1, 1, 1)], "doc_id long, quality int, toxic int")
    raw, target = Counter(), Counter()
    for i, t in enumerate(texts):
        raw.update(slow_grams(t))
        if i < 60 and i % 2 and i != 1:
            target.update(slow_grams(t))
    n, m, size = sum(raw.values()), sum(target.values()), importance.BUCKETS

    def weight(t):
        own = slow_grams(t)
        each = [math.log((target[g] + 1) / (m + size)) - math.log((raw[g] + 1) / (n + size)) for g in own]
        return importance.GRAMS * sum(each) / len(each) if own else None

    rows = {r["doc_id"]: r for r in importance.resample(df, labels, 40).collect()}
    for i, t in enumerate(texts):
        want = weight(t)
        assert (rows[i]["log_weight"] is None) == (want is None) and (want is None or rows[i]["log_weight"] == pytest.approx(want, abs=1e-9))
    keys = sorted((r["key"] for r in rows.values() if r["key"] is not None), reverse=True)
    assert {i for i, r in rows.items() if r["kept"]} == {i for i, r in rows.items() if r["key"] is not None and r["key"] >= keys[39]}
