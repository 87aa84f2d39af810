"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of target texts (labelled good and not toxic) and one of the raw
corpus, give each text the log of their ratio. Grams are words or runs of signs, A-Z lower-cased; pairs of
neighbours; shouted words count as one gram, and so do pairs of equal neighbours. The ratio is that of 100 average
grams of the text, so length doesn't decide. A sample without replacement, with probability in proportion to
weight, is the k texts of greatest log weight plus Gumbel noise; the noise is a keyed hash of the doc_id.

The raw model counts every text. The target model and the cut use at most ``LABELLED`` rows of each label, those
of least keyed hash of their doc_id. k is a parameter; by default it is the number of all texts whose log weight
reaches the cut that best tells labelled good from bad texts. The k-th greatest key is found by counting in bins
and narrowing, so no task sorts all keys; texts that tie with it are all taken.

Counts move as one row a bucket and task (``BUCKETS`` at most), so no word, source or copy is a hot key, and the
model that reaches the driver has ``BUCKETS`` rows at any corpus size. Repeated labels of a doc_id count as their
worst. Defined results: a text without words or signs, or null, weighs nothing: its log weight is null and it isn't
kept. Rows that repeat a doc_id get the same noise, and tie if their texts are equal. A null doc_id is never
labelled and otherwise like any other. Without good labels all ratios are 1 and every text with a gram is kept.
Extra columns are left alone. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm import _bytes, _scratch

BUCKETS = 1 << 16
LABELLED = 50_000
GRAMS = 100
SMOOTHING = 1.0
SEED = 7
#: Bytes that a writer of whole rows holds before it writes them.
ROW_GROUP = 16 << 20
_SHOUT, _SAME, _PAIR = np.uint64(1), np.uint64(2), np.uint64(7)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every gram of the texts, and the text each is in."""
    hashes, text, _ = _bytes.pieces(data, offsets, _bytes.TOKENS)
    if not len(hashes):
        return np.zeros(0, np.int64), text
    shouted = _bytes.pieces(data, offsets, _bytes.TOKENS, fold=False)[0]
    lowered = np.frombuffer(data.tobytes().lower(), np.uint8)
    raised = np.frombuffer(data.tobytes().upper(), np.uint8)
    low = _bytes.pieces(lowered, offsets, _bytes.TOKENS, fold=False)[0]
    high = _bytes.pieces(raised, offsets, _bytes.TOKENS, fold=False)[0]
    words = np.where((shouted == high) & (shouted != low) & _long(data, offsets), _SHOUT, hashes)
    beside = text[1:] == text[:-1]
    pairs = np.where(hashes[1:] == hashes[:-1], _SAME, words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:])[beside]
    every = np.concatenate((_bytes.mix(words), _bytes.mix(pairs + _PAIR)))
    return (every >> np.uint64(48)).astype(np.int64) % BUCKETS, np.concatenate((text, text[1:][beside]))


def _long(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each token, whether it has more than one byte."""
    kind = _bytes.TOKENS[data]
    new = np.ones(len(data) + 1, bool)
    new[1:-1] = kind[1:] != kind[:-1]
    new[offsets[1:-1]] = True
    return ~new[np.flatnonzero(new[:-1] & (kind > 0)) + 1]


@dataclass(frozen=True)
class Model:
    """Log ratio of the target to the raw model by bucket, and the log weight that a text must reach."""

    ratio: np.ndarray
    cut: float

    def weigh(self) -> Column:
        """A function column: the log weight of a text."""
        ratio = self.ratio

        @F.arrow_udf("double")
        def weight(texts: pa.Array) -> pa.Array:
            out = np.full(len(texts), np.nan)
            for first, data, offsets in _bytes.slices(texts):
                buckets, text = grams(data, offsets)
                n = len(offsets) - 1
                counts = np.bincount(text, minlength=n)
                sums = np.bincount(text, ratio[buckets], minlength=n)
                out[first : first + n] = np.where(counts > 0, GRAMS * sums / np.maximum(counts, 1), np.nan)
            return pa.array(out)

        return weight


def labelled(labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """id and good (1 or 0) of at most bound rows of each label."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    judged = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min(F.when(F.coalesce(bad, F.lit(False)), 0).otherwise(1)).alias("good"), F.min("quality").alias("quality"))
    order = F.xxhash64("id", F.lit(SEED)), F.col("id")
    good = judged.filter("good = 1").orderBy(*order).limit(bound)
    poor = judged.filter("quality = 0").orderBy(*order).limit(bound)
    return good.unionByName(poor).select("id", "good")


def fit(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> Model:
    """The models of all docs and of the labelled ones."""
    sample = _scratch.table(labelled(labels, bound), "labelled")
    # At most 2 * bound rows.
    joined = _scratch.lean(docs).select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string")).join(F.broadcast(sample), "id", "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            good = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False) == 1
            for first, data, offsets in _bytes.slices(batch.column(0)):
                buckets, text = grams(data, offsets)
                raw += np.bincount(buckets, minlength=BUCKETS)
                target += np.bincount(buckets[good[first + text]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])
        _bytes.release()

    counted = joined.select("text", "good").mapInArrow(count, "bucket long, raw long, target long")
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["raw"], rows["target"]
    if not target.sum():
        return Model(np.zeros(BUCKETS), -np.inf)
    ratio = np.log((target + SMOOTHING) / (target.sum() + SMOOTHING * BUCKETS)) - np.log((raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS))
    weigh = Model(ratio, 0.0).weigh()
    scored = joined.filter("good is not null").select("good", weigh("text").alias("w")).filter("not isnan(w)").toPandas()
    return Model(ratio, best_cut(scored["w"][scored["good"] == 1].to_numpy(), scored["w"][scored["good"] == 0].to_numpy()))


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut with the greatest share of good at or above plus share of bad below it, in the middle of its gap."""
    if not len(good) or not len(bad):
        return -np.inf
    values = np.unique(np.concatenate((good, bad)))
    gain = 1 - np.searchsorted(np.sort(good), values) / len(good) + np.searchsorted(np.sort(bad), values) / len(bad)
    at = int(gain.argmax())
    return float(values[at] if at == 0 else (values[at] + values[at - 1]) / 2)


def kth_greatest(keys: DataFrame, k: int, bins: int = 4096, few: int = 10_000) -> float:
    """The k-th greatest of a column key without nulls; minus infinity if there are fewer."""
    left = k
    span = keys.agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("*").alias("n")).first()
    lo, hi, n = span["lo"], span["hi"], span["n"]
    if k <= 0:
        return float("inf")
    if k > n:
        return float("-inf")
    while lo < hi and n > few:
        inside = keys.filter(F.col("key").between(lo, hi))
        place = F.floor((F.col("key") - lo) / (hi - lo) * (bins - 1)).cast("int")
        found = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()
        for row in sorted(found, key=lambda r: -r["bin"]):
            if left <= row["n"]:
                lo, hi, n = row["lo"], row["hi"], row["n"]
                break
            left -= row["n"]
    if lo == hi:
        return lo
    return keys.filter(F.col("key").between(lo, hi)).orderBy(F.desc("key")).limit(left).agg(F.min("key")).first()[0]


def keyed(docs: DataFrame, model: Model, seed: int = SEED) -> DataFrame:
    """docs with log_weight and key (with Gumbel noise); both null for texts without grams."""
    weight = model.weigh()(F.col("text").cast("string"))
    uniform = (F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)), 11) + 0.5) / float(1 << 53)
    out = _scratch.lean(docs).withColumn("log_weight", weight).withColumn("log_weight", F.when(~F.isnan("log_weight"), F.col("log_weight")))
    return out.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """doc_id, log_weight, key and kept of every row of docs."""
    model = fit(docs, labels)
    scored = _scratch.table(keyed(docs.select("doc_id", "text"), model).select(F.col("doc_id").cast("long"), "log_weight", "key"), "scored")
    return scored.withColumn("kept", F.coalesce(F.col("key") >= threshold(scored, model, k), F.lit(False)))


def threshold(scored: DataFrame, model: Model, k: int | None = None) -> float:
    """The key of the last text taken."""
    if k is None:
        k = scored.filter(F.col("log_weight") >= model.cut).count()
    return kth_greatest(scored.filter("key is not null").select("key"), k)


def sample(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """The rows of docs that the sample takes, all columns unchanged."""
    model = fit(docs, labels)
    # Rows are written with their keys: to read them again costs less than to weigh them again.
    weighed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    scored = _scratch.table(keyed(weighed, model).select("row", "log_weight", "key"), "scored", "zstd", ROW_GROUP)
    return scored.filter(F.col("key") >= threshold(scored, model, k)).select("row.*")
