"""Approximate nearest neighbours by an adaptive dimension scan within probed lists.

Largest inner product becomes least distance by one more dimension, which gives every vector the same length.
A sample (vectors of least keyed hash: ``PER_LIST`` for each list, ``SAMPLE`` at least, ``SAMPLE_BYTES`` at most) fits
the lists' centroids, one for each of sqrt(n) lists, and finds how many lists a query must probe for its true
neighbours in the sample to be met with ``RECALL``; every vector is indexed.

Queries go twice. The first round scans an eighth of the probes, the nearest lists; its k-th best distance bounds what
can matter in the second, which scans the others. Within a list, vectors are rotated at random and taken in blocks of
columns. After d of D columns a candidate is abandoned if its partial distance, scaled by D / d, exceeds that bound by
the factor (1 + ``EPSILON`` / sqrt(d))**2: a hypothesis test that a true neighbour fails rarely. The bound tightens
with each ``CHUNK`` candidates. Survivors get their exact score on the original vectors.

Lists are split into shards of about ``SHARD`` vectors, and the queries of a list into parts of about ``PART``, so
one vector that a third of all rows repeat fills many shards and no task holds a list. Queries for which the probed
lists held too few rows are scanned again over all lists without abandoning any.

Work is queries x probed lists x sqrt(n). Vectors that form clusters need a few lists; vectors spread evenly in many
dimensions have no near lists, and any index of lists must probe a large share of them (README has figures of both).

Nearness is the inner product in double precision; ties go to the smaller vec_id. Defined results: vectors that are
null, zero, of another length than most, or hold null or non-finite components take no part, nor do rows without
vec_id. Rows that repeat a vec_id count as one, with the least vector. Fewer candidates than k are all returned.
Extra columns are left alone. An empty table, or no queries, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm import _scratch

K = 20
SAMPLE = 16_384
#: Sampled vectors for each list, and what the whole sample may take on the driver.
PER_LIST = 16
SAMPLE_BYTES = 256 << 20
ROUNDS = 12
RECALL = 0.97
EPSILON = 2.1
BLOCK = 16
#: Candidates after which a query's bound tightens.
CHUNK = 2048
#: The share of the probes in the first round.
FIRST = 8
#: Distances from centroids that are held at once.
CELLS = 1 << 22
SHARD = 20_000
PART = 2_000
SEED = 11


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (array<double>) of the vectors that take part."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    v = F.col("embedding").cast("array<float>" if kind == "array<float>" else "array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & fine)
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None, :], 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _blocks(x: np.ndarray, centroids: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of x in blocks whose distances from all centroids are ``CELLS`` at most."""
    step = max(1, CELLS // len(centroids))
    return (x[i : i + step] for i in range(0, len(x), step))


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(b, centroids).argmin(1) for b in _blocks(x, centroids)])


@dataclass(frozen=True)
class Index:
    """What the sample fits: the greatest norm, the rotation, centroids and lists to probe."""

    norm2: float
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int

    def raised(self, v: np.ndarray) -> np.ndarray:
        """Candidates with the added dimension."""
        return np.hstack([v, np.sqrt(np.maximum(self.norm2 - (v * v).sum(1), 0))[:, None]])

    @staticmethod
    def flat(q: np.ndarray) -> np.ndarray:
        """Queries with the added dimension."""
        return np.hstack([q, np.zeros((len(q), 1))])

    def lists(self, q: np.ndarray, n: int) -> np.ndarray:
        """For each query its n nearest lists, nearest first."""

        def nearest(block: np.ndarray) -> np.ndarray:
            d = _distances(block, self.centroids)
            near = np.argpartition(d, n - 1, 1)[:, :n] if n < d.shape[1] else np.broadcast_to(np.arange(d.shape[1]), d.shape)
            return np.take_along_axis(near, np.take_along_axis(d, near, 1).argsort(1, kind="stable"), 1)

        return np.concatenate([nearest(b) for b in _blocks(self.flat(q), self.centroids)])


def fit(rows: DataFrame, n: int, k: int = K) -> Index:
    """The index of rows (usable ones, n of them)."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    norm2, width = rows.agg(F.max(square), F.max(F.size("v"))).first()
    size = min(max(SAMPLE, int(PER_LIST * n**0.5)), max(1, SAMPLE_BYTES // (8 * (width + 1))))
    v = _matrix(rows.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(size).select("v").toPandas()["v"])
    random = np.random.default_rng(SEED)
    rotation = np.linalg.qr(random.standard_normal((v.shape[1] + 1,) * 2))[0]
    raised = np.hstack([v, np.sqrt(np.maximum(norm2 - (v * v).sum(1), 0))[:, None]])
    lists = int(min(max(1, n**0.5), max(1, len(v) / PER_LIST)))
    centroids = raised[random.permutation(len(v))[:lists]].copy()
    for _ in range(ROUNDS):
        own = _nearest(raised, centroids)
        counts = np.bincount(own, minlength=lists)
        order = np.argsort(own, kind="stable")
        used = np.flatnonzero(counts)
        sums = np.add.reduceat(raised[order], (np.cumsum(counts) - counts)[used])
        centroids[used] = sums / counts[used, None]
    own = _nearest(raised, centroids)
    index = Index(norm2, rotation, centroids, lists)
    some = random.permutation(len(v))[:400]
    needed = []
    for i in some:
        d = _distances(index.flat(v[i : i + 1]), raised)[0]
        d[i] = np.inf
        true = np.argsort(d)[: min(k, len(v) - 1)]
        place = np.empty(lists, np.int64)
        place[index.lists(v[i : i + 1], lists)[0]] = np.arange(lists)
        needed.append(place[own[true]])
    needed = np.sort(np.concatenate(needed))
    probes = int(needed[min(len(needed) - 1, int(len(needed) * RECALL))]) + 1 if len(needed) else lists
    return Index(norm2, rotation, centroids, probes)


def scan(index: Index, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, bounds: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest of each query among the candidates: columns are taken in blocks, hopeless pairs abandoned."""
    rotated, asked = index.raised(x) @ index.rotation, index.flat(q) @ index.rotation
    width, bounds = rotated.shape[1], bounds.copy()
    best = np.full((len(q), k), np.inf)
    found = []
    for at in range(0, len(ids), CHUNK):
        block, names = rotated[at : at + CHUNK], ids[at : at + CHUNK]
        partial = _distances(asked[:, :BLOCK], block[:, :BLOCK])
        limit = bounds * (1 + EPSILON / np.sqrt(min(BLOCK, width))) ** 2 * min(BLOCK, width) / width
        qi, xi = np.nonzero((partial <= limit[:, None]) & (names[None, :] != query_ids[:, None]))
        sums = partial[qi, xi]
        for d in range(BLOCK, width, BLOCK):
            to = min(d + BLOCK, width)
            gap = asked[qi, d:to] - block[xi, d:to]
            sums = sums + np.einsum("ij,ij->i", gap, gap)
            slack = (1 + EPSILON / np.sqrt(to)) ** 2 if to < width else 1 + 1e-9
            alive = sums <= bounds[qi] * slack * to / width
            qi, xi, sums = qi[alive], xi[alive], sums[alive]
        found.append((qi, at + xi))
        if at + CHUNK < len(ids):
            order = np.lexsort((sums, qi))
            rank = np.arange(len(qi)) - np.searchsorted(qi[order], qi[order])
            new = np.full((len(q), k), np.inf)
            new[qi[order][rank < k], rank[rank < k]] = sums[order][rank < k]
            best = np.partition(np.hstack([best, new]), k - 1, 1)[:, :k]
            # Ties and rounding stay: the exact score decides.
            bounds = np.minimum(bounds, best[:, k - 1] * (1 + 1e-9) + 1e-9 * index.norm2)
    qi, xi = (np.concatenate(c) for c in zip(*found))
    score = np.concatenate([np.zeros(0), *((q[qi[i : i + 65536]] * x[xi[i : i + 65536]]).sum(1) for i in range(0, len(qi), 65536))])
    order = np.lexsort((ids[xi], -score, qi))
    qi, xi, score = qi[order], xi[order], score[order]
    first = np.searchsorted(qi, qi)
    top = np.arange(len(qi)) - first < k
    return pd.DataFrame({"query_id": query_ids[qi[top]], "vec_id": ids[xi[top]], "score": score[top]})


def _probe(index: Index, listed: DataFrame, asked: DataFrame, k: int, lo: int, hi: int) -> DataFrame:
    """query_id, vec_id, score: the k nearest of each query (vec_id, v, bound) in each part of its lists lo to hi, by nearness."""

    @F.pandas_udf("array<int>")
    def near(v: pd.Series) -> pd.Series:
        return pd.Series(list(index.lists(_matrix(v), hi)[:, lo:].astype(np.int32)))

    asked = _scratch.table(asked.select("vec_id", "v", "bound", F.explode(near("v")).alias("list")), "asked")
    sizes = listed.groupBy("list").agg(F.count("*").alias("n")).withColumn("shards", F.ceil(F.col("n") / SHARD).cast("int"))
    parts = asked.groupBy("list").agg(F.count("*").alias("m")).withColumn("parts", F.ceil(F.col("m") / PART).cast("int"))
    # A row for each list: sqrt(n) at most, and as the sample's bytes allow.
    split = F.broadcast(_scratch.table(sizes.join(parts, "list").select("list", "shards", "parts"), "split"))
    left = listed.join(split, "list").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("list", "shard", "part", "vec_id", "v")
    right = asked.join(split, "list").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    right = right.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select("list", "shard", "part", "vec_id", "v", "bound")

    def group(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if x.empty or q.empty:
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        return scan(index, x["vec_id"].to_numpy(), _matrix(x["v"]), q["vec_id"].to_numpy(), _matrix(q["v"]), q["bound"].to_numpy(), k)

    key = ["list", "shard", "part"]
    return left.groupBy(key).cogroup(right.groupBy(key)).applyInPandas(group, "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _bounded(asked: DataFrame, best: DataFrame, norm2: float, k: int) -> DataFrame:
    """asked with bound: the distance of each query's k-th best so far, or none where it has fewer."""
    last = best.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "score")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    distance = F.greatest(square + F.lit(norm2) - 2 * F.col("score"), F.lit(0.0)) * (1 + 1e-9) + 1e-9 * norm2
    return asked.join(last, "vec_id", "left").select("vec_id", "v", F.coalesce(distance, F.lit(float("inf"))).alias("bound"))


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k nearest. Both tables: vec_id, embedding."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = _scratch.table(usable(vectors), "vectors")
    widths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not widths:
        return empty
    width = widths[0]["d"]
    rows, n = rows.filter(F.size("v") == width), widths[0]["count"]
    asked = _scratch.table(usable(queries).filter(F.size("v") == width), "queries")
    if asked.isEmpty():
        return empty
    index = fit(rows, n, k)

    @F.pandas_udf("int")
    def own(v: pd.Series) -> pd.Series:
        return pd.Series(_nearest(index.raised(_matrix(v)), index.centroids).astype(np.int32))

    listed = _scratch.table(rows.withColumn("list", own("v")), "lists")
    open_ = asked.withColumn("bound", F.lit(float("inf")))
    first = -(-index.probes // FIRST)
    best = _scratch.table(_best(_probe(index, listed, open_, k, 0, first), k), "first")
    if first < index.probes:
        more = _probe(index, listed, _bounded(asked, best, index.norm2, k), k, first, index.probes)
        best = _scratch.table(_best(best.select("query_id", "vec_id", "score").unionByName(more), k), "best")
    full = best.groupBy("query_id").count().join(asked.select(F.col("vec_id").alias("query_id"), F.lit(True).alias("asked")), "query_id", "right")
    inside = asked.join(rows.select("vec_id"), "vec_id", "left_semi").select(F.col("vec_id").alias("query_id"), F.lit(1).alias("own"))
    need = F.least(F.lit(k), F.lit(n) - F.coalesce("own", F.lit(0)))
    short = full.join(inside, "query_id", "left").filter(F.coalesce("count", F.lit(0)) < need).select(F.col("query_id").alias("vec_id"))
    again = _scratch.table(open_.join(short, "vec_id", "left_semi"), "again")
    if again.isEmpty():
        return best
    rest = _best(_probe(index, listed, again, k, 0, len(index.centroids)), k)
    return best.join(again.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
