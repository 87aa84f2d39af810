"""Neighbours against brute force."""

import numpy as np
import pytest

from lodestrata.llm import neighbours


def exact(ids, x, qid, q, k):
    score = (x * q).sum(1)
    score[ids == qid] = -np.inf
    order = np.lexsort((ids, -score))[: min(k, len(ids) - (qid in ids))]
    return [(int(ids[i]), float(score[i])) for i in order]


def recall(vectors, got):
    ids, x = np.array([r[0] for r in vectors]), np.array([r[1] for r in vectors], np.float32).astype(float)
    by: dict = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for qid, rows in by.items():
        want = exact(ids, x, qid, x[ids == qid][0], neighbours.K)
        rows.sort()
        assert [r for r, *_ in rows] == list(range(1, len(want) + 1))
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        for _, v, s in rows:
            assert s == pytest.approx(float((x[ids == v][0] * x[ids == qid][0]).sum()), rel=1e-14)
        hits += len({v for _, v, _ in rows} & {v for v, _ in want})
        total += len(want)
    return hits / total


def test_recall_on_the_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = neighbours.search(table, table.filter("vec_id % 20 = 0")).collect()
    assert recall([(r["vec_id"], r["embedding"]) for r in table.collect()], got) >= 0.9


def test_norms_differ_and_one_vector_repeats(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 100)
    monkeypatch.setattr(neighbours, "PART", 7)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((900, 8)) * rng.lognormal(0, 0.5, (900, 1))
    x[300:600] = x[300]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.search(table, table.filter("vec_id % 20 = 0")).collect()
    assert len(got) == 45 * 20 and recall(rows, got) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (40, [None, 1.0]), (60, [1.0]), (None, [1.0, 1.0]), (2, [1.0, 0.0]), (80, [-1.0, 2.0]), (7, [inf, 0.0]), (100, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS v", "2 AS list", "3 AS rank")
    got = sorted(tuple(r) for r in neighbours.search(table, table.filter("vec_id % 20 = 0")).collect())
    assert got == [(20, 1, 1, 1.0), (20, 2, 2, 1.0), (20, 3, 80, -1.0), (80, 1, 1, -1.0), (80, 2, 2, -1.0), (80, 3, 20, -1.0)]
    assert neighbours.search(table.limit(0), table).count() == 0 and neighbours.search(table, table.limit(0)).count() == 0
    lone = table.filter("vec_id = 20")
    assert neighbours.search(lone, lone).count() == 0


def test_clusters_need_few_lists(spark):
    """Where vectors form clusters the share of lists that is probed falls as they grow in number, and recall stays."""
    rng = np.random.default_rng(4)
    shares = []
    for n in (2_000, 16_000):
        centres = rng.standard_normal((n // 20, 32))
        x = centres[rng.integers(0, len(centres), n)] + 0.2 * rng.standard_normal((n, 32))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        rows = [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]
        table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        index = neighbours.fit(neighbours.usable(table), n)
        shares.append(index.probes / len(index.centroids))
        got = neighbours.search(table, table.filter("vec_id % 20 = 0")).collect()
        assert recall(rows, got) >= 0.9
    assert shares[1] < shares[0] and shares[1] < 0.2


def test_chunks_tighten_the_bound(monkeypatch):
    """Candidates taken in small chunks, all dimensions counted: what is found is exact."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((500, 24))
    q, ids = x[:30], np.arange(500)
    norm2 = float((x * x).sum(1).max())
    index = neighbours.Index(norm2, np.linalg.qr(rng.standard_normal((25, 25)))[0], x[:1], 1)
    monkeypatch.setattr(neighbours, "CHUNK", 40)
    monkeypatch.setattr(neighbours, "EPSILON", 50)
    got = neighbours.scan(index, ids, x, ids[:30], q, np.full(30, np.inf), 20)
    for i in range(30):
        own = got[got["query_id"] == i]
        assert own["vec_id"].tolist() == [j for j, _ in exact(ids, x, i, q[i], 20)]
