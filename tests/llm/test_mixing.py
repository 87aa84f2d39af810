"""Mixing: targets by the water level, totals near targets, copies at most 2, reruns."""

import collections
import math

import pytest

from lodestrata.llm import mixing


def want_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=str) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share > 2 * sizes[s]}
        for s in full or open_:
            out[s] = 2.0 * sizes[s] if full else weight[s] * share
        left -= sum(out[s] for s in (full or open_))
        open_ -= full or set(open_)
    return out


def check(df):
    rows = mixing.mix(df).collect()
    sizes = collections.Counter()
    for r in df.select("source", "text").collect():
        sizes[r["source"]] += len((r["text"] or "").split())
    targets = want_targets(sizes)
    taken, least = collections.Counter(), {}
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"]
        least[r["source"]] = max(least.get(r["source"], 0), r["size"])
    return rows, taken, targets, least


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows, taken, targets, longest = check(docs)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= max(0.02 * target, 1) or abs(taken[s] - target) < longest[s] / 2
    key = lambda r: (r["doc_id"], r["size"])
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=lambda r: r[0]) == sorted(map(tuple, rows), key=lambda r: r[0])
    assert len(rows) == docs.count() and key(rows[0])


def test_odd_rows(odd):
    rows, *_ = check(odd)
    assert len(rows) == 12
    mixed = mixing.repeated(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.repeated(odd.limit(0)).count() == 0


def test_one_size_in_one_source(spark):
    """One hot cell: half of the rows get one more copy than the others."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "'a b c d' AS text", "if(id < 2000, 'hot', 'z') AS source")
    _, taken, targets, _ = check(docs)
    assert all(abs(taken[s] - targets[s]) <= 4 for s in targets)


def solved(cells, target):
    """l with sum n * size * min(2, exp(l * x)) = target, by bisection: what the dual's optimum must be."""
    mean = sum(n * z for z, n in cells.items()) / sum(cells.values())

    def words(l):
        return sum(n * z * min(2.0, math.exp(min(l * z / mean, 50))) for z, n in cells.items())

    lo, hi = -200.0, 200.0
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if words(mid) < target else (lo, mid)
    return lo, mean


@pytest.mark.parametrize("weights", [(3, 1, 2), (1, 5, 1)])
def test_rates_solve_the_dual(spark, monkeypatch, weights):
    """The multipliers are those of a plain solver, and copies follow the running sum of their rates."""
    monkeypatch.setattr(mixing.targets, "__defaults__", (weights, mixing.SHARE))
    rows = [(i, " ".join(["w"] * (1 + (i * i) % 37)), "abcd"[i % 4] if i % 9 else None) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seen = []
    original = mixing.multipliers
    monkeypatch.setattr(mixing, "multipliers", lambda cells: seen.append((cells.collect(), out := original(cells), out.collect())) or out)
    got = mixing.mix(df).collect()
    (cells, _, found), = seen
    lagrange = {r["sid"]: r["l"] for r in found}
    by: dict = collections.defaultdict(dict)
    goals = {}
    for r in cells:
        by[r["sid"]][r["size"]] = r["n"]
        goals[r["sid"]] = (r["target"], r["full"], r["source"])
    taken: dict = collections.Counter()
    for r in got:
        taken[r["source"], r["size"]] += r["copies"]
    assert any(not full for _, full, _ in goals.values())
    for sid, (target, full, source) in goals.items():
        if full:
            assert all(taken[source, z] == 2 * n for z, n in by[sid].items())
            continue
        want, mean = solved(by[sid], target)
        assert lagrange[sid] == pytest.approx(want, abs=1e-5)
        # Along the sizes, longest first, copies keep within one of the sum of rates (one cell may be mended by one).
        upto = copies = 0.0
        for z in sorted(by[sid], reverse=True):
            upto += by[sid][z] * min(2.0, math.exp(want * z / mean))
            copies += taken[source, z]
            assert abs(copies - upto) <= 1.5 + 1e-3
