"""Near-dedup against all pairs."""

import numpy as np
import pytest

from lodestrata.llm import dedup


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def by_brute_force(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_components_equal_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in dedup.near_duplicates(docs).collect()}
    assert got == by_brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_a_group_without_a_hub(spark):
    """Neighbours in a chain are close, its ends are not: the whole chain is one component."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    docs, text = [], list(words)
    for i in range(40):
        docs.append((i, " ".join(text)))
        at = int(rng.integers(0, 380))
        text[at : at + 3] = [f"n{i}a", f"n{i}b", f"n{i}c"]
    docs += [(100 + i, " ".join(rng.permutation(words))) for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in dedup.near_duplicates(df).collect()}
    assert got == by_brute_force(docs)


def test_a_group_of_near_copies_needs_about_one_pair_and_link_a_class(spark, monkeypatch):
    """Pairs within a component cost neither a comparison of sets nor a round over their links."""
    rng = np.random.default_rng(11)
    base, docs, count = [f"w{i}" for i in range(200)], [], {"pairs": 0, "links": 0}
    for i in range(120):
        text = list(base)
        at = int(rng.integers(0, 195))
        text[at : at + 3] = [f"n{i}a", f"n{i}b", f"n{i}c"]
        docs.append((i, " ".join(text)))
    confirmed, components = dedup._confirmed, dedup.components

    def counted(name, f):
        def run(rows, *args):
            count[name] += rows.count()
            return f(rows, *args)

        return run

    monkeypatch.setattr(dedup, "_confirmed", counted("pairs", confirmed))
    monkeypatch.setattr(dedup, "components", counted("links", components))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in dedup.near_duplicates(df).collect()}
    assert got == by_brute_force(docs) and {c for _, c in got.values()} == {0}
    assert count["pairs"] <= 1.5 * len(docs) and count["links"] <= 1.5 * len(docs)


def test_later_links_join_components(spark):
    rng = np.random.default_rng(4)
    links = [tuple(map(int, rng.integers(0, 300, 2))) for _ in range(200)]
    first, second = (spark.createDataFrame(part, "a long, b long") for part in (links[:90], links[90:]))
    want = {r["id"]: r["label"] for r in dedup.components(first.union(second)).collect()}
    for given in (second, second.union(first), second.limit(0)):
        got = {r["id"]: r["label"] for r in dedup.merged(dedup.components(first), given).collect()}
        assert got == (want if given.count() else {r["id"]: r["label"] for r in dedup.components(first).collect()})


def test_block_links_are_exact():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 40, 100)
    sets = [np.unique(np.where(rng.random(100) < rng.random() * 0.4, rng.integers(0, 1 << 40, 100), base)) for _ in range(60)]
    ids = np.arange(60)
    found = dedup.block_links(ids, ids.copy(), sets, 75)

    def groups(links):
        root = list(range(60))
        for a, b in links:
            x, y = root[a], root[b]
            root = [x if r == y else r for r in root]
        return [root.index(r) for r in root]

    links = [(i, j) for i in range(60) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
    assert groups(found) == groups(links)


def test_odd_rows(odd):
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in dedup.near_duplicates(odd).collect()), key=str)
    found = {(i, n, c, k) for null, i, n, c, k in got if not null}
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (7, 1, 4, False), (6, 4, 5, False), (5, 4, 5, True)} <= found
    assert len(got) == 12 and [k for null, _, _, _, k in got if null] == [True, True]
    kept = dedup.keep_one(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 4").count() == 1 and kept.filter("doc_id is null").count() == 2


def varied(seed, words=60):
    """Four texts without a common run, and a near copy of each."""
    rng = np.random.default_rng(seed)
    texts = [[f"w{x}" for x in rng.integers(0, 1 << 30, words)] for _ in range(4)]
    return [" ".join(t) for t in texts], [" ".join([*t[:-2], "end"]) for t in texts]


def test_what_links_a_row_links_all_rows_of_its_doc_id(spark):
    (a, b, c, d), (_, b2, c2, _) = varied(7)
    docs = [(3, a), (5, a), (5, b), (9, b2), (5, ""), (6, c), (6, d), (8, c2), (7, c), (7, None), (2, None)]
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    want = {3: 3, 5: 3, 9: 3, 6: 6, 8: 6, 7: 6, 2: 2}
    assert sorted(got) == sorted((i, want[i], want[i] == i) for i, _ in docs)


def test_no_text_is_lost_under_a_repeated_doc_id(spark):
    (a, b, c, d), (a2, b2, c2, d2) = varied(8)
    docs = [(3, a), (5, a), (5, b), (9, b2), (6, c), (6, d), (6, d), (2, c2), (8, d2), (4, ""), (4, a2), (4, None), (None, a)]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(docs)], "doc_id long, text string, label long")
    got = [(r["doc_id"], r["text"]) for r in dedup.keep_one(df).collect()]
    want = [(3, a), (5, b), (2, c2), (6, d), (4, ""), (4, None), (None, a)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty(odd):
    assert dedup.near_duplicates(odd.limit(0)).count() == 0 and dedup.keep_one(odd.limit(0)).count() == 0


@pytest.mark.parametrize("n", [64])
def test_signatures_are_unbiased(n):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    other = np.concatenate((base[:857], rng.integers(0, 1 << 63, 143, dtype=np.uint64)))
    both = dedup.minmax(np.concatenate((base, other)), np.array([0, 1000, 2000]), n)
    assert abs((both[0] == both[1]).mean() - 857 / 1143) < 0.15
