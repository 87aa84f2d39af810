"""URL rules against a loop over all rules, collisions included."""

import itertools
import random

import numpy as np

from lodestrata.llm import urls


def slow(url, rules, blocked):
    host, path = urls.parts(url)
    fits = []
    for verdict, rule in rules:
        h, slash, rest = rule.partition("/")
        if host and (host == h or host.endswith("." + h)) and path.startswith(slash + rest):
            fits.append((len(rule), rule, verdict))
    if fits:
        return (host, path, max(fits)[1], max(fits)[2])
    return (host, path, None, "block" if any(host == b or host.endswith("." + b) for b in blocked) else "allow")


def test_equals_a_loop(spark):
    rng = random.Random(5)
    hosts = ["org", "example.org", "a.example.org", "EXAMPLE.org", "badexample.org", "cheap-pills.example.com", "x.cheap-pills.example.com", "com", "q.com", "", "a..org", "org:80"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?x=1", "/fr/#a", "/de/x/y", "?q", "#f/es/"]
    made = [f"http://{h}{p}" for h, p in itertools.product(hosts, paths)] + [None, "", "nothing", "a://b://c/d", "http://" + "x." * 500 + "org/" + "p" * 5000]
    rng.shuffle(made)
    rows = [(i, u, "clash") for i, u in enumerate(made)] + [(0, made[0], "clash"), (None, made[1], "clash")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert sorted(map(str, got)) == sorted(str(type(got[0])(page_id=i, host=w[0], path=w[1], rule=w[2], verdict=w[3])) for i, u, _ in rows for w in [slow(u, urls.RULES, urls.BLOCKED_HOSTS)])


def test_colliding_keys_are_told_apart(tmp_path):
    path = str(tmp_path / "i")
    urls.DigestArray.build([("block", f"h{i}.org/") for i in range(50)], path)
    keys = np.load(f"{path}.keys.npy")
    np.save(f"{path}.keys.npy", np.full_like(keys, keys[0]))
    index = urls.DigestArray(path)
    one = [c.encode() for c in ("h7.org/", "h8.org/", "other.org/")]
    original = urls.xxhash.xxh64_intdigest
    try:
        urls.xxhash.xxh64_intdigest = lambda _: int(keys[0])
        places = index.find(one)
    finally:
        urls.xxhash.xxh64_intdigest = original
    assert places[2] == -1 and places[0] != places[1] and min(places[:2]) >= 0


def test_empty_index_and_table(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert urls.judge(pages, (), ()).first()["verdict"] == "allow"
    assert urls.judge(pages.limit(0)).count() == 0


def test_a_million_rules(spark):
    """A block list from a table: hosts and host paths, each found, nothing else."""
    n = 1_000_000
    table = spark.range(n).selectExpr("if(id % 3 = 0, concat('h', id, '.example.net/p', id % 7, '/'), concat('H', id, '.example.net')) AS rule").union(spark.createDataFrame([(None,), ("  ",)], "rule string"))
    rng = random.Random(8)
    picked = [rng.randrange(n + 1000) for _ in range(600)]
    made = [f"http://{'sub.' if i % 2 else ''}h{i}.example.net/p{i % 7 if i % 5 else 9}/x" for i in picked] + ["http://example.net/", "http://xh3.example.net/p3/"]
    pages = spark.createDataFrame(list(enumerate(made)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages, (), table).collect()}
    want = ["block" if i < n and (i % 3 or i % 5) else "allow" for i in picked] + ["allow", "allow"]
    assert [got[i] for i in range(len(made))] == want and want.count("block") > 300
