"""Quality rules against a plain count, and SQL."""

import re

from lodestrata.llm import rules

WORD = re.compile(rules.WORD)


def slow(text):
    t = text or ""
    w = WORD.findall(t)
    seen: dict = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {j for places in seen.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    repeats = len(covered)
    return len(w), sum(map(len, w)), sum(c in rules.SYMBOLS for c in t), len(lines) - len(set(lines)), repeats, len(w) < 50 or 100 * repeats > 50 * len(w)


def check(df):
    texts: dict = {}
    for r in df.select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], set()).add(slow(r["text"]))
    got = rules.judge(df).collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) in texts[r["doc_id"]]
        assert not (r["base_failed"] and r["kept"])
    return got


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in check(docs) if r["kept"]}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        assert r["quality"] == 1 or r["doc_id"] not in kept


def test_odd_rows(odd):
    assert len(check(odd)) == 12
    assert check(odd.limit(0)) == []


def test_repeats_at_the_ends(spark):
    texts = ["a b c a b c", "a a a a", "a a a", "x a b c y a b c", "a\x0bb\x0cc a\tb\rc", "a\n\na\nb a\n"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
