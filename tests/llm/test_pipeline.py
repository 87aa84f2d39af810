"""The pipeline's stages on their own inputs, and the registered queries."""

import corpus_pipeline
from lodestrata.llm import _scratch, dedup, queries


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = _scratch.table(stage(spark, docs, sf), "test")
        sizes.append(docs.count())
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] and sizes[-1] >= sizes[-2] > 0
    before = _scratch.made()
    assert corpus_pipeline.run(spark, sf).count() == sizes[-1]
    assert _scratch.made() - before <= 2  # the last stage's input, and its pieces


def test_stages_on_odd_rows(spark, odd, sf):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = _scratch.table(stage(spark, docs, sf), "test")
        assert docs.columns == odd.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= 0


def test_stages_on_an_empty_table(spark, odd, sf):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd.limit(0), sf)
        assert out.count() == 0 and (name == corpus_pipeline.STAGES[-1][0] or out.columns == odd.columns)


def test_near_dedup_compares_a_group_once(spark, monkeypatch):
    """Near copies, with a repeated doc_id: about one pair of sets for each text, and one document is left."""
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join([*words[:i], f"n{i}", *words[i + 1 :]]) for i in range(0, 200, 2)]
    docs = spark.createDataFrame([(i // 2 if i < 2 else i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    pairs, confirmed = [], dedup._confirmed

    def counted(rows, *args):
        pairs.append(rows.count())
        return confirmed(rows, *args)

    monkeypatch.setattr(dedup, "_confirmed", counted)
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert [r["doc_id"] for r in kept] == [0] and sum(pairs) <= 1.5 * len(texts)


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
    assert set(queries.oracle_sql()) <= set(queries.queries())
