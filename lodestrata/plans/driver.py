"""Runs chosen steps over a folder of documents and writes what they derive to the store.

Documents are parsed once; the parsed table lies in the store, and every step reads it. A document that can't be parsed or
has no DOI stops the run unless errors are passed over; then it and any step that fails are reported, and all others run.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators import graph, prose, quality, references
from lodestrata.plans import pipeline
from lodestrata.sources import store, xml

PARSED = "parsed"
MOST_FAILURES = 20


@dataclass
class Report:
    """What a run did: the steps that ended, and (step or document, error) of what failed."""

    done: list[str] = field(default_factory=list)
    failed: list[tuple[str, str]] = field(default_factory=list)


def _stored(spark: SparkSession, base: str, kind: str, like: Callable[[], DataFrame]) -> DataFrame:
    """A kind's rows in the store, or none in the shape of what like gives."""
    return store.read_all(spark, base, kind) if store.exists(spark, base, kind) else like().limit(0)


def run(
    spark: SparkSession, folder: str, base: str, inputs: pipeline.Inputs, wanted: str = "all", papers: list[str] | None = None, continue_on_error: bool = False, every_section: bool = False, with_prose: bool = True
) -> Report:
    """Runs the steps of a comma-separated list in order. papers: slugs to restrict the run to."""
    todo, report = pipeline.steps(wanted), Report()
    parsed_path = f"{base.rstrip('/')}/{PARSED}"
    xml.parse(xml.files(spark, folder, papers)).write.mode("overwrite").parquet(parsed_path)
    parsed = spark.read.parquet(parsed_path)
    bad = xml.failed(parsed).orderBy("slug").limit(MOST_FAILURES).collect()
    if bad and not continue_on_error:
        raise ValueError("; ".join(f"{r['slug']}: {r['reason']}" for r in bad))
    report.failed += [(r["slug"], r["reason"]) for r in bad]
    cut, drop = store.cutter(base)

    @functools.cache
    def out() -> pipeline.Tables:
        """What the documents yield: derived when the first step asks for it."""
        known = store.read_all(spark, base, "mixtures").select("paper_key", "table_pos", "source_row", "components") if store.exists(spark, base, "mixtures") else None
        return pipeline.run(parsed, inputs, every_section=every_section, known=None if known is None else cut(known, "known"), cut=cut)

    def kind(name: str) -> DataFrame:
        return _stored(spark, base, name, lambda: out().outputs()[name])

    def put(*names: str) -> Callable[[], None]:
        def act() -> None:
            for name in names:
                store.write(out().outputs()[name], base, name, out().papers.select("slug", "paper_key"))

        return act

    def components() -> None:
        store.write_corpus(out().components, base, "components")
        store.write_corpus(out().component_properties, base, "component_properties")

    def validate() -> None:
        measured, claims, refs, unhandled = (kind(k) for k in ("measurements", "sections_llm", "references", "tables_unhandled"))
        here = measured.join(xml.papers(xml.accepted(parsed)).select("paper_key"), "paper_key", "left_semi")
        answers = inputs.answers if inputs.answers is not None else spark.createDataFrame([], "paper_key string, correct string")
        store.write_corpus(quality.verdict(here, out().fidelity(here), answers), base, "acceptance")
        store.write_corpus(quality.duplicates(measured, ["dedup_key"], F.col("value"), F.col("paper_key"), F.col("row_id")), base, "duplicates")
        store.write_corpus(quality.review_queue(*quality.review_kinds(unhandled, claims, prose.unresolved_names(claims), measured, refs)), base, "review_queue")
        store.write_corpus(out().invariants(), base, "invariants")

    def load_graph() -> None:
        components = _stored(spark, base, "components", lambda: out().components)
        properties = _stored(spark, base, "component_properties", lambda: out().component_properties)
        nodes, relations = graph.load(kind("mixtures"), kind("measurements"), kind("references"), components, kind("sections_llm"), kind("papers"), properties, with_prose)
        store.write_corpus(graph.long_nodes(nodes), base, "graph_nodes")
        store.write_corpus(relations, base, "graph_relations")

    acts: dict[str, Callable[[], None]] = {
        "route": put("papers"),
        "refs": put("references"),
        "table": put("mixtures", "measurements", "skipped_rows", "tables_unhandled"),
        "figures": put("figures"),
        "text": put("sections_llm"),
        "aliases": lambda: store.write_corpus(out().aliases_found, base, "aliases"),
        "components": components,
        "validate": validate,
        "graph": load_graph,
    }
    for step in todo:
        try:
            acts[step]()
            report.done.append(step)
        except Exception as problem:  # any step may fail in its own way; what follows may still run
            if not continue_on_error:
                raise
            report.failed.append((step, f"{type(problem).__name__}: {str(problem).splitlines()[0] if str(problem) else ''}"))
    drop()
    return report


def worklists(out: pipeline.Tables) -> dict[str, DataFrame]:
    """What outside services, models and people still have to answer."""
    return {"references": references.ordered(out.references_todo), "claims": out.claims_todo, "components": out.components_todo, "review": out.queue()}
