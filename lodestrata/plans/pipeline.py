"""The batch route: documents to mixtures, measurements, references, figures, claims, components, aliases, quality tables and the graph, all lazy."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import citations, vocab
from lodestrata.operators import aliases as alias_rules
from lodestrata.operators import components as compounds_of
from lodestrata.operators import graph, profile, prose, quality, references, resolve, tables
from lodestrata.sources import xml

#: The steps of a run of all, in order; aliases proposes definitions for people to confirm, so it runs only when named.
STEPS = ("route", "refs", "table", "figures", "text", "components", "validate", "graph")
ON_DEMAND = ("aliases",)
ORDER = ("route", "refs", "table", "figures", "text", "aliases", "components", "validate", "graph")


def steps(wanted: str) -> tuple[str, ...]:
    """The steps of a comma-separated list, in running order; an unknown one is an error."""
    names = [w.strip() for w in wanted.split(",") if w.strip()]
    if unknown := [n for n in names if n not in (*ORDER, "all")]:
        raise ValueError(f"unknown steps: {', '.join(unknown)}; known: {', '.join(ORDER)}, all")
    chosen = set(names) | (set(STEPS) if "all" in names else set())
    return tuple(s for s in ORDER if s in chosen)


LINES = "name string, cid string, property string, heading string, string string, data_source string, source_record string, record_title string, source_db string"
PAGES = "name string, cid string, page string"


@dataclass(frozen=True)
class Inputs:
    """What outside services and people have answered: lookups, profiles (by card), aliases, compounds, responses.

    lines (see ``LINES``): attributed property strings of compounds; line_responses: name, raw; pages (see ``PAGES``): web
    pages of compounds; answers: paper_key, correct (verdicts of the spot check). What isn't given counts as empty.
    """

    searches: DataFrame
    works: DataFrame
    stored_profiles: DataFrame
    profile_responses: DataFrame
    aliases: DataFrame
    compounds: DataFrame
    prose_responses: DataFrame
    lines: DataFrame | None = None
    line_responses: DataFrame | None = None
    pages: DataFrame | None = None
    answers: DataFrame | None = None


def _given(df: DataFrame | None, like: DataFrame, schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame([], schema) if df is None else df


@dataclass(frozen=True)
class Tables:
    """Everything that the route derives."""

    papers: DataFrame
    failed: DataFrame
    references: DataFrame
    references_todo: DataFrame
    figures: DataFrame
    profiles: DataFrame
    tables_unhandled: DataFrame
    mixtures: DataFrame
    measurements: DataFrame
    skipped_rows: DataFrame
    skipped_cells: DataFrame
    claims: DataFrame
    claims_todo: DataFrame
    claim_problems: DataFrame
    components: DataFrame
    components_todo: DataFrame
    component_properties: DataFrame
    aliases_found: DataFrame
    aliases_suggested: DataFrame
    index: resolve.Index = field(repr=False)

    def outputs(self) -> dict[str, DataFrame]:
        """The kinds of the store, each with slug."""
        slugs = self.papers.select("paper_key", "slug")
        with_slug = lambda df: df if "slug" in df.columns else df.join(slugs, "paper_key")
        kinds = {
            "papers": self.papers, "references": self.references, "figures": self.figures, "tables_unhandled": self.tables_unhandled,
            "mixtures": self.mixtures.drop("cells", "profile", "source_dois"), "measurements": self.measurements, "skipped_rows": self.skipped_rows, "sections_llm": self.claims,
        }
        return {k: with_slug(df) for k, df in kinds.items()}

    def fidelity(self, stored: DataFrame | None = None) -> DataFrame:
        """Stored measurements (else those just derived) held against their cells, read again from the source."""
        return quality.fidelity(self.measurements if stored is None else stored, tables.property_cells(self.mixtures))

    def invariants(self) -> DataFrame:
        cited = self.measurements.select(F.explode("source_keys").alias("key"))
        return quality.invariants(
            missing_paper_key=self.measurements.filter("paper_key is null").agg(F.count("*").alias("n")),
            duplicate_key=quality.repeated_keys(self.measurements, ["measurement_key"]),
            orphan_citation=quality.missing(cited, self.references, "key"),
            dangling_measurement=quality.missing(self.measurements, self.mixtures, "row_id"),
        )

    def duplicates(self) -> DataFrame:
        return quality.duplicates(self.measurements, ["dedup_key"], F.col("value"), F.col("paper_key"), F.col("row_id"))

    def queue(self) -> DataFrame:
        """The review queue of all papers."""
        return quality.review_queue(*quality.review_kinds(self.tables_unhandled, self.claims, prose.unresolved_names(self.claims), self.measurements, self.references))

    def nodes(self) -> dict[str, DataFrame]:
        return self.graph()[0]

    def relations(self) -> DataFrame:
        return self.graph()[1]

    def graph(self, with_prose: bool = True) -> tuple[dict[str, DataFrame], DataFrame]:
        """(nodes by label, relations) of everything."""
        return graph.load(self.mixtures, self.measurements, self.references, self.components, self.claims, self.papers, self.component_properties, with_prose)


def run(
    parsed: DataFrame, inputs: Inputs, backend: str = "injected", model: str = "none", every_section: bool = False, known: DataFrame | None = None, cut: Callable[[DataFrame, str], DataFrame] | None = None
) -> Tables:
    """All tables of parsed documents; every table reads them, so a large collection is best written or persisted first.

    known: mixtures of papers that aren't among the documents (a store's), whose names count as met. cut(df, name) may
    write what several tables derive from and read it again, so that it is derived once and plans stay short.
    """
    spark, cut = parsed.sparkSession, cut or (lambda df, name: df)
    good = xml.accepted(parsed)
    papers, found, cells = references.reviewed(xml.papers(good), inputs.works), xml.tables(good), xml.cells(good)
    bibliography = xml.bibliography(good)
    refs = cut(references.enriched(bibliography, inputs.searches, inputs.works), "references")
    cards = profile.cards(cells, found)
    checked = cut(profile.validated(profile.chosen(cards, inputs.stored_profiles, inputs.profile_responses), found, cells), "profiles")
    rows = tables.profiled_rows(cells, found, profile.accepted(checked))
    mixed = tables.mixtures(rows, papers)
    mixed = mixtures = cut(references.cited_by(mixed, refs, citations.expand(F.col("ref"))), "mixtures")
    bounds = vocab.properties(spark)
    measured = cut(tables.measurements(mixtures, bounds), "measurements")
    used = ["paper_key", "table_pos", "source_row", "components"]
    met = mixed.select(used)
    if known is not None:
        met = met.unionByName(known.join(papers.select("paper_key"), "paper_key", "left_anti").select(used))
    idx = resolve.index(met, inputs.aliases, inputs.compounds)
    idx = resolve.Index(*[cut(getattr(idx, f.name), f"index_{f.name}") for f in fields(idx)])
    sections = xml.sections(good)
    asked = prose.requests(prose.chosen(sections, every_section), backend, model)
    answers = inputs.prose_responses.groupBy("cache_key").agg(F.max("raw").alias("raw"))
    drafted, problems = prose.drafts(asked.join(answers, "cache_key"))
    claims = prose.finished(cut(prose.claims(cut(drafted, "drafts"), idx), "claims_resolved"), measured)
    claims = cut(references.cited_by(claims, refs, F.col("refs")), "claims")

    # Names of tables first, then those that only prose uses.
    names = resolve.distinct_components(mixed)
    prose_only = claims.select(F.explode("components").alias("name")).distinct().join(names, "name", "left_anti")
    every = names.unionByName(prose_only)
    lines = _given(inputs.lines, parsed, LINES)
    numbered = compounds_of.numbered(lines)
    line_answers = _given(inputs.line_responses, parsed, "name string, raw string").groupBy("name").agg(F.max("raw").alias("raw"))
    properties = compounds_of.rows(compounds_of.drafts(line_answers), numbered)
    properties = properties.unionByName(compounds_of.webbook_properties(_given(inputs.pages, parsed, PAGES)), allowMissingColumns=True)
    harvested = alias_rules.harvested(sections)
    hints = alias_rules.candidates(claims, measured)
    return Tables(
        papers=papers, failed=xml.failed(parsed), references=refs, references_todo=references.todo(bibliography, inputs.searches), figures=references.figures(xml.figures(good)), profiles=checked,
        tables_unhandled=profile.unhandled(found, checked), mixtures=mixtures, measurements=measured, skipped_rows=tables.skipped_rows(rows), skipped_cells=quality.skipped_cells(tables.property_cells(mixed)),
        claims=claims, claims_todo=asked.join(answers, "cache_key", "left_anti"), claim_problems=problems,
        components=compounds_of.looked_up(every, inputs.compounds, lines), components_todo=compounds_of.todo(every, inputs.compounds), component_properties=properties,
        aliases_found=alias_rules.checked(harvested, inputs.aliases, mixed, hints), aliases_suggested=alias_rules.suggested(claims, measured), index=idx,
    )
