"""The batch route on hand-written documents: parse, profile, tables, references, prose, quality, graph, store, stream."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import vocab
from lodestrata.operators import graph, profile, prose, quality, references, tables
from lodestrata.plans import driver, pipeline
from lodestrata.sources import dialects, responses, store, xml
from lodestrata.streaming import ingest
from tests import documents as docs

#: What a model drafts from a section, and the status that each draft gets.
CLAIMS = (
    ({}, "duplicate"),
    ({"value": None}, "qualitative"),
    ({"value": 3.25}, "unverified"),
    ({"value": 1.2, "source_text": "x"}, "ok"),
    ({"value": 1.2, "components": ["Unknownium"], "source_text": ""}, "unresolved_components"),
)
REF = "paper_key string, ref_number int, doi string, score double"
WORKS = "doi string, authors array<string>, title string, journal string, volume string, issue string, pages string, year string"
COMPOUNDS = "name string, cid string, lookup_status string"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("xml")
    (path / "one.xml").write_text(docs.elsevier())
    (path / "two.xml").write_text(docs.elsevier("https://doi.org/10.1000/TWO"))
    (path / "jats one.xml").write_text(docs.JATS)
    (path / "no doi.xml").write_text(docs.elsevier(""))
    (path / "odd.xml").write_text("<book/>")
    (path / "broken.xml").write_text("<a>")
    return str(path)


@pytest.fixture(scope="module")
def parsed(spark, folder):
    return xml.parse(xml.files(spark, folder)).persist()


def inputs(spark, asked=None, cards=None, raw=None):
    stored = spark.createDataFrame([], f"paper_key string, table_id string, card_hash string, source string, profile {profile.PROFILE}")
    answers = [] if cards is None else [(r["card_hash"], json.dumps(docs.PROFILE)) for r in cards.collect() if r["table_id"] == "t1"]
    prose = [] if asked is None else [(r["cache_key"], raw) for r in asked.collect()]
    return pipeline.Inputs(
        searches=spark.createDataFrame([("10.1000/one", 1, "10.5/A", 90.0), ("10.1000/one", 3, "10.5/low", 39.9), ("10.1000/two", 1, "10.5/B", 50.0)], REF),
        works=spark.createDataFrame([("10.5/a", ["A. Smith", "B. Roe"], "Density of deep solvents", "J | C", "1", "2", "3-4", "2001")], WORKS),
        stored_profiles=stored,
        profile_responses=spark.createDataFrame(answers, "card_hash string, raw string"),
        aliases=spark.createDataFrame([("chcl", "Choline chloride", "human", False), ("teab", None, "human", False)], "abbr string, name string, source string, ambiguous boolean"),
        compounds=spark.createDataFrame([("1,5-Pentanediol", "1", "ok"), ("Nothing", None, "not_found")], COMPOUNDS),
        prose_responses=spark.createDataFrame(prose, "cache_key string, raw string"),
    )


@pytest.fixture(scope="module")
def route(spark, folder, parsed, tmp_path_factory):
    good = xml.accepted(parsed)
    cards = profile.cards(xml.cells(good), xml.tables(good)).persist()
    asked = prose.requests(prose.chosen(xml.sections(good)), "injected", "none")
    cut, _ = store.cutter(str(tmp_path_factory.mktemp("work")))
    out = pipeline.run(parsed, inputs(spark, asked, cards, docs.prose_response(*(c for c, _ in CLAIMS))), cut=cut)
    for f in dataclasses.fields(out):
        if f.name != "index":
            getattr(out, f.name).persist()
    return out


def test_parse(parsed):
    rows = {r["slug"]: r for r in xml.inventory(parsed).collect()}
    assert rows["one"]["n_tables"] == 2 and rows["one"]["n_references"] == 3 and rows["one"]["n_sections"] == 2 and rows["one"]["n_figures"] == 1
    assert rows["jats_one"]["dialect"] == "jats" and rows["jats_one"]["n_references"] == 1 and rows["jats_one"]["n_sections"] == 1
    assert {(r["slug"], r["reason"].split(" ")[0]) for r in xml.failed(parsed).collect()} == {("no_doi", "no"), ("odd", "no"), ("broken", "unclosed")} or xml.failed(parsed).count() == 3
    paper = xml.papers(parsed).filter("slug = 'two'").first()
    assert (paper["paper_key"], paper["paper_doi"], paper["pages"], paper["year"], paper["authors"], paper["title"]) == ("10.1000/two", "10.1000/two", "12", "2021", "Ann B; Carl D", "A review of solvents")
    assert xml.papers(parsed).filter("slug = 'no_doi'").first()["paper_key"] == "xml:no_doi"
    refs = {r["ref_number"]: r["title"] for r in xml.bibliography(parsed).filter("paper_key = '10.1000/one'").collect()}
    assert refs == {1: "Density of solvents", 2: "New title", 3: "Third work"}


def test_paragraphs(parsed):
    found = {(r["slug"], r["section_id"]): r["paragraphs"] for r in xml.sections(parsed).collect()}
    assert found["one", "s3"] == ["Leaf text."] and found["jats_one", "a"] == ["Text."] and len(found["one", "s1"]) == 1 and found["one", "s1"][0].startswith("ChCl:Urea")


def test_cells(parsed):
    cells = {(r["part"], r["row"], r["col"]): r for r in xml.cells(parsed).filter("slug = 'one' and table_id = 't1'").collect()}
    assert len(cells) == 5 * 11
    assert cells["header", 1, 3]["text"] == "(g/cm3)" and cells["header", 1, 0]["text"] == "HBA"
    assert cells["body", 1, 0]["lines"] == ["Choline", "chloride"] and cells["body", 1, 0]["text"] == "Choline chloride"
    assert cells["body", 3, 0]["markers"] == ["-"] and cells["body", 7, 4]["text"] == ""
    ragged = xml.tables(parsed).filter("slug = 'one' and table_id = 't1'").first()["ragged"]
    assert [(r["row"], r["width"]) for r in ragged] == [(7, 2)]
    jats = {(r["row"], r["col"]): r["text"] for r in xml.cells(parsed).filter("slug = 'jats_one' and part = 'body'").collect()}
    assert jats == {(0, 0): "a", (0, 1): "1", (1, 0): "a", (1, 1): "2"}


def test_json_round_trip(parsed):
    again = xml.from_json(xml.to_json(parsed)).select(parsed.columns)
    assert sorted(map(str, again.collect())) == sorted(map(str, parsed.collect()))


def test_wide_cell_over_a_held_one_is_ragged():
    cell = {"text": "x"}
    _, width, ragged = dialects.grid([[(cell, 0, 1), (cell, 1, 1), (cell, 0, 1)], [(cell, 0, 2)]])
    assert width == 3 and [r["row"] for r in ragged] == [1]


def test_profiles(spark, route, parsed):
    checked = {(r["paper_key"], r["table_id"]): r for r in route.profiles.collect()}
    assert checked["10.1000/one", "t1"]["problems"] == [] and checked["10.1000/one", "t1"]["source"] == "llm"
    assert checked["10.1000/one", "t2"]["problems"] == ["no usable profile"]
    good = xml.accepted(parsed)
    base = route.profiles.filter("table_id = 't1' and paper_key = '10.1000/one'").drop("problems")

    def problems(change):
        return profile.validated(base.withColumn("profile", change), xml.tables(good), xml.cells(good)).first()["problems"]

    p = F.col("profile")
    assert problems(p.withField("columns", F.slice(p["columns"], 2, 9))) == ["columns aren't numbered 0 to n - 1"]
    assert problems(p.withField("columns", F.transform(p["columns"], lambda c: c.withField("header", F.lit("Other"))))) == [f"column {i}: header isn't printed" for i in range(5)]
    assert problems(p.withField("columns", F.transform(p["columns"], lambda c: c.withField("property", F.lit("Colour"))))) == ["column 3: unknown property"]
    assert problems(p.withField("footnote_markers", F.transform(p["footnote_markers"], lambda m: m.withField("marker", F.lit("zz"))))) == ["marker zz isn't in the legend"] * 4
    unhandled = {(r["paper_key"], r["table_id"]): r["status"] for r in route.tables_unhandled.collect()}
    assert unhandled["10.1000/one", "t2"] == "no usable profile" and ("10.1000/one", "t1") not in unhandled


def test_mixtures(route):
    rows = {r["source_row"]: r for r in route.mixtures.filter("slug = 'one'").collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4, 8]
    assert [rows[i]["row_id"] for i in (0, 8)] == ["one:t1:0001", "one:t1:0006"]
    assert rows[1]["components"] == ["Choline chloride", "Caffeic acid", "Ethylene glycol"]
    assert rows[2]["ratio_raw"] == "6:4" and rows[2]["ratio"] == [6.0, 4.0, None] and rows[2]["ratio_flag"] == "weight_ratio" and rows[2]["components"][1] == "D/L-Proline"
    assert rows[3]["ratio_flag"] == "unstable" and rows[4]["ratio_flag"] == "unknown_ratio"
    assert [(r["source_row"], r["reason"]) for r in route.skipped_rows.filter("slug = 'one'").collect()] == [(7, "cell count did not fit the grid")]


def test_measurements(route):
    rows = {r["source_row"]: r for r in route.measurements.filter("slug = 'one'").collect()}
    assert {i: (r["value"], r["temperature_c"], r["unit"], r["plausible"]) for i, r in rows.items()} == {
        0: (1.25, 25.0, "g*cm^-3", True), 1: (1.267, 60.0, "g*cm^-3", True), 2: (0.688, 30.0, "g*cm^-3", True), 8: (9.9, 25.0, "g*cm^-3", False),
    }
    assert rows[1]["source_keys"] == ["10.5/a", "10.1000/one#ref2", "10.1000/one#ref3"] and rows[0]["measurement_key"] == "one:t1:0001:Density"
    assert [(r["source_row"], r["note"]) for r in route.skipped_cells.filter("paper_key = '10.1000/one'").collect()] == [(4, "no numeric value")]
    counted = {r["what"]: r["n"] for r in tables.tallies(route.mixtures.filter("slug = 'one'"), route.measurements.filter("slug = 'one'")).collect()}
    assert counted == {"binary": 5, "ternary": 1, "Density": 4, "away from default temperature": 2}
    assert route.fidelity().filter("problem is not null").count() == 0


def test_references(route):
    rows = {(r["paper_key"], r["ref_number"]): r for r in route.references.collect()}
    one = rows["10.1000/one", 1]
    assert (one["key"], one["authors"], one["title"], one["metadata_source"], one["title_agreement"]) == ("10.5/a", "A. Smith; B. Roe", "Density of deep solvents", "crossref", 1.0)
    assert rows["10.1000/two", 1]["key"] == "10.5/b" and rows["10.1000/one", 3]["doi"] is None
    assert {r["ref_number"] for r in route.references_todo.filter("paper_key = '10.1000/one'").collect()} == {2}
    figure = route.figures.filter("paper_key = '10.1000/one'").first()
    assert figure["cited_ref_numbers"] == [1, 2, 3] and figure["paper_doi"] == "10.1000/one" and figure["image_link"] == "img.png"


def test_claims(route):
    row = route.claims.filter("slug = 'one' and draft_pos = 0").first()
    assert (row["components"], row["components_source"], row["component_status"]) == (["Choline chloride", "Urea"], "source_text", "resolved")
    assert (row["verified"], row["quote_found"], row["refs"], row["ref_source"]) == (True, True, [1], "agreed")
    assert (row["duplicate_of"], row["duplicate_kind"], row["status"], row["row_id"]) == ("one:t1:0001:Density", "key+value", "duplicate", "P-0001")
    assert row["measurement_key"].startswith("P-one:s1:Density:Choline chloride+Urea:1.25")


def test_claim_statuses(route):
    rows = route.claims.filter("slug = 'one'").orderBy("draft_pos").collect()
    assert [r["status"] for r in rows] == [status for _, status in CLAIMS]
    assert [r["row_id"] for r in rows] == [f"P-{i:04d}" for i in range(1, 6)]


def test_invalid_responses_are_dropped_whole(spark):
    raws = [docs.prose_response(), '{"measurements": [{"value": 1}]}', '{"measurements": [', docs.prose_response({"property": "Colour"}), '{"measurements": []}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    got = df.select("i", responses.items(F.col("raw"), responses.PROSE, "measurements", responses.PROSE_KEYS, vocab.PROPERTY_NAMES).alias("x")).collect()
    assert [None if r["x"] is None else len(r["x"]) for r in sorted(got)] == [1, None, None, None, 0]


def test_quality(route):
    found = {r["check"]: r["n"] for r in route.invariants().collect()}
    assert found == {"missing_paper_key": 0, "duplicate_key": 0, "orphan_citation": 0, "dangling_measurement": 0}
    assert route.duplicates().count() >= 1
    queue = route.queue().collect()
    assert [r["priority"] for r in queue] == sorted(r["priority"] for r in queue)
    kinds = {r["priority"]: r["kind"] for r in queue}
    assert kinds == {1: "table not extracted", 2: "unresolved abbreviation", 3: "implausible value", 5: "prose value not in the text"}
    assert {r["detail"].split(" ")[0] for r in queue if r["priority"] == 2} == {"Unknownium"}
    assert all(r["paper_key"] for r in queue if r["priority"] != 2) and {r["verdict"] for r in queue} == {""}
    answers = route.papers.sparkSession.createDataFrame([("10.1000/one", "yes")], "paper_key string, correct string")
    verdict = {r["paper_key"]: r for r in quality.verdict(route.measurements, route.fidelity(), answers, sample=1, most=0.3).collect()}
    assert verdict["10.1000/one"]["accepted"] and not verdict["10.1000/two"]["accepted"]
    assert not quality.all_accepted(quality.verdict(route.measurements, route.fidelity(), answers)).first()["accepted"]


def test_graph(route):
    relations = route.relations().persist()
    nodes = graph.nodes(route.mixtures, route.measurements, route.references, route.papers.sparkSession.createDataFrame([("Urea", "57-13-6")], "name string, cas string"))
    assert all(graph.unique(df).isEmpty() for df in nodes.values())
    assert relations.filter("type = 'PART_OF' and src = 'Choline chloride' and role <> 'HBA'").isEmpty()
    found = graph.values_of("Density", relations, nodes["Measurement"])
    assert {(r["component"], r["value"]) for r in found.filter("paper = '10.5/a'").collect()} >= {("Urea", 1.25), ("Ethylene glycol", 1.267)}
    assert graph.dangling(relations.filter("type = 'REPORTED_IN'"), nodes["Paper"]).isEmpty()
    assert graph.top_sources(relations, 1).count() == 1


def test_merge_winners(spark):
    df = spark.createDataFrame([(1, 1, "a", None), (1, 2, "b", 7), (1, 3, "c", None)], "k int, seq int, name string, x int").withColumn("first_name", F.col("name"))
    row = graph.merge(df, ["k"], ["seq"], last=["name"], first=["first_name"], filled=["x"]).first()
    assert (row["name"], row["first_name"], row["x"]) == ("c", "a", 7)


def test_store(spark, tmp_path):
    base = str(tmp_path)
    one = spark.createDataFrame([("k1", "a", 1), ("k2", "b", 2)], "paper_key string, slug string, v int")
    store.write(one, base, "mixtures")
    store.write(spark.createDataFrame([("k2", "b", 9)], one.schema), base, "mixtures")
    assert sorted(r["v"] for r in store.read_all(spark, base, "mixtures").collect()) == [1, 9]
    assert [r["v"] for r in store.read_paper(spark, base, "mixtures", "b").collect()] == [9]
    with pytest.raises(ValueError, match="unknown kind"):
        store.path_for(base, "nothing")
    with pytest.raises(Exception, match="without paper_key"):
        store.write(spark.createDataFrame([(" ", "a", 1)], one.schema), base, "mixtures")
    merged = store.upsert(one, spark.createDataFrame([("k2", "b", 5)], one.schema))
    assert sorted(r["v"] for r in merged.collect()) == [1, 5]
    store.export_csv(one.limit(0), f"{base}/csv")
    assert spark.read.csv(f"{base}/csv", header=True).columns == ["paper_key", "slug", "v"]


def test_steps():
    assert pipeline.steps("table,refs") == ("refs", "table") and pipeline.steps("all") == pipeline.STEPS
    with pytest.raises(ValueError, match="unknown steps: x"):
        pipeline.steps("x")


def test_stream(spark, tmp_path, parsed):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.xml").write_text(docs.elsevier())
    good = xml.accepted(parsed)
    cards = profile.cards(xml.cells(good), xml.tables(good)).persist()
    query = ingest.start(spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "checkpoint"), lambda s: inputs(s, cards=cards))
    query.awaitTermination(180)
    assert query.exception() is None
    assert store.read_all(spark, str(tmp_path / "store"), "measurements").count() == 4


def test_store_forgets_what_a_paper_no_longer_yields(spark, tmp_path):
    base = str(tmp_path)
    one = spark.createDataFrame([("k1", "a", 1), ("k2", "b", 2)], "paper_key string, slug string, v int")
    papers = one.select("slug", "paper_key")
    store.write(one, base, "mixtures", papers)
    store.write(one.filter("slug = 'a' and v > 1"), base, "mixtures", papers.filter("slug = 'a'"))
    assert [(r["slug"], r["v"]) for r in store.read_all(spark, base, "mixtures").collect()] == [("b", 2)]
    store.write(one.limit(0), base, "mixtures", papers)
    assert store.read_all(spark, base, "mixtures").count() == 0 and store.read_paper(spark, base, "mixtures", "a").count() == 0


def test_fidelity_reads_stored_rows(route):
    stored = route.measurements.withColumn("value", F.when(F.col("source_row") == 1, F.lit(7.0)).otherwise(F.col("value")))
    stored = stored.withColumn("temperature_c", F.when(F.col("source_row") == 2, F.lit(1.0)).otherwise(F.col("temperature_c"))).withColumn("source_col", F.when(F.col("source_row") == 8, F.lit(99)).otherwise(F.col("source_col")))
    problems = {r["source_row"]: r["problem"] for r in route.fidelity(stored).filter("slug = 'one'").collect()}
    assert problems == {0: None, 1: "value differs", 2: "temperature differs", 8: "no such cell"}


def test_repeated_answers_leave_references_alone(spark, parsed):
    bibliography = xml.bibliography(xml.accepted(parsed))
    given = inputs(spark)
    twice = references.enriched(bibliography, given.searches.unionByName(given.searches), given.works.unionByName(given.works.withColumn("doi", F.lit("https://doi.org/10.5/A"))))
    assert sorted(map(str, twice.collect())) == sorted(map(str, references.enriched(bibliography, given.searches, given.works).collect()))


def test_graph_of_all_routes(spark, route):
    lookups = spark.createDataFrame([("Urea", "57-13-6", 60.06)], "name string, cas string, molecular_weight double")
    lines = spark.createDataFrame([("Urea:Density:1.3:X", "Urea", "Density", 1.3, "ok", "pubchem", "A handbook"), ("Nobody:Density:1:", "Nobody", "Density", 1.0, "ok", "pubchem", ""), ("Urea:Density:9:", "Urea", "Density", 9.0, "unverified", "pubchem", "")], "key string, name string, property string, value double, status string, source_db string, data_source string")
    lines = lines.withColumns({c: F.lit("") for c in ("unit", "pressure", "qualifier", "raw_string", "extractor")}).withColumn("temperature_c", F.lit(None).cast("double"))
    found, relations = graph.load(route.mixtures, route.measurements, route.references, lookups, route.claims, route.papers, lines)
    rows = {label: {r["key"]: r for r in df.collect()} for label, df in found.items()}
    edges = {(r["src"], r["type"], r["dst"]): r for r in relations.collect()}
    assert all(graph.unique(df).isEmpty() for df in found.values())
    # One review node for each paper that was read, the bibliography's works, and edges only between nodes.
    assert {k for k, r in rows["Paper"].items() if r["role"] == "review"} == {r["paper_key"] for r in route.papers.collect()}
    assert rows["Paper"]["10.1000/one"]["journal"] == "J. Test" and rows["Paper"]["10.5/a"]["authors"] == "A. Smith; B. Roe" and rows["Paper"]["10.5/a"]["match_score"] == 90.0
    every = {k for nodes in rows.values() for k in nodes}
    assert all(src in every and dst in every for src, _, dst in edges)
    # The accepted claim is in the graph with its sentence; tables keep the mixture that both name.
    claim = next(r for r in route.claims.collect() if r["status"] == "ok" and r["slug"] == "one")
    assert rows["Measurement"][claim["measurement_key"]]["origin"] == "prose" and rows["Measurement"][claim["measurement_key"]]["evidence"] == claim["source_text"]
    assert (claim["mixture"], "HAS_DENSITY", claim["measurement_key"]) in edges
    assert rows["Mixture"]["Choline chloride:Urea 1:2"]["origin"] == "table"
    assert (claim["mixture"], "REVIEW_PAPER", "10.1000/one") in edges
    # Component values: attributed, of known components, accepted ones only.
    assert set(rows["ComponentProperty"]) == {"Urea:Density:1.3:X"} and {k: r["kind"] for k, r in rows["Source"].items()} == {"pubchem": "database", "A handbook": "attribution"}
    assert ("Urea:Density:1.3:X", "REPORTED_IN", "A handbook") in edges and edges["Urea", "HAS_DENSITY", "Urea:Density:1.3:X"]["data_source"] == "A handbook"
    assert edges["Urea", "PART_OF", "Choline chloride:Urea 1:2"]["molar_ratio"] == 2.0 and rows["Component"]["Urea"]["molecular_weight"] == 60.06
    without = graph.load(route.mixtures, route.measurements, route.references, lookups, route.claims, route.papers, None, prose=False)[0]
    assert claim["measurement_key"] not in {r["key"] for r in without["Measurement"].collect()}


def test_prose_adds_mixtures_but_changes_none(spark, route):
    base = route.mixtures.filter("slug = 'one' and source_row = 0")
    claims = route.claims.filter("slug = 'one' and draft_pos = 0").withColumn("status", F.lit("ok"))
    own = claims.withColumn("mixture", F.lit("Only:Prose 1:1")).unionByName(claims.withColumn("mixture", base.select("mixture").first()[0] and F.lit(base.select("mixture").first()[0])))
    nodes = {r["key"]: r for r in graph.nodes(base, route.measurements.limit(0), route.references, spark.createDataFrame([], "name string, cas string"), own)["Mixture"].collect()}
    assert nodes["Only:Prose 1:1"]["origin"] == "prose" and nodes[base.first()["mixture"]]["row_id"] == "one:t1:0001"


def test_driver(spark, folder, parsed, tmp_path):
    good = xml.accepted(parsed)
    cards = profile.cards(xml.cells(good), xml.tables(good)).persist()
    asked = prose.requests(prose.chosen(xml.sections(good)), "injected", "none")
    given = dataclasses.replace(
        inputs(spark, asked, cards, docs.prose_response(*(c for c, _ in CLAIMS))),
        lines=spark.createDataFrame([("Urea", "1176", "Density", "Density", "1.32 g/cm3", "A handbook", "Urea", "Urea", "pubchem")], pipeline.LINES),
        line_responses=spark.createDataFrame([("Urea", json.dumps({"properties": [{"line": 0, "property": "Density", "value": 1.32, "unit": "g/cm3", "temperature_C": None, "pressure": "", "qualifier": "", "applies_to": ""}]}))], "name string, raw string"),
        pages=spark.createDataFrame([("Urea", "1176", "T fus 405.85 K")], pipeline.PAGES),
    )
    base = str(tmp_path)
    with pytest.raises(ValueError, match="no DOI"):
        driver.run(spark, folder, base, given, "refs")
    report = driver.run(spark, folder, base, given, "all,aliases", continue_on_error=True)
    assert report.done == list(pipeline.ORDER) and {name for name, _ in report.failed} == {"no_doi", "odd", "broken"}
    properties = {r["key"]: r["value"] for r in store.read_all(spark, base, "component_properties").filter("status = 'ok'").collect()}
    assert sorted(properties.values()) == [1.32, 132.7]
    assert store.read_all(spark, base, "components").filter("name = 'Urea'").first()["lookup_status"] == "not_found"
    assert {r["label"] for r in store.read_all(spark, base, "graph_nodes").select("label").distinct().collect()} == {"Component", "Mixture", "Paper", "Measurement", "ComponentProperty", "Source"}
    assert store.read_all(spark, base, "review_queue").filter("kind = 'table not extracted'").count() > 0
    assert store.read_all(spark, base, "acceptance").filter("mismatches > 0").count() == 0
    before = sorted(map(str, store.read_all(spark, base, "graph_relations").collect()))
    # The same run again changes nothing; a stored value that the source doesn't bear out is found.
    assert driver.run(spark, folder, base, given, "graph", continue_on_error=True).done == ["graph"]
    assert sorted(map(str, store.read_all(spark, base, "graph_relations").collect())) == before
    wrong = store.read_all(spark, base, "measurements").filter("slug = 'one'").withColumn("value", F.col("value") + 1).toPandas()
    schema = store.read_all(spark, base, "measurements").schema
    store.write(spark.createDataFrame(wrong, schema), base, "measurements")
    driver.run(spark, folder, base, given, "validate", continue_on_error=True)
    assert {r["paper_key"]: r["mismatches"] for r in store.read_all(spark, base, "acceptance").collect()}["10.1000/one"] == 4


def test_driver_passes_over_a_failing_step(spark, folder, tmp_path):
    broken = dataclasses.replace(inputs(spark), answers=spark.range(1))
    report = driver.run(spark, folder, str(tmp_path), broken, "validate,figures", continue_on_error=True)
    assert report.done == ["figures"] and [n for n, _ in report.failed][-1] == "validate"


def test_stream_resolves_by_the_whole_store(spark, tmp_path, parsed):
    """A paper without tables names a component that an earlier paper's table holds; a paper that loses its table loses its rows."""
    source, base = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    (source / "one.xml").write_text(docs.elsevier())
    good = xml.accepted(parsed)
    cards = profile.cards(xml.cells(good), xml.tables(good)).persist()
    bare = docs.elsevier("10.1000/late").replace("<caption>Solvents</caption>", "<caption>Without a profile</caption>")
    late = xml.sections(xml.accepted(xml.parse(spark.createDataFrame([("late", "late.xml", bytearray(bare.encode()))], "slug string, path string, content binary"))))
    asked = prose.requests(prose.chosen(late), "injected", "none")
    given = lambda s: inputs(s, asked, cards, docs.prose_response({"value": 1.2, "source_text": "x"}))

    def go():
        query = ingest.start(spark, str(source), base, str(tmp_path / "checkpoint"), given)
        query.awaitTermination(240)
        assert query.exception() is None

    go()
    # The late paper's own table has no profile that is accepted, so its names are known from the first paper alone.
    (source / "late.xml").write_text(bare)
    go()
    told = store.read_paper(spark, base, "sections_llm", "late").first()
    assert told["components"] == ["Choline chloride", "Urea"] and told["component_status"] == "resolved"
