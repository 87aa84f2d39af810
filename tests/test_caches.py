"""Files of earlier runs: CSV tables, JSON caches, and the first route that fetched a document."""

import json

from pyspark.sql import functions as F

from lodestrata.functions import units
from lodestrata.operators import profile
from lodestrata.sources import caches
from tests import documents as docs


def test_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('name,value,n,extra\n"Urea, pure",1.5,3,x\n nan ,NaN,,y\n"two\nlines",abc,7,z\n"say ""hi""",-2e3,x,\n')
    got = [tuple(r) for r in caches.csv(spark, str(path), "name string, value double, n int, absent string").collect()]
    assert got == [("Urea, pure", 1.5, 3, None), (None, None, None, None), ("two\nlines", None, 7, None), ('say "hi"', -2000.0, None, None)]
    path.write_text("name,value\n")
    assert caches.csv(spark, str(path), "name string, value double").collect() == []


def test_references(spark, tmp_path):
    path = tmp_path / "refs.json"
    record = {"doi": "https://doi.org/10.1/A", "match_score": 77.5, "authors": ["A. B"], "title": "T", "journal": "J", "volume": "1", "issue": None, "pages": "2", "year": "2001"}
    path.write_text(json.dumps({"1": record, "7": {"doi": None, "match_score": 3.0}, "__note": {}}))
    searches, works = caches.references(spark, str(path), "p")
    assert {(r["paper_key"], r["ref_number"], r["doi"], r["score"]) for r in searches.collect()} == {("p", 1, "10.1/a", 77.5), ("p", 7, None, 3.0)}
    assert [(r["title"], r["authors"]) for r in works.collect()] == [("T", ["A. B"])]


def test_compounds(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"Urea": {"cid": "1176", "tpsa": 69.1, "lookup_status": "ok"}, "Old": {"cid": "2", "lookup_status": "ok"}, "None": {"lookup_status": "not_found"}}))
    assert {r["name"]: r["lookup_status"] for r in caches.compounds(spark, str(path)).collect()} == {"Urea": "ok", "Old": "stale", "None": "not_found"}


def test_profiles(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text(json.dumps({"t1": {"card_hash": "h", "source": "human", "profile": docs.PROFILE}, "t2": {"card_hash": "g", "profile": docs.PROFILE}, "t3": {"card_hash": "x"}}))
    got = {r["table_id"]: r for r in caches.profiles(spark, str(path), "p", profile.PROFILE).collect()}
    assert {k: (r["paper_key"], r["card_hash"], r["source"]) for k, r in got.items()} == {"t1": ("p", "h", "human"), "t2": ("p", "g", "llm")}
    assert got["t1"]["profile"]["columns"][3]["property"] == "Density" and got["t1"]["profile"]["footnote_markers"][0]["temperature_C"] == 30.0


def test_fetched(spark):
    whole, stub = b"<doc><ce:sections>" + b"x" * 30_000, b"<doc/>"
    rows = [("10.1/a", "crossref", 200, stub), ("10.1/a", "elsevier", 200, whole), ("10.1/a", "unpaywall", 200, whole), ("10.1/b", "crossref", 403, None), ("S0001", "elsevier", 200, whole), ("S0001", "crossref", 200, whole), ("10.1/c", "crossref", 200, b"y" * 30_000)]
    wanted = spark.createDataFrame([("10.1/a",), ("10.1/b",), ("10.1/c",), ("S0001",)], "identifier string")
    got = {r["identifier"]: r for r in caches.fetched(wanted, spark.createDataFrame(rows, "identifier string, route string, status int, content binary")).collect()}
    assert {k: r["route"] for k, r in got.items()} == {"10.1/a": "elsevier", "10.1/b": None, "10.1/c": None, "S0001": "elsevier"}
    assert bytes(got["10.1/a"]["content"]) == whole and got["10.1/b"]["note"] == "crossref: 403; elsevier: not tried; unpaywall: not tried"


def test_registry_strings(spark):
    rows = [("Melting Point", "133-135 °C"), ("melting point", "-12.5 °C Press: 760 Torr"), ("Boiling Point", ">300 °C"), ("Density", "1.24 g/cm3 Temp: 20 °C"), ("Density", "1.5 x 10 g/cm3 note"), ("Odour", "1 x"), ("Density", "1.2")]
    df = spark.createDataFrame(rows, "name string, stated string")
    got = [r["v"] and tuple(r["v"]) for r in df.select(units.cas_property(F.col("name"), F.col("stated")).alias("v")).collect()]
    assert got == [
        ("melting point", 134.0, "°C", ""), ("melting point", -12.5, "°C", "Press: 760 Torr"), ("boiling point", None, "°C", ""), ("density", 1.24, "g/cm3", "Temp: 20 °C"), ("density", 15.0, "g/cm3", "note"), None, ("density", 1.2, None, ""),
    ]
