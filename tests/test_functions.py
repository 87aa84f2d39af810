"""Column functions on the vectors of the data model."""

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import citations, keys, names, numbers, text, units


@pytest.fixture
def one(spark):
    def run(column):
        return spark.range(1).select(column.alias("x")).first()["x"]

    return run


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize(("raw", "want"), [("1.25", 1.25), ("1,539", 1539.0), ("−11.06", -11.06), ("–", None), ("", None), ("0.688d", None), ("0x1p3", None), ("nan", None), ("1. 2201", None), ("1e3", 1000.0), (None, None)])
def test_number(one, raw, want):
    assert one(numbers.number(lit(raw).cast("string"))) == want


@pytest.mark.parametrize(("raw", "want"), [("1:2", [1.0, 2.0, None]), ("1:1:1:4", [1.0, 1.0, 1.0]), ("a:2", [None, 2.0, None]), ("", [None, None, None])])
def test_ratio(one, raw, want):
    assert one(numbers.ratio(lit(raw))) == want


@pytest.mark.parametrize(("raw", "want"), [("1.20", "1.2"), ("750.0", "750"), ("750", "750"), ("0", "0"), ("", "0")])
def test_normal(one, raw, want):
    assert one(numbers.normal(lit(raw))) == want


def test_numbers_in_and_verified(one):
    assert sorted(one(numbers.numbers_in(lit("at −11.06 and 1.20, 1.2")))) == ["-11.06", "1.2"]
    assert one(numbers.verified(lit("1.2"), lit("has 1.20 g")))
    assert not one(numbers.verified(lit("12"), lit("has 1.20 g")))


@pytest.mark.parametrize(("value", "want"), [(1.5, "1.5"), (1e-5, "1e-05"), (123456.7, "123457"), (2.0, "2")])
def test_general(one, value, want):
    assert one(numbers.general(lit(value))) == want


@pytest.mark.parametrize(("raw", "want"), [("1,26-28", [1, 26, 27, 28]), ("3-1,x,4", [4]), ("2,2", [2, 2]), ("1–3", [1, 2, 3]), ("", []), (None, [])])
def test_expand(one, raw, want):
    assert one(citations.expand(lit(raw).cast("string"))) == want


def test_cited_near_and_harvest(one):
    assert one(citations.cited(lit("see [1, 2–3] and [3], not [a]"))) == [1, 2, 3]
    assert one(citations.near(lit(23.5), lit("ChAc:EG (1:2) 23.5 °C [113], later 23.51 [7]"))) == [113]
    assert one(citations.near(lit(None).cast("double"), lit("x"))) == []
    a, b, none = F.array(lit(1), lit(2)), F.array(lit(2)), F.array().cast("array<int>")
    assert one(citations.harvest(a, b)).asDict() == {"refs": [2], "how": "agreed"}
    assert one(citations.harvest(a, none))["how"] == "text"
    assert one(citations.harvest(none, b))["how"] == "llm"
    assert one(citations.harvest(none, none)).asDict() == {"refs": [], "how": "none"}


def test_text(one):
    assert one(text.squash(lit(" a  b\n c "))) == "a b c"
    assert one(text.doi(lit(" https://dx.doi.org/10.1/AB "))) == "10.1/ab"
    assert one(text.doi(lit("doi: 10.1/AB"))) == "10.1/ab"
    assert one(text.slug(lit("file:/x/y/my paper(1).v2.xml"))) == "my_paper_1_.v2"
    assert one(text.unescape(lit("a &amp;lt; b"))) == "a &lt; b"
    assert one(text.unescape_all(lit("caf&eacute; &#233;"))) == "café é"


@pytest.mark.parametrize(("raw", "want"), [("  g/cm3", "g*cm^-3"), ("mPa s", "mPa*s"), ("g/cu m", "g/cu m"), ("g cm−3", "g*cm^-3"), (" ", None), (None, None), ("°C", "C")])
def test_canonical_unit(one, raw, want):
    assert one(units.canonical(lit(raw).cast("string"))) == want


@pytest.mark.parametrize(("strings", "want"), [(["none", "320 °F"], 160.0), (["133 - 135 °C"], 134.0), (["300 K"], 26.85), (["none"], None), ([], None)])
def test_temperature(one, strings, want):
    got = one(units.temperature(F.array(*[lit(s) for s in strings]).cast("array<string>")))
    assert got == pytest.approx(want)


def test_density_and_conversion(one):
    assert one(units.density(F.array(lit("x"), lit("1.24 g/cu cm")))) == 1.24
    assert one(units.convert(lit("Viscosity"), lit(2.0), lit("Pa s"))).asDict() == {"value": 2000.0, "unit": "mPa*s"}
    assert one(units.convert(lit("Viscosity"), lit(1.0), lit("poise")))["value"] == 100.0
    assert one(units.convert(lit("Density"), lit(1000.0), lit("kg/m3")))["value"] == 1.0
    assert one(units.convert(lit("Melting_point"), lit(300.15), lit("K")))["value"] == pytest.approx(27.0)
    assert one(units.convert(lit("Density"), lit(1.0), lit("lb/gal"))) is None


def test_components(one):
    cells = lambda *x: F.array(*[lit(c) for c in x])
    assert one(names.components(cells("Caffeic acid/Ethylene glycol", " ", "Urea")))["names"] == ["Caffeic acid", "Ethylene glycol", "Urea"]
    assert one(names.components(cells("D/L-Proline"))).asDict() == {"names": ["D/L-Proline", None, None], "flag": None}
    assert one(names.components(cells("aaa", "bbb", "ccc", "ddd")))["flag"] == "quaternary+"


def test_name_keys(one):
    assert one(names.norm_key(lit(" Choline  acetate (ChAc) "))) == "choline acetate"
    assert one(names.alnum_key(lit("Diethanol amine"))) == "diethanolamine"
    assert one(names.trailing_abbreviation(lit("choline acetate (ChAc)"))) == "chac"
    for name, want in (("1,5-pentanediol", True), ("Amino acids", False), ("HBD", False), ("RCl", False), (None, False)):
        assert one(names.chemical(lit(name).cast("string"))) is want


def test_agreement(one):
    assert one(names.agreement(lit("Density of deep solvents"), lit("density solvents"))) == 0.667
    assert one(names.agreement(lit("a of"), lit("density"))) is None


@pytest.mark.parametrize(("before", "abbr", "want"), [("the tetraethylammonium bromide", "TEAB", "tetraethylammonium bromide"), ("choline acetate", "ChAc", "choline acetate"), ("abc", "XY", None), ("x", "[]", None)])
def test_spelled_out(before, abbr, want):
    assert names.spelled_out(before, abbr) == want


def test_definitions_and_clauses(one):
    found = one(names.definitions(lit("We used tetraethylammonium bromide (TEAB). Deep solvents (DES) differ. Tetraethylammonium bromide (TEAB).")))
    assert [(d["abbr"], d["status"]) for d in found] == [("TEAB", "candidate"), ("DES", "not_a_compound")]
    stated = one(names.clauses(lit("TEAB-Chloroacetic acid (1:2, -79.2 C) [1] < ChCl:1,3-pentanediol (1:1) is low")))
    assert [c["tokens"] for c in stated] == [["TEAB", "Chloroacetic acid"], ["ChCl", "1,3-pentanediol"]]
    assert one(names.clauses(lit("acetate (18 C) > Cl- (12 C)"))) == []


def test_keys(spark, one):
    args = [F.array(lit("Urea"), lit("ChCl"), lit(None).cast("string")), lit("1:2"), lit("Density"), lit(1.25), lit(25.0), lit("10.1/A")]
    other = [F.array(lit("chcl"), lit("urea ")), lit("1:2"), lit("Density"), lit(1.2500000001), lit(25.0), lit("10.1/a")]
    assert one(keys.dedup_key(*args)) == one(keys.dedup_key(*other))
    assert one(keys.paper_key(lit(""), lit("s"))) == "xml:s"
    assert one(keys.reference_key(lit(None).cast("string"), lit("10.1/a"), lit(7))) == "10.1/a#ref7"
    with pytest.raises(Exception, match="paper's key"):
        one(keys.reference_key(lit(None).cast("string"), lit(""), lit(7)))


def test_windows(one):
    found = sorted((w["rank"], w["name"]) for w in one(names.windows(lit(" For ChCl;"))))
    assert [n for _, n in found] == ["For ChCl", "For ChCl", "For", "ChCl"]
    assert one(names.windows(lit("12"))) == []
