"""Answers of outside services as tables: nothing here opens a connection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import text, units

WORKS = (
    "struct<author:array<struct<given:string,family:string>>,title:array<string>,`container-title`:array<string>,volume:string,issue:string,page:string,"
    "`article-number`:string,published:struct<`date-parts`:array<array<int>>>,issued:struct<`date-parts`:array<array<int>>>,DOI:string>"
)
PROSE = "struct<measurements:array<struct<components:array<string>,molar_ratio:string,property:string,value:double,unit:string,temperature_C:double,ref_numbers:string,source_text:string>>>"
PROSE_KEYS = ("components", "molar_ratio", "property", "value", "unit", "temperature_C", "ref_numbers", "source_text")
LINES = "struct<properties:array<struct<line:int,property:string,value:double,unit:string,temperature_C:double,pressure:string,qualifier:string,applies_to:string>>>"
LINE_KEYS = ("line", "property", "value", "unit", "temperature_C", "pressure", "qualifier", "applies_to")


def aliases(spark: SparkSession, path: str) -> DataFrame:
    """abbr, name, source and ambiguous of an alias file (JSON map); keys that start with __ are comments."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    rows = raw.select(F.explode("m").alias("abbr", "v")).filter(~F.col("abbr").startswith("__"))
    record = F.from_json("v", "struct<name:string,source:string,evidence:string,note:string,ambiguous:boolean>")
    plain = ~F.col("v").startswith("{")
    return rows.select(
        F.lower("abbr").alias("abbr"), F.when(plain, F.col("v")).otherwise(record["name"]).alias("name"), record["source"].alias("source"), F.coalesce(record["ambiguous"], F.lit(False)).alias("ambiguous")
    )


def works(responses: DataFrame) -> DataFrame:
    """doi, authors, title, journal, volume, issue, pages and year of bibliographic records (doi, raw)."""
    w = F.from_json("raw", WORKS)
    parts = responses.select(F.col("doi"), w.alias("w"))
    people = F.transform("w.author", lambda a: F.concat_ws(" ", a["given"], a["family"]))
    year = F.coalesce(F.expr("try_element_at(try_element_at(w.published.`date-parts`, 1), 1)"), F.expr("try_element_at(try_element_at(w.issued.`date-parts`, 1), 1)"))
    return parts.select(
        text.doi(F.col("doi")).alias("doi"), people.alias("authors"), F.try_element_at("w.title", F.lit(1)).alias("title"), F.expr("try_element_at(w.`container-title`, 1)").alias("journal"),
        "w.volume", "w.issue", F.coalesce("w.page", F.expr("w.`article-number`")).alias("pages"), year.cast("string").alias("year"),
    )


def items(raw: Column, schema: str, field: str, required: tuple[str, ...], names: tuple[str, ...]) -> Column:
    """The items of a response, or null if it doesn't validate: it must parse, and each item hold every key and a known property."""
    whole = F.from_json(raw, schema)[field]
    loose = F.from_json(raw, f"struct<{field}:array<map<string,string>>>")[field]
    keyed = F.forall(loose, lambda m: F.forall(F.array(*[F.lit(k) for k in required]), lambda k: F.map_contains_key(m, k)))
    known = F.forall(whole, lambda x: F.coalesce(x["property"].isin(*names), F.lit(False)))
    return F.when(whole.isNotNull() & loose.isNotNull() & keyed & known, whole)


def heading_strings(raw: Column, heading: str) -> Column:
    """The display strings under a heading of a nested record, at any depth: its information objects are read by their path-free pattern."""
    parts = F.split(raw, r'"TOCHeading"\s*:\s*"')
    section = F.try_element_at(F.filter(parts, lambda p: p.startswith(f'{heading}"')), F.lit(1))
    return F.regexp_extract_all(section, F.lit(r'"String"\s*:\s*"((?:[^"\\]|\\.)*)"'), F.lit(1))


CAS = r"^\d{2,7}-\d{2}-\d$"


def cas_number(synonyms: Column, most: int = 40) -> Column:
    """The first registry number among the first synonyms."""
    return F.try_element_at(F.filter(F.slice(synonyms, 1, most), lambda s: s.rlike(CAS)), F.lit(1))


def webbook(page: Column) -> Column:
    """struct(melting, boiling) in degrees C from a page that states kelvin."""
    def kelvin(name: str) -> Column:
        return F.bround(units.celsius(F.regexp_extract(page, rf"T\s*{name}\s+([0-9.]+)", 1).try_cast("double"), F.lit("K")), 3)

    return F.struct(kelvin("fus").alias("melting"), kelvin("boil").alias("boiling"))


def full_text(content_length: Column, has_body: Column, least: int = 20_000) -> Column:
    """Whether a fetched document is more than a stub."""
    return (content_length >= least) & has_body


def publisher_item(identifier: Column) -> Column:
    """Whether an identifier is a publisher item identifier rather than a DOI."""
    return F.upper(F.regexp_replace(identifier, "[^A-Za-z0-9]", "")).rlike(r"^[SB][0-9X]{15,17}$") & ~identifier.contains("/")
