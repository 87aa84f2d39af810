"""Components and their properties: identity from lookups, values from attributed lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions import names, numbers, text, units, vocab
from lodestrata.operators import matching
from lodestrata.sources import responses


def looked_up(components: DataFrame, compounds: DataFrame, lines: DataFrame) -> DataFrame:
    """Each component with its compound record, and melting point, boiling point and density of its lines; the second database fills gaps only.

    compounds: name, cid, cas, ..., lookup_status; lines: name, property, string, source_db ('pubchem' or 'nist').
    """
    strings = lines.groupBy("name").agg(*[
        F.collect_list(F.when((F.col("property") == p) & (F.col("source_db") == db), F.col("string"))).alias(f"{p}_{db}")
        for p in ("Melting_point", "Boiling_point", "Density") for db in ("pubchem", "nist")
    ])
    joined = components.join(compounds, "name", "left").join(strings, "name", "left")

    def best(p: str, parse) -> Column:
        return F.coalesce(parse(F.col(f"{p}_pubchem")), parse(F.col(f"{p}_nist")))

    status = F.coalesce("lookup_status", F.lit("not_found"))
    return joined.select(
        *[c for c in joined.columns if "_pubchem" not in c and "_nist" not in c and c != "lookup_status"],
        best("Melting_point", units.temperature).alias("melting_point_c"), best("Boiling_point", units.temperature).alias("boiling_point_c"), best("Density", units.density).alias("density_g_cm3"), status.alias("lookup_status"),
    )


def todo(components: DataFrame, compounds: DataFrame) -> DataFrame:
    """Components worth a lookup that no lookup has answered, or whose lookup failed."""
    done = compounds.filter("lookup_status in ('ok', 'not_found')").select("name")
    return components.filter(names.chemical(F.col("name"))).join(done, "name", "left_anti")


def numbered(lines: DataFrame) -> DataFrame:
    """name, prompt: a component's lines as ``i. heading: string`` for the extractor, and the lines with their number."""
    n = F.row_number().over(Window.partitionBy("name").orderBy("heading", "string", "data_source")) - 1
    return lines.withColumn("line", n.cast("int"))


def prompts(lines: DataFrame) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("line", F.concat(F.col("line").cast("string"), F.lit(". "), "heading", F.lit(": "), "string").alias("t"))))
    return lines.groupBy("name").agg(F.array_join(F.transform(rows, lambda r: r["t"]), "\n").alias("prompt"))


def drafts(answered: DataFrame) -> DataFrame:
    """Items of valid responses (name, raw), with the line that each points at."""
    items = responses.items(F.col("raw"), responses.LINES, "properties", responses.LINE_KEYS, vocab.PROPERTY_NAMES)
    return answered.select("name", F.posexplode(items).alias("draft_pos", "d")).select("name", "draft_pos", "d.*")


def status() -> Column:
    """The first reason that keeps a property out, or ok."""
    unhandled = (F.col("property") == "Density") & ~F.coalesce(F.col("unit") == "g*cm^-3", F.lit(False))
    steps = (F.col("value").isNull(), ~F.col("verified"), F.coalesce("applies_to", F.lit("")) != "", unhandled)
    return matching.ladder(*zip(steps, vocab.COMPONENT_STATUSES), otherwise="ok")


def rows(drafted: DataFrame, lines: DataFrame) -> DataFrame:
    """Component properties: drafts whose line exists, in canonical units, checked against that line.

    A density without a unit, or with a condition in its place (``at`` or ``@``), is in g/cm3; temperatures become degrees C.
    """
    entry = lines.select("name", "line", "cid", "string", "data_source", "source_record", "record_title", "source_db")
    joined = drafted.join(entry, ["name", "line"])
    unit = text.squash(F.col("unit"))
    implied = (unit == "") | unit.rlike(r"(?i)^(at\b|@)")
    dense = F.col("property") == "Density"
    degrees = F.bround(units.celsius(F.col("value"), F.regexp_replace(unit, r"^[° ]+|[° ]+$", "")), 3)
    defaults = F.create_map(*[F.lit(x) for p in vocab.PROPERTIES for x in p[:2]])
    spaced = F.regexp_replace("string", r"(?<=\d)-(?=\d)", " ")
    matches = (F.coalesce("source_record", F.lit("")) == "") | (F.coalesce("record_title", F.lit("")) == "") | (names.alnum_key(F.col("source_record")) == names.alnum_key(F.col("record_title")))
    written = numbers.shortest(F.col("value"))
    out = joined.select(
        "name", "cid", "property", F.when(dense, F.col("value")).otherwise(degrees).alias("value"),
        F.when(dense, F.when(implied, F.lit("g*cm^-3")).otherwise(units.canonical(unit))).otherwise(F.try_element_at(defaults, F.col("property"))).alias("unit"),
        F.col("value").alias("value_as_written"), unit.alias("unit_as_written"), F.col("temperature_C").alias("temperature_c"),
        *[text.squash(F.col(c)).alias(c) for c in ("pressure", "qualifier", "applies_to", "data_source", "source_record")], matches.alias("source_record_matches"),
        F.coalesce("source_db", F.lit("pubchem")).alias("source_db"), F.lit("llm").alias("extractor"), F.col("string").alias("raw_string"), F.coalesce(numbers.verified(written, spaced), F.lit(False)).alias("verified"), "draft_pos",
        F.concat_ws(":", "name", "property", F.coalesce(written, F.lit("none")), F.coalesce("data_source", F.lit(""))).alias("stem"),
    ).withColumn("status", status())
    n = F.row_number().over(Window.partitionBy("stem").orderBy("name", "draft_pos"))
    return out.withColumn("n", n).withColumn("key", F.when(F.col("n") == 1, F.col("stem")).otherwise(F.concat("stem", F.lit("#"), F.col("n").cast("string")))).drop("n", "stem", "draft_pos")


def webbook_rows(pages: DataFrame) -> DataFrame:
    """Melting and boiling points that pages (name, cid, page) state in kelvin, as rows of the extractor by pattern."""
    found = pages.withColumn("w", responses.webbook(F.col("page")))
    values = F.explode(F.create_map(F.lit("Melting_point"), F.col("w.melting"), F.lit("Boiling_point"), F.col("w.boiling"))).alias("property", "value")
    return found.select("name", "cid", values).filter("value is not null").select("name", "cid", "property", "value", F.lit("C").alias("unit"), F.lit("nist").alias("source_db"), F.lit("regex").alias("extractor"), F.lit("ok").alias("status"))


def webbook_properties(pages: DataFrame) -> DataFrame:
    """The rows of webbook_rows with their keys and where they were read."""
    found = webbook_rows(pages)
    return found.withColumn("key", F.concat_ws(":", "name", "property", numbers.shortest(F.col("value")), "source_db")).withColumn("data_source", F.lit("")).withColumn("raw_string", F.lit(""))
