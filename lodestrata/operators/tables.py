"""The table route: cells and accepted profiles to mixtures, measurements and what was skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions import keys, names, numbers, text, units, vocab
from lodestrata.functions.binding import let

TABLE = ["paper_key", "slug", "table_pos", "table_id"]
VALUE = "struct<value:double,temperature_c:double,marker:string,note:string>"


def read_value(cell: Column, profile: Column) -> Column:
    """struct(value, temperature_c, marker, note) of a property cell: only markers that the legend defines are stripped."""
    none = F.lit(None).cast("double")
    empty = F.array().cast("array<struct<marker:string,meaning:string,temperature_C:double,note:string>>")
    defs = F.filter(F.coalesce(profile["footnote_markers"], empty), lambda m: F.coalesce(m["marker"], F.lit("")) != "")
    found = F.struct(F.trim(cell["text"]).alias("raw"), cell["markers"].alias("markers"), defs.alias("defs"))

    def mark(x: Column) -> Column:
        defined = F.transform(x["defs"], lambda m: m["marker"])
        raised = F.try_element_at(F.filter(x["markers"], lambda m: F.array_contains(defined, m)), F.lit(1))
        leading = F.try_element_at(F.filter(defined, lambda m: x["raw"].startswith(m) & (F.length(m) <= 2)), F.lit(1))
        return let(F.coalesce(raised, leading, F.lit("")), lambda marker: strip(x, marker))

    def strip(x: Column, marker: Column) -> Column:
        raw = x["raw"]
        behind = F.substring(raw, F.lit(1), F.greatest(F.length(raw) - F.length(marker), F.lit(0)))
        bare = F.when(raw.startswith(marker), F.substring(raw, F.length(marker) + 1, F.length(raw))).when(raw.endswith(marker), F.when(numbers.number(behind).isNotNull(), behind).otherwise(raw)).otherwise(raw)
        return let(numbers.number(bare), lambda value: judged(x, marker, value))

    def judged(x: Column, marker: Column, value: Column) -> Column:
        raw = x["raw"]
        missing = raw.isin(*vocab.DASHES) | F.coalesce(F.array_contains(profile["missing_value_tokens"], raw), F.lit(False))
        spec = F.try_element_at(F.filter(x["defs"], lambda m: (m["marker"] == marker) & (m["meaning"] == "temperature")), F.lit(1))
        degrees = F.bround(F.coalesce(spec["temperature_C"], profile["default_temperature_C"], F.lit(vocab.DEFAULT_TEMPERATURE)), 3)
        note = F.when(missing, "not reported").when(value.isNotNull(), "").when(raw.rlike(r"\d"), "unparseable").otherwise("no numeric value")
        good = ~missing & value.isNotNull()
        return F.struct(F.when(good, value).otherwise(none).alias("value"), F.when(good, degrees).otherwise(none).alias("temperature_c"), F.when(missing, "").otherwise(marker).alias("marker"), note.alias("note"))

    return let(found, mark).cast(VALUE)


def parse_ratio(raw: Column, markers: Column) -> Column:
    """struct(raw, parts, flag): prefixes i, us and C or such markers are flags, the last of them wins."""
    t = F.trim(raw)
    has = lambda m: F.coalesce(F.array_contains(markers, m), F.lit(False))
    flag = F.when(t.startswith("C") | has("C"), "unknown_ratio").when(t.startswith("us") | has("us"), "unstable").when(t.startswith("i") | has("i"), "weight_ratio").otherwise("")
    bare = F.regexp_replace(t, "^(i|us|C-?)", "")
    return F.struct(bare.alias("raw"), numbers.ratio(bare).alias("parts"), flag.alias("flag"))


def grid_rows(cells: DataFrame) -> DataFrame:
    """A row for each body row, its cells in order."""
    one = F.struct("col", "text", "markers", "lines", "ref_ids")
    return cells.filter("part = 'body'").groupBy(*TABLE, F.col("row").alias("source_row")).agg(F.array_sort(F.collect_list(one)).alias("cells"))


def profiled_rows(cells: DataFrame, tables: DataFrame, profiles: DataFrame) -> DataFrame:
    """Body rows of relevant property tables with their profile and why a row is left out (reason; null: it is read)."""
    wanted = profiles.filter(F.col("profile.relevant") & (F.col("profile.record_type") == "des_properties")).select("paper_key", "table_id", "profile")
    ragged = tables.select("paper_key", "table_id", F.transform("ragged", lambda r: r["row"]).alias("ragged"))
    rows = grid_rows(cells).join(wanted, ["paper_key", "table_id"]).join(ragged, ["paper_key", "table_id"])
    printed = F.array_compact(F.transform("profile.columns", lambda c: text.blank_to_null(F.lower(F.trim(c["header"])))))
    filled = F.filter(F.transform("cells", lambda c: F.lower(F.trim(c["text"]))), lambda t: t != "")
    echoes = F.size(F.filter(filled, lambda t: F.array_contains(printed, t)))
    header = (F.size(filled) > 0) & (echoes >= F.greatest(F.lit(2), F.floor(F.size(filled) / 2)))
    named = F.exists(_at("component"), lambda c: F.trim(c["text"]) != "")
    reason = F.when(F.array_contains("ragged", F.col("source_row")), "cell count did not fit the grid").when(header, "header").when(~named, "no component")
    return rows.withColumn("reason", reason).drop("ragged")


def _at(role: str) -> Column:
    """The row's cells in columns of a role, in the profile's order."""
    columns = F.filter("profile.columns", lambda c: c["role"] == role)
    return F.flatten(F.transform(columns, lambda p: F.filter(F.col("cells"), lambda c: c["col"] == p["index"])))


def skipped_rows(rows: DataFrame) -> DataFrame:
    """Rows that don't fit the grid; repeated headers and rows without a component are no data and aren't listed."""
    raw = F.substring(F.array_join(F.transform("cells", lambda c: c["text"]), " | "), 1, 300)
    return rows.filter(F.col("reason") == "cell count did not fit the grid").select("paper_key", "slug", "table_id", "source_row", "reason", raw.alias("raw"))


def mixtures(rows: DataFrame, papers: DataFrame) -> DataFrame:
    """A row for each mixture, with a dense row_id over the kept rows of its table."""
    parsed = names.components(F.transform(_at("component"), lambda c: c["text"]))
    ratio_cell = F.try_element_at(_at("ratio"), F.lit(1))
    ratio = parse_ratio(F.coalesce(ratio_cell["text"], F.lit("")), ratio_cell["markers"])
    ref = F.translate(F.regexp_replace(F.coalesce(F.try_element_at(_at("reference"), F.lit(1))["text"], F.lit("")), r"^[\[\]]+|[\[\]]+$", ""), "–", "-")
    fields = F.filter("profile.columns", lambda c: c["role"] == "context")
    context = F.transform(fields, lambda p: F.concat(F.coalesce(p["context_field"], p["header"]), F.lit("="), F.coalesce(F.try_element_at(F.filter(F.col("cells"), lambda c: c["col"] == p["index"]), F.lit(1))["text"], F.lit(""))))
    n = F.row_number().over(Window.partitionBy("paper_key", "table_pos", "table_id").orderBy("source_row"))
    kept = rows.filter("reason is null").withColumn("n", n).withColumn("c", parsed).withColumn("r", ratio)
    shaped = kept.select(
        *TABLE, "source_row", F.format_string("%s:%s:%04d", "slug", "table_id", "n").alias("row_id"), F.col("c.names").alias("components"), F.col("c.flag").alias("component_flag"),
        F.col("r.raw").alias("ratio_raw"), F.col("r.parts").alias("ratio"), F.col("r.flag").alias("ratio_flag"), ref.alias("ref"), F.substring(F.array_join(context, " | "), 1, 300).alias("context"), "cells", "profile",
    )
    mixture = F.array_join(F.array_compact("components"), ":")
    return shaped.withColumn("mixture", F.when(F.col("ratio_raw") != "", F.concat(mixture, F.lit(" "), "ratio_raw")).otherwise(mixture)).join(papers.select("paper_key", "paper_doi"), "paper_key", "left")


def property_cells(rows: DataFrame) -> DataFrame:
    """A row for each property cell: what it says, read by its profile. The last column of a property counts."""
    columns = F.filter("profile.columns", lambda c: c["role"] == "property")
    each = rows.select(*[c for c in rows.columns if c != "profile"], "profile", F.posexplode(columns).alias("column_pos", "column"))
    cell = F.try_element_at(F.filter("cells", lambda c: c["col"] == F.col("column.index")), F.lit(1))
    read = each.withColumn("cell", cell).filter("cell is not null").withColumn("v", read_value(F.col("cell"), F.col("profile")))
    last = Window.partitionBy("paper_key", "table_pos", "table_id", "source_row", "column.property").orderBy(F.desc("column_pos"))
    kept = read.withColumn("k", F.row_number().over(last)).filter("k = 1")
    unit = units.unit_of(F.col("column.unit_as_written"), F.col("column.property"))
    return kept.withColumn("property", F.col("column.property")).withColumn("source_col", F.col("column.index")).withColumn("raw", F.col("cell.text")).withColumn("unit", unit).select("*", "v.*").drop("v", "k", "cell", "column", "column_pos")


def measurements(mixture_rows: DataFrame, bounds: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """A row for each value, with its keys and whether it is plausible. sources: row_id, source_keys, source_dois, unless the mixtures hold them."""
    cells = property_cells(mixture_rows).filter("value is not null")
    if sources is not None:
        cells = cells.join(sources, "row_id", "left")
    elif "source_keys" not in cells.columns:
        cells = cells.withColumn("source_keys", F.array().cast("array<string>")).withColumn("source_dois", F.array().cast("array<string>"))
    joined = cells.join(bounds.select("property", "low", "high"), "property", "left")
    doi = F.try_element_at("source_dois", F.lit(1))
    key = keys.dedup_key(F.col("components"), F.col("ratio_raw"), F.col("property"), F.col("value"), F.col("temperature_c"), doi)
    return joined.select(
        F.concat_ws(":", "row_id", "property").alias("measurement_key"), "row_id", "paper_key", "slug", "paper_doi", "table_id", "source_row", "source_col", "mixture", "components", "ratio", "property", "value", "unit",
        "temperature_c", F.lit("table").alias("source"), "ref", "source_keys", "source_dois", key.alias("dedup_key"),
        units.plausible(F.col("value"), F.col("low"), F.col("high")).alias("plausible"), units.plausibility_note(F.col("property"), F.col("value"), F.col("low"), F.col("high")).alias("plausibility_note"),
    )


def wide(measured: DataFrame) -> DataFrame:
    """A row for each mixture, a column set for each property."""
    return measured.groupBy("row_id").pivot("property", list(vocab.PROPERTY_NAMES)).agg(F.max("value").alias("value"), F.max("unit").alias("unit"), F.max("temperature_c").alias("temperature_c"), F.max("source_col").alias("source_col"))


def tallies(mixed: DataFrame, measured: DataFrame) -> DataFrame:
    """what and n: mixtures by number of components, values by property, values away from the default temperature."""
    size = F.size(F.array_compact("components"))
    kinds = F.element_at(F.create_map(F.lit(1), F.lit("single"), F.lit(2), F.lit("binary"), F.lit(3), F.lit("ternary")), F.greatest(size, F.lit(1)))
    by_size = mixed.groupBy(F.coalesce("component_flag", kinds).alias("what")).agg(F.count("*").alias("n"))
    by_property = measured.groupBy(F.col("property").alias("what")).agg(F.count("*").alias("n"))
    away = measured.filter(F.col("temperature_c") != vocab.DEFAULT_TEMPERATURE).agg(F.count("*").alias("n")).select(F.lit("away from default temperature").alias("what"), "n")
    return by_size.unionByName(by_property).unionByName(away)
