"""Table profiles: the card a profile is made from, its validation, and which profile of a table counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import keys, numbers, vocab
from lodestrata.sources import store

PROFILE = (
    "struct<relevant:boolean,record_type:string,reason:string,header_row_count:int,"
    "columns:array<struct<index:int,header:string,role:string,property:string,unit_as_written:string,component_role:string,context_field:string,multi_valued:boolean>>,"
    "footnote_markers:array<struct<marker:string,meaning:string,temperature_C:double,note:string>>,"
    "missing_value_tokens:array<string>,default_temperature_C:double>"
)
SAMPLE_ROWS = 250
LEAST_FILLED = 5
NUMERIC_SHARE = 0.5


def cards(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """card (text) and card_hash of each table: caption, legend, header rows, and the first three, middle and last body rows."""
    rows = cells.groupBy("paper_key", "table_id", "part", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda c: c["text"]), " | ").alias("line"))
    known = tables.select("paper_key", "table_id", "label", "caption", "footnotes", "n_rows")
    joined = rows.join(known, ["paper_key", "table_id"])
    chosen = (F.col("part") == "header") | F.col("row").isin(0, 1, 2) | (F.col("row") == F.floor(F.col("n_rows") / 2)) | (F.col("row") == F.col("n_rows") - 1)
    order = F.struct((F.col("part") != "header").alias("body"), "row", "line")
    lines = joined.filter(chosen).groupBy("paper_key", "table_id", "label", "caption", "footnotes").agg(F.array_sort(F.collect_list(order)).alias("lines"))
    card = F.concat_ws("\n", F.concat_ws(" ", "label", "caption"), F.concat(F.lit("Legend: "), "footnotes"), F.array_join(F.transform("lines", lambda r: r["line"]), "\n"))
    return lines.select("paper_key", "table_id", card.alias("card"), keys.short_hash(card).alias("card_hash"))


def chosen(cards: DataFrame, stored: DataFrame, responses: DataFrame) -> DataFrame:
    """Each table's profile: a human's if it was made for this very card, else the response to the card, else null."""
    human = stored.filter("source = 'human'").select("paper_key", "table_id", F.col("card_hash"), F.col("profile").alias("__human"))
    answer = responses.groupBy("card_hash").agg(F.max(F.from_json("raw", PROFILE)).alias("__answer")) if "raw" in responses.columns else responses
    joined = cards.join(human, ["paper_key", "table_id", "card_hash"], "left").join(answer, "card_hash", "left")
    profile = F.coalesce("__human", "__answer")
    return joined.select("paper_key", "table_id", "card_hash", F.when(F.col("__human").isNotNull(), "human").when(profile.isNotNull(), "llm").alias("source"), profile.alias("profile"))


def headers(cells: DataFrame) -> DataFrame:
    """paper_key, table_id, col, printed: a column's header texts from top to bottom."""
    heads = cells.filter("part = 'header'").groupBy("paper_key", "table_id", "col")
    return heads.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "text"))), lambda r: r["text"]), " ").alias("printed"))


def _plain(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s()]", ""))


def numeric_share(cells: DataFrame) -> DataFrame:
    """paper_key, table_id, col, filled, share: of the first rows' cells that say something, how many hold a number."""
    body = cells.filter((F.col("part") == "body") & (F.col("row") < SAMPLE_ROWS) & ~F.trim("text").isin(*vocab.DASHES))
    has = F.size(numbers.numbers_in(F.col("text"))) > 0
    return body.groupBy("paper_key", "table_id", "col").agg(F.count("*").alias("filled"), F.avg(has.cast("int")).alias("share"))


def validated(profiles: DataFrame, tables: DataFrame, cells: DataFrame) -> DataFrame:
    """profiles with problems: an empty array means accepted. Wrong column numbers leave the other checks out."""
    known = tables.select("paper_key", "table_id", "n_columns", "footnotes", "caption")
    heads = headers(cells).join(numeric_share(cells), ["paper_key", "table_id", "col"], "full")
    per_table = heads.groupBy("paper_key", "table_id").agg(F.map_from_entries(F.collect_list(F.struct("col", F.struct(F.coalesce("printed", F.lit("")).alias("printed"), F.coalesce("filled", F.lit(0)).alias("filled"), F.coalesce("share", F.lit(0.0)).alias("share"))))).alias("seen"))
    joined = profiles.join(known, ["paper_key", "table_id"]).join(per_table, ["paper_key", "table_id"], "left")
    columns = F.col("profile.columns")
    in_order = F.array_sort(F.transform(columns, lambda c: c["index"])) == F.sequence(F.lit(0), F.greatest(F.col("n_columns") - 1, F.lit(0)))

    def column_problems(c: Column) -> Column:
        seen = F.try_element_at("seen", c["index"])
        echo = _plain(c["header"])
        is_property = c["role"] == "property"
        return F.array(
            F.when((echo != "") & ~F.coalesce(_plain(seen["printed"]).contains(echo), F.lit(False)), F.concat(F.lit("column "), c["index"].cast("string"), F.lit(": header isn't printed"))),
            F.when(is_property & ~F.coalesce(c["property"].isin(*vocab.PROPERTY_NAMES), F.lit(False)), F.concat(F.lit("column "), c["index"].cast("string"), F.lit(": unknown property"))),
            F.when(is_property & (F.coalesce(seen["filled"], F.lit(0)) >= LEAST_FILLED) & (seen["share"] < NUMERIC_SHARE), F.concat(F.lit("column "), c["index"].cast("string"), F.lit(": hardly any numbers"))),
        )

    legend = F.concat_ws(" ", "footnotes", "caption")
    marks = F.transform("profile.footnote_markers", lambda m: F.when(~legend.contains(m["marker"]), F.concat(F.lit("marker "), m["marker"], F.lit(" isn't in the legend"))))
    detail = F.array_compact(F.concat(F.flatten(F.transform(columns, column_problems)), marks))
    problems = (
        F.when(F.col("profile").isNull() | columns.isNull(), F.array(F.lit("no usable profile")))
        .when(~F.coalesce(in_order, F.lit(False)), F.array(F.lit("columns aren't numbered 0 to n - 1")))
        .otherwise(detail)
    )
    return joined.withColumn("problems", problems).select(*profiles.columns, "problems")


def accepted(checked: DataFrame) -> DataFrame:
    """Profiles without problems."""
    return checked.filter(F.size("problems") == 0)


def save(profiles: DataFrame, old: DataFrame) -> DataFrame:
    """Profiles to store: what a human made stays a human's."""
    return store.keep_source(profiles.drop("source"), old.select("paper_key", "table_id", "source"), ["paper_key", "table_id"])


def unhandled(tables: DataFrame, checked: DataFrame) -> DataFrame:
    """Tables that yield no data, with the reason."""
    joined = tables.join(checked.select("paper_key", "table_id", "profile", "problems"), ["paper_key", "table_id"], "left")
    kind = F.col("profile.record_type")
    bad = F.coalesce(F.size("problems"), F.lit(-1))
    status = (
        F.when(bad < 0, F.lit("no usable profile"))
        .when(bad > 0, F.array_join("problems", "; "))
        .when(~F.col("profile.relevant"), F.concat(F.lit("profiled as not relevant: "), F.coalesce("profile.reason", F.lit(""))))
        .when(kind != "des_properties", F.concat(F.lit("record_type "), kind, F.lit(", no extractor yet")))
    )
    return joined.withColumn("status", F.substring(status, 1, 300)).filter("status is not null").select("paper_key", "table_id", "label", F.substring("caption", 1, 300).alias("caption"), "n_rows", "status")


