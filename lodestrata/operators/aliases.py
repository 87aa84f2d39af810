"""Abbreviations that papers define themselves, checked against the alias file and the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import names
from lodestrata.operators import matching


def harvested(sections: DataFrame) -> DataFrame:
    """Every abbreviation that a paper's sections define, the first definition of each."""
    each = sections.select("paper_key", "section_pos", "section_id", F.posexplode(names.definitions(F.col("text"))).alias("pos", "d"))
    rows = each.select("paper_key", "section_pos", "section_id", "pos", F.lower("d.abbr").alias("k"), F.col("d.abbr").alias("abbreviation"), "d.name", "d.status", "d.evidence")
    return matching.first_by(rows, ["paper_key", "k"], F.asc("section_pos"), F.asc("pos")).drop("pos")


def candidates(claims: DataFrame, measured: DataFrame) -> DataFrame:
    """Components of table rows that agree in property, value and ratio with a claim's unresolved name: name, candidate, row_ids, n.

    claims: draft_key, property, value, molar_ratio, unresolved (array).
    """
    wanted = claims.filter("value is not null").select("draft_key", "property", "value", "molar_ratio", F.explode("unresolved").alias("name"))
    table = measured.select("property", F.col("value").alias("table_value"), "row_id", "components", F.array_join(F.transform(F.array_compact("ratio"), lambda x: x.cast("string")), ":").alias("table_ratio"))
    close = matching.close_join(wanted, table, "value", "table_value", ["property"])
    stated = F.array_join(F.transform(F.split("molar_ratio", ":"), lambda x: F.coalesce(x.try_cast("double").cast("string"), x)), ":")
    agree = (F.coalesce("molar_ratio", F.lit("")) == "") | (F.col("table_ratio") == "") | (stated == F.col("table_ratio"))
    each = close.filter(agree).select("name", "row_id", F.explode(F.array_compact("components")).alias("candidate"))
    return each.groupBy("name", "candidate").agg(F.sort_array(F.collect_set("row_id")).alias("row_ids"), F.countDistinct("row_id").alias("n"))


def suggested(claims: DataFrame, measured: DataFrame, k: int = 3) -> DataFrame:
    """Unresolved names by number of uses, each with its k best candidates."""
    uses = claims.select(F.explode("unresolved").alias("name")).groupBy("name").agg(F.count("*").alias("uses"))
    ranked = matching.top(candidates(claims, measured), ["name"], k, F.desc("n"), F.asc("candidate"))
    return uses.join(ranked, "name", "left").orderBy(F.desc("uses"), "name", "rank")


def checked(found: DataFrame, aliases: DataFrame, mixtures: DataFrame, hints: DataFrame) -> DataFrame:
    """Harvested definitions with a verdict against tables and the alias file, first that applies.

    hints: name, candidate, n (see candidates); an abbreviation that tables use for another name conflicts with them.
    """
    used = mixtures.select(F.explode(F.array_compact("components")).alias("c")).select(names.norm_key(F.col("c")).alias("nk")).distinct()
    best = matching.first_by(hints, ["name"], F.desc("n"), F.asc("candidate")).select(F.lower("name").alias("k"), F.col("candidate").alias("table_candidate"))
    file = aliases.select(F.lower("abbr").alias("k"), F.col("name").alias("file_name"), F.lit(True).alias("in_file"))
    joined = found.withColumn("nk", names.norm_key(F.col("name"))).join(file, "k", "left").join(best, "k", "left").join(used.withColumn("name_in_table", F.lit(True)), "nk", "left")
    other = F.col("table_candidate").isNotNull() & (names.norm_key(F.col("table_candidate")) != F.col("nk"))
    verdict = (
        F.when(F.col("status") != "candidate", F.col("status"))
        .when(other, "conflicts_with_table")
        .when(F.col("in_file").isNull(), "new")
        .when(F.col("file_name").isNull(), "deliberately_unresolved")
        .when(names.norm_key(F.col("file_name")) == F.col("nk"), "agrees")
        .otherwise("conflicts_with_file")
    )
    return joined.withColumn("verdict", verdict).withColumn("name_in_table", F.coalesce("name_in_table", F.lit(False))).drop("k", "nk", "in_file")
