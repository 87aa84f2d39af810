"""Quality of extracted data: fidelity, skipped cells, plausibility, invariants, duplicates, review queue, report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import units
from lodestrata.operators import matching


def fidelity(measurements: DataFrame, reread: DataFrame) -> DataFrame:
    """Each stored measurement with the problem that reading its cell again shows, null if none.

    reread: paper_key, table_id, source_row, source_col, value, temperature_c as derived anew from the source.
    """
    again = reread.select("paper_key", "table_id", "source_row", "source_col", F.col("value").alias("__v"), F.col("temperature_c").alias("__t"), F.lit(True).alias("__found"))
    joined = measurements.join(again, ["paper_key", "table_id", "source_row", "source_col"], "left")
    problem = (
        F.when(F.col("__found").isNull(), "no such cell")
        .when(F.col("__v").isNull() | (F.abs(F.col("__v") - F.col("value")) > 1e-9), "value differs")
        .when(~F.col("__t").eqNullSafe(F.col("temperature_c")), "temperature differs")
    )
    return joined.withColumn("problem", problem).drop("__v", "__t", "__found")


def skipped_cells(read: DataFrame) -> DataFrame:
    """Property cells with content but no value, other than those that say 'not reported'."""
    return read.filter("value is null and note not in ('', 'not reported')").select("paper_key", "table_id", "source_row", "source_col", "property", "raw", "note")


def implausible(df: DataFrame, bounds: DataFrame, prop: str = "property", value: str = "value") -> DataFrame:
    """df with plausible and note by the bounds (prop, low, high) of a dimension table."""
    joined = df.join(bounds.select(F.col(bounds.columns[0]).alias(prop), "low", "high"), prop, "left")
    args = F.col(value), F.col("low"), F.col("high")
    return joined.withColumn("plausible", units.plausible(*args)).withColumn("note", units.plausibility_note(F.col(prop), *args)).drop("low", "high")


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: how many keys occur more than once."""
    return df.groupBy(*key).count().filter("count > 1").agg(F.count("*").alias("n"))


def missing(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """One row: how many distinct keys of df the other table lacks."""
    known = other.select(F.col(other_key or key).alias(key))
    return df.select(key).distinct().join(known, key, "left_anti").agg(F.count("*").alias("n"))


def invariants(**checks: DataFrame) -> DataFrame:
    """check and n of one-row counts of violations."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("check"), F.col("n").cast("long").alias("n")) for name, df in checks.items()])


def duplicates(df: DataFrame, key: list[str], value: Column, paper: Column, row: Column) -> DataFrame:
    """Groups of several rows with one key: counts, distinct values, whether papers differ and values agree."""
    grouped = df.groupBy(*key).agg(
        F.count("*").alias("n_rows"),
        F.collect_set(paper).alias("papers"),
        F.sort_array(F.collect_set(F.bround(value, 6))).alias("values"),
        F.sort_array(F.collect_set(row)).alias("row_ids"),
    )
    groups = grouped.filter("n_rows > 1").withColumn("n_papers", F.size("papers")).drop("papers").withColumn("cross_paper", F.col("n_papers") > 1).withColumn("agree", F.size("values") <= 1)
    return groups.orderBy(F.desc("cross_paper"), "agree", *key)


def review_queue(*kinds: tuple[int, str, DataFrame]) -> DataFrame:
    """One worklist from (priority, kind, rows of detail, rows_affected and perhaps paper_key), most urgent and largest first, verdicts still open."""
    parts = [
        df.select(
            F.lit(p).alias("priority"), F.lit(k).alias("kind"), F.substring("detail", 1, 200).alias("detail"), F.col("rows_affected").cast("long").alias("rows_affected"),
            (F.col("paper_key") if "paper_key" in df.columns else F.lit("")).alias("paper_key"), F.lit("").alias("verdict"),
        )
        for p, k, df in kinds
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("priority", F.desc("rows_affected"), "kind", "detail")


def review_kinds(unhandled: DataFrame, claims: DataFrame, unresolved: DataFrame, measurements: DataFrame, references: DataFrame) -> tuple[tuple[int, str, DataFrame], ...]:
    """The kinds of the review queue: what hangs most on a decision comes first.

    unhandled: label, status, n_rows; unresolved: name, n; references: ref_number, doi, title, title_agreement.
    """
    one = F.lit(1).alias("rows_affected")
    number = lambda c: F.col(c).cast("string")
    said = F.concat_ws(" ", F.concat("mixture", F.lit(",")), "property", number("value"), "unit", F.concat(F.lit("("), "plausibility_note", F.lit(")")))
    doubtful = F.concat_ws(" ", F.lit("reference"), number("ref_number"), "doi", F.lit("agrees by"), number("title_agreement"), F.lit("with its title:"), F.substring("title", 1, 60))
    claimed = F.concat_ws(" ", F.concat(F.array_join("components", "; "), F.lit(",")), "property", number("value"))
    return (
        (1, "table not extracted", unhandled.select(F.concat_ws(": ", F.coalesce("label", "table_id"), "status").alias("detail"), F.coalesce("n_rows", F.lit(0)).alias("rows_affected"), "paper_key")),
        (2, "unresolved abbreviation", unresolved.select(F.concat("name", F.lit(" is in no table and no alias file")).alias("detail"), F.col("n").alias("rows_affected"))),
        (3, "implausible value", measurements.filter("not plausible").select(said.alias("detail"), one, "paper_key")),
        (4, "doubtful Crossref match", references.filter("title_agreement < 0.5").select(doubtful.alias("detail"), one, "paper_key")),
        (5, "prose value not in the text", claims.filter("status = 'unverified'").select(claimed.alias("detail"), one, "paper_key")),
    )


def spot_check(measurements: DataFrame, answered: DataFrame, n: int = 20, seed: int = 0) -> DataFrame:
    """Source rows still to be looked at: a keyed sample of n less those with a verdict, and their values."""
    keyed = measurements.withColumn("review_key", F.concat_ws(":", "table_id", "source_row"))
    rows = keyed.groupBy("review_key", "paper_key").agg(F.count("*").alias("n_measurements"), F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "property", "value"))), "; ").alias("values"))
    return matching.sample(rows, "review_key", n, seed).join(answered.select("review_key"), "review_key", "left_anti")


def report(rows: DataFrame, key: str, accepted: Column, least: float) -> DataFrame:
    """Rows, share accepted and whether that share reaches the least, for each key."""
    out = rows.groupBy(key).agg(F.count("*").alias("n"), F.avg(accepted.cast("int")).alias("share"))
    return out.withColumn("accepted", F.col("share") >= least)


def verdict(measurements: DataFrame, checked: DataFrame, answers: DataFrame, sample: int = 20, most: float = 0.02) -> DataFrame:
    """Per paper: totals, mismatches, implausible share, reviewed and wrong rows, and acceptance.

    A paper is accepted without mismatches and wrong verdicts, with less than ``most`` implausible, and with as many
    source rows reviewed as the sample asks for.
    """
    base = measurements.groupBy("paper_key").agg(F.count("*").alias("n"), F.countDistinct("table_id", "source_row").alias("source_rows"), F.avg((~F.col("plausible")).cast("int")).alias("implausible"))
    wrong = checked.filter("problem is not null").groupBy("paper_key").agg(F.count("*").alias("mismatches"))
    seen = answers.groupBy("paper_key").agg(F.count("*").alias("reviewed"), F.count_if(F.col("correct") == "no").alias("wrong"))
    out = base.join(wrong, "paper_key", "left").join(seen, "paper_key", "left").fillna(0, ["mismatches", "reviewed", "wrong"])
    fine = (F.col("mismatches") == 0) & (F.col("wrong") == 0) & (F.col("implausible") < most) & (F.col("reviewed") >= F.least(F.lit(sample), F.col("source_rows")))
    return out.withColumn("accepted", fine)


def all_accepted(report: DataFrame) -> DataFrame:
    """One row: whether every paper is accepted."""
    return report.agg(F.coalesce(F.bool_and("accepted"), F.lit(True)).alias("accepted"))
