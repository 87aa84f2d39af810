"""References and figures: bibliography joined with lookups, aligned source lists, worklists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import citations, keys, names, text, vocab
from lodestrata.operators import matching
from lodestrata.sources import store


def enriched(bibliography: DataFrame, searches: DataFrame, works: DataFrame) -> DataFrame:
    """The bibliography with the DOI that a search found (score at least 40) and that work's fields; a lookup beats the printed text.

    searches: paper_key, ref_number, doi, score; works: doi, authors (array), title, journal, volume, issue, pages, year.
    Of several answers to one search the best score counts (ties: the least DOI), of several records of one DOI the one
    with the longest title (ties: the least), so a reference stays one row.
    """
    answers = matching.first_by(searches, ["paper_key", "ref_number"], F.desc("score"), F.asc("doi"))
    hit = answers.select("paper_key", "ref_number", F.when(F.col("score") >= vocab.MIN_MATCH_SCORE, text.doi(F.col("doi"))).alias("doi"), F.col("score").alias("match_score"))
    fields = ("authors", "title", "journal", "volume", "issue", "pages", "year")
    records = _records(works)
    known = records.select("doi", *[F.col(c).alias(f"w_{c}") for c in fields])
    joined = bibliography.join(hit, ["paper_key", "ref_number"], "left").join(known, "doi", "left")

    def best(name: str):
        own = F.col(name) if name in bibliography.columns else F.lit(None).cast("string")
        return F.coalesce(text.blank_to_null(F.col(f"w_{name}")), own, F.lit(""))

    authors = F.array_join(F.coalesce("w_authors", "authors"), "; ")
    return joined.select(
        "paper_key", "ref_number", keys.reference_key(F.col("doi"), F.col("paper_key"), F.col("ref_number")).alias("key"), text.unescape_all(authors).alias("authors"),
        text.unescape_all(best("title")).alias("title"), text.unescape_all(best("journal")).alias("journal"), *[best(c).alias(c) for c in ("volume", "issue", "pages", "year")],
        "doi", "match_score", F.when(F.col("w_title").isNotNull(), "crossref").otherwise("xml").alias("metadata_source"), names.agreement(F.col("title"), F.col("w_title")).alias("title_agreement"), "raw",
    )


def _records(works: DataFrame) -> DataFrame:
    """One record for each DOI, normalised."""
    fields = ("authors", "title", "journal", "volume", "issue", "pages", "year")
    named = works.select(text.doi(F.col("doi")).alias("doi"), *fields).filter("doi is not null")
    return matching.first_by(named, ["doi"], F.desc_nulls_last(F.length("title")), F.asc("title"), F.asc(F.to_json(F.struct(*fields))))


def reviewed(papers: DataFrame, works: DataFrame) -> DataFrame:
    """papers with their own bibliographic record where one is known: what the document itself prints comes first, the record fills gaps."""
    fields = ("authors", "title", "journal", "volume", "issue", "pages", "year")
    known = _records(works).withColumn("authors", F.array_join("authors", "; "))
    joined = papers.join(known.select(F.col("doi").alias("paper_doi"), *[F.col(c).alias(f"w_{c}") for c in fields]), "paper_doi", "left")
    filled = {c: F.coalesce(text.blank_to_null(F.col(c)), text.unescape_all(F.col(f"w_{c}"))) for c in fields}
    return joined.withColumns(filled).select(papers.columns)


def todo(bibliography: DataFrame, searches: DataFrame) -> DataFrame:
    """References that no search has answered yet, with the query to ask."""
    open_ = store.todo(bibliography, searches, ["paper_key", "ref_number"])
    query = text.squash(F.concat_ws(" ", "title", "journal", "year"))
    return open_.select("paper_key", "ref_number", query.alias("query")).filter("query <> ''")


def ordered(references: DataFrame) -> DataFrame:
    return references.orderBy("paper_key", "ref_number")


FIELDS = ["key", "doi", "authors", "title", "journal", "volume", "issue", "pages", "year"]


def sources(rows: DataFrame, key: str, references: DataFrame, refs: str = "refs") -> DataFrame:
    """For each row, its cited references' fields as lists in order of citation; numbers without an entry are left out.

    rows: key, paper_key and an array of numbers. Lists are arrays (source_<field>) and, joined by '|', source_text.
    """
    each = rows.select(key, "paper_key", F.posexplode(refs).alias("pos", "ref_number"))
    joined = each.join(references.select("paper_key", "ref_number", *FIELDS), ["paper_key", "ref_number"])
    collected = joined.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", *[F.coalesce(c, F.lit("")).alias(c) for c in FIELDS]))).alias("s"))
    return collected.select(key, *[F.transform("s", lambda x: x[c]).alias(f"source_{c}" if c.endswith("s") else f"source_{c}s") for c in FIELDS])  # noqa: B023


def cited_by(rows: DataFrame, references: DataFrame, refs: Column) -> DataFrame:
    """rows (with paper_key) and the keys and DOIs of the references that they cite, in order; numbers without an entry are left out.

    A paper's bibliography is one row, so rows meet it once and none is taken apart and put together again.
    """
    entries = references.groupBy("paper_key").agg(F.collect_list(F.struct("ref_number", "key", F.coalesce("doi", F.lit("")).alias("doi"))).alias("__entries"))
    none = F.array().cast("array<struct<ref_number:int,key:string,doi:string>>")
    met = rows.join(entries, "paper_key", "left").withColumn("__entries", F.coalesce("__entries", none)).withColumn("__refs", F.coalesce(refs, F.array().cast("array<int>")))
    hits = F.flatten(F.transform("__refs", lambda n: F.array_sort(F.filter("__entries", lambda e: e["ref_number"] == n))))
    met = met.withColumn("__hits", hits)
    return met.withColumn("source_keys", F.transform("__hits", lambda e: e["key"])).withColumn("source_dois", F.transform("__hits", lambda e: e["doi"])).drop("__entries", "__refs", "__hits")


def joined_sources(rows: DataFrame, key: str, references: DataFrame, refs: str = "refs") -> DataFrame:
    """As sources, each list one text joined by '|'."""
    each = rows.select(key, "paper_key", F.posexplode(refs).alias("pos", "ref_number")).join(references.select("paper_key", "ref_number", *FIELDS), ["paper_key", "ref_number"])
    return matching.aligned(each.withColumnRenamed("key", "source_key"), [key], ["pos"], ["source_key", *FIELDS[1:]])


def row_refs(mixtures: DataFrame) -> DataFrame:
    """row_id, paper_key and the numbers in a row's reference cell."""
    return mixtures.select("row_id", "paper_key", citations.expand(F.col("ref")).alias("refs"))


def figures(found: DataFrame) -> DataFrame:
    """A worklist of figures with the references that their captions cite."""
    return found.select(
        "paper_key", "figure_id", "label", "caption", citations.cited(F.col("caption")).alias("cited_ref_numbers"), "image_link", text.doi(F.col("paper_doi")).alias("paper_doi"),
        F.lit("needs_human").alias("status"), F.lit("").alias("tool"), F.lit("").alias("extracted_csv"),
    )
