"""Files that earlier runs and people left: CSV tables, JSON caches by name, and documents that several routes tried to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import text
from lodestrata.operators import matching
from lodestrata.sources import responses

#: How tables write that nothing is there.
NOTHING = ("", "nan", "NaN", "None", "null")


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header, columns by name; cells that say nothing are null, also in columns of text. Cells may hold line breaks."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
    wanted = spark.createDataFrame([], schema).schema
    # try_cast: a cell that isn't of its column's type is null, as one that says nothing.
    return raw.select(*[F.when(~F.trim(f.name).isin(*NOTHING), F.col(f.name)).try_cast(f.dataType).alias(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted])


def json_map(spark: SparkSession, path: str, key: str, record: str) -> DataFrame:
    """key and the record's fields of a JSON cache (one map of records by key); keys that start with __ are comments."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,{record}>").alias("m"))
    return whole.select(F.explode("m").alias(key, "r")).filter(~F.col(key).startswith("__")).select(key, "r.*")


def references(spark: SparkSession, path: str, paper_key: str) -> tuple[DataFrame, DataFrame]:
    """(searches, works) of a cache of looked-up references: a JSON map by number."""
    fields = "struct<doi:string,match_score:double,authors:array<string>,title:string,journal:string,volume:string,issue:string,pages:string,year:string>"
    rows = json_map(spark, path, "ref_number", fields)
    searches = rows.select(F.lit(paper_key).alias("paper_key"), F.col("ref_number").cast("int").alias("ref_number"), text.doi(F.col("doi")).alias("doi"), F.col("match_score").alias("score"))
    works = rows.filter("doi is not null").select("doi", "authors", "title", "journal", "volume", "issue", "pages", "year")
    return searches, works


def compounds(spark: SparkSession, path: str) -> DataFrame:
    """A cache of looked-up compounds: a JSON map by name. Records from before scalars were kept count as not looked up."""
    fields = "struct<cid:string,cas:string,smiles:string,inchikey:string,molecular_formula:string,molecular_weight:double,tpsa:double,xlogp:double,complexity:double,lookup_status:string>"
    rows = json_map(spark, path, "name", fields)
    stale = (F.col("lookup_status") == "ok") & F.col("tpsa").isNull()
    return rows.withColumn("lookup_status", F.when(stale, "stale").otherwise(F.col("lookup_status")))


def profiles(spark: SparkSession, path: str, paper_key: str, profile: str) -> DataFrame:
    """paper_key, table_id, card_hash, source and profile (of the given type) of a file of table profiles: a JSON map by table."""
    rows = json_map(spark, path, "table_id", f"struct<card_hash:string,source:string,profile:{profile}>")
    return rows.select(F.lit(paper_key).alias("paper_key"), "table_id", "card_hash", F.coalesce("source", F.lit("llm")).alias("source"), "profile").filter("profile is not null")


#: Routes to a document, in the order in which they are tried; an item identifier has the publisher's alone.
ROUTES = ("crossref", "elsevier", "unpaywall")


def routes_of(identifier: Column) -> Column:
    """The routes worth trying for an identifier."""
    return F.when(identifier.contains("/"), F.array(*[F.lit(r) for r in ROUTES])).otherwise(F.array(F.lit("elsevier")))


def fetched(wanted: DataFrame, attempts: DataFrame) -> DataFrame:
    """identifier, route, content and note: the first route whose answer is a full text; else no route, and what each said.

    wanted: identifier; attempts: identifier, route, status, content (binary). Nothing is fetched here.
    """
    head = F.lower(F.decode(F.substring("content", 1, 400_000), "ISO-8859-1"))
    body = head.contains("<originaltext") | head.contains("<body") | head.contains("<ce:sections")
    good = F.coalesce((F.col("status") == 200) & responses.full_text(F.length("content"), body), F.lit(False))
    tried = wanted.select("identifier", F.posexplode(routes_of(F.col("identifier"))).alias("pos", "route")).join(attempts, ["identifier", "route"], "left")
    said = (
        F.when(F.col("status").isNull(), "not tried")
        .when(good, "full text")
        .when(F.col("status") == 200, F.concat(F.length("content").cast("string"), F.lit(" bytes of metadata only")))
        .otherwise(F.col("status").cast("string"))
    )
    judged = tried.withColumn("good", good).withColumn("said", F.concat(F.col("route"), F.lit(": "), said))
    first = matching.first_by(judged.filter("good"), ["identifier"], F.asc("pos")).select("identifier", "route", "content")
    notes = judged.groupBy("identifier").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "said"))), lambda x: x["said"]), "; ").alias("note"))
    return notes.join(first, "identifier", "left").select("identifier", "route", "content", "note")
