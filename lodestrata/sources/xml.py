"""Documents from a folder of XML files: a binary-file scan, one parse, and a DataFrame for each kind of content."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from lodestrata.functions import keys, text
from lodestrata.sources import dialects

CELL = "part:string,row:int,col:int,text:string,lines:array<string>,markers:array<string>,ref_ids:array<string>"
PARSED = (
    "slug string, path string,"
    "paper struct<doi:string,title:string,authors:string,journal:string,volume:string,issue:string,pages:string,year:string,dialect:string>,"
    f"tables array<struct<table_id:string,label:string,caption:string,footnotes:string,n_columns:int,n_header:int,ragged:array<struct<row:int,width:int>>,cells:array<struct<{CELL}>>>>,"
    "figures array<struct<figure_id:string,label:string,caption:string,image_link:string>>,"
    "references array<struct<ref_number:int,authors:array<string>,title:string,journal:string,year:string,raw:string>>,"
    "sections array<struct<section_id:string,title:string,text:string,paragraphs:array<string>>>,"
    "error string"
)


def files(spark: SparkSession, folder: str, slugs: list[str] | None = None, pattern: str = "*.xml") -> DataFrame:
    """slug, path and content of a folder's files, those of some slugs only if given."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    found = found.select(text.slug(F.col("path")).alias("slug"), "path", "content")
    return found.filter(F.col("slug").isin(slugs)) if slugs else found


def parse(found: DataFrame) -> DataFrame:
    """A row for each file with all that it holds; error is null unless it couldn't be parsed."""
    schema = _parse_datatype_string(PARSED)
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    names = schema.names
    known = list(dialects._DIALECTS)

    def one(slug: str, path: str, content: bytes) -> dict:
        try:
            return {"slug": slug, "path": path, "error": None} | dialects.parse(content, known)
        except (ValueError, SyntaxError) as problem:
            return {"slug": slug, "path": path, "error": str(problem)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(*values) for values in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], names)

    parsed = found.select("slug", "path", "content").mapInArrow(run, schema)
    return parsed.withColumn("paper_key", keys.paper_key(F.col("paper.doi"), F.col("slug")))


def failed(parsed: DataFrame) -> DataFrame:
    """Documents that couldn't be parsed, and those without a DOI, with the reason."""
    reason = F.coalesce("error", F.when(text.blank_to_null(F.col("paper.doi")).isNull(), F.lit("no DOI")))
    return parsed.select("slug", "path", reason.alias("reason")).filter("reason is not null")


def accepted(parsed: DataFrame) -> DataFrame:
    """Documents that parsed and have a DOI."""
    return parsed.filter(F.col("error").isNull() & text.blank_to_null(F.col("paper.doi")).isNotNull())


def papers(parsed: DataFrame) -> DataFrame:
    return parsed.select("paper_key", "slug", text.doi(F.col("paper.doi")).alias("paper_doi"), "paper.title", "paper.authors", "paper.journal", "paper.volume", "paper.issue", "paper.pages", "paper.year", "paper.dialect", "path")


def tables(parsed: DataFrame) -> DataFrame:
    """A row for each table, without its cells."""
    each = parsed.select("paper_key", "slug", F.posexplode("tables").alias("table_pos", "t"))
    return each.select("paper_key", "slug", "table_pos", "t.table_id", "t.label", "t.caption", "t.footnotes", "t.n_columns", "t.n_header", "t.ragged", F.size(F.array_distinct(F.transform(F.filter("t.cells", lambda c: c["part"] == "body"), lambda c: c["row"]))).alias("n_rows"))


def cells(parsed: DataFrame) -> DataFrame:
    """A row for each cell of each table's rectangle."""
    each = parsed.select("paper_key", "slug", F.posexplode("tables").alias("table_pos", "t"))
    return each.select("paper_key", "slug", "table_pos", "t.table_id", F.explode("t.cells").alias("c")).select("paper_key", "slug", "table_pos", "table_id", "c.*")


def figures(parsed: DataFrame) -> DataFrame:
    return parsed.select("paper_key", F.col("paper.doi").alias("paper_doi"), F.posexplode("figures").alias("figure_pos", "f")).select("paper_key", "paper_doi", "figure_pos", "f.*")


def bibliography(parsed: DataFrame) -> DataFrame:
    return parsed.select("paper_key", F.explode("references").alias("r")).select("paper_key", "r.*")


def sections(parsed: DataFrame) -> DataFrame:
    return parsed.select("paper_key", "slug", F.posexplode("sections").alias("section_pos", "s")).select("paper_key", "slug", "section_pos", "s.*")


def inventory(parsed: DataFrame) -> DataFrame:
    """What each document holds."""
    return parsed.select("paper_key", "slug", "paper.dialect", *[F.size(k).alias(f"n_{k}") for k in ("tables", "figures", "references", "sections")])


def to_json(parsed: DataFrame) -> DataFrame:
    """slug and a parsed document as JSON."""
    return parsed.select("slug", F.to_json(F.struct(*[c for c in parsed.columns if c != "slug"])).alias("json"))


def from_json(stored: DataFrame) -> DataFrame:
    """Parsed documents from their JSON."""
    fields = [f for f in _parse_datatype_string(PARSED).fields if f.name != "slug"]
    schema = ",".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ",paper_key string"
    return stored.select("slug", F.from_json("json", schema).alias("d")).select("slug", "d.*")
