"""The prose route: claims that a model drafts from sections, checked against the text and resolved by lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions import citations, keys, names, numbers, text, units, vocab
from lodestrata.operators import matching, resolve
from lodestrata.sources import responses


def chosen(sections: DataFrame, every: bool = False) -> DataFrame:
    """Sections whose title names a property, or all."""
    return sections if every else sections.filter(F.col("title").isin(*vocab.PROPERTY_SECTIONS))


def requests(sections: DataFrame, backend: str, model: str, template: str = "{text}") -> DataFrame:
    """Sections with their prompt and the key of its response."""
    prompt = F.replace(F.lit(template), F.lit("{text}"), F.col("text"))
    return sections.withColumn("prompt", prompt).withColumn("cache_key", keys.request_key(backend=F.lit(backend), model=F.lit(model), prompt=F.col("prompt"), schema=F.lit(responses.PROSE)))


def drafts(answered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(drafts, problems): the items of valid responses (raw) in order, and sections whose response isn't valid."""
    items = responses.items(F.col("raw"), responses.PROSE, "measurements", responses.PROSE_KEYS, vocab.PROPERTY_NAMES)
    read = answered.withColumn("items", items)
    rows = read.filter("items is not null").select("paper_key", "slug", "section_pos", "section_id", "title", "text", F.posexplode("items").alias("draft_pos", "d"))
    return rows.select("paper_key", "slug", "section_pos", "section_id", "title", "text", "draft_pos", "d.*"), read.filter("items is null").select("paper_key", "section_id", F.lit("response did not validate").alias("problem"))


def formulas(rows: DataFrame, idx: resolve.Index, model: DataFrame) -> DataFrame:
    """draft_key, resolved, unresolved, component_status of the formula that each quote states; quotes without one have no row.

    Of several clauses the one with the row's number counts, then with most of the model's components, then with most known.
    """
    found = rows.select("draft_key", "value", F.posexplode(names.clauses(F.col("source_text"))).alias("clause_pos", "clause"))
    found = found.withColumn("clause_key", F.concat_ws("#", "draft_key", "clause_pos"))
    lists = resolve.resolve_lists(found.select("clause_key", F.col("clause.tokens").alias("tokens")), "clause_key", "tokens", idx, phrases=True)
    joined = found.join(lists, "clause_key").join(model.select("draft_key", F.col("resolved").alias("model")), "draft_key", "left")
    wanted = numbers.normal(numbers.shortest(F.col("value")))
    has_value = F.col("value").isNotNull() & F.coalesce(F.array_contains(numbers.numbers_in(F.col("clause.raw")), wanted), F.lit(False))
    lowered = lambda c: F.transform(c, lambda x: F.lower(x))
    overlap = F.size(F.array_intersect(lowered(F.col("resolved")), lowered(F.coalesce("model", F.array().cast("array<string>")))))
    rank = F.struct(has_value.alias("v"), overlap.alias("o"), F.size("resolved").alias("n"), (-F.col("clause_pos")).alias("p"))
    best = joined.groupBy("draft_key").agg(F.max_by(F.struct("resolved", "unresolved", "component_status"), rank).alias("best"))
    return best.select("draft_key", "best.*")


def claims(drafted: DataFrame, idx: resolve.Index) -> DataFrame:
    """Drafts with components resolved (the quote's formula before the model's list), references, unit and whether text bears them out."""
    keyed = drafted.withColumn("draft_key", F.concat_ws("/", "paper_key", F.format_string("%06d", "section_pos"), F.format_string("%06d", "draft_pos")))
    cleaned = keyed.withColumn("components", F.filter(F.transform(F.coalesce("components", F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""))
    listed = resolve.resolve_lists(cleaned, "draft_key", "components", idx)
    stated = formulas(cleaned, idx, listed)
    pick = lambda c: F.coalesce(F.col(f"s.{c}"), F.col(f"m.{c}"))
    joined = cleaned.alias("d").join(listed.alias("m"), "draft_key").join(stated.alias("s"), "draft_key", "left")
    rows = joined.select("d.*", pick("resolved").alias("resolved"), pick("unresolved").alias("unresolved"), pick("component_status").alias("component_status"), F.when(F.col("s.resolved").isNotNull(), "source_text").otherwise("llm").alias("components_source"))
    value = F.col("value")
    from_model = F.array_distinct(F.concat(citations.expand(F.coalesce("ref_numbers", F.lit(""))), citations.cited(F.coalesce("source_text", F.lit("")))))
    refs = citations.harvest(citations.near(value, F.col("text")), from_model)
    written = text.squash(F.col("source_text"))
    out = rows.withColumn("harvest", refs).select(
        "draft_key", "paper_key", "slug", "section_pos", "section_id", F.col("title").alias("section_title"), "draft_pos", F.col("resolved").alias("components"), F.col("components").alias("components_written"), "components_source",
        "unresolved", "component_status", "molar_ratio", "property", "value", units.canonical(F.col("unit")).alias("unit"), F.col("unit").alias("unit_raw"), F.col("temperature_C").alias("temperature_c"), "source_text",
        ((written != "") & text.squash(F.col("text")).contains(written)).alias("quote_found"), F.col("harvest.refs").alias("refs"), F.col("harvest.how").alias("ref_source"),
        F.coalesce(numbers.verified(numbers.shortest(value), F.col("text")), F.lit(False)).alias("verified"),
    )
    named = (F.col("component_status") == "resolved") & (F.coalesce("molar_ratio", F.lit("")) != "")
    mixture = F.when(named, F.concat(F.array_join("components", ":"), F.lit(" "), "molar_ratio"))
    key = keys.prose_key(F.col("slug"), F.col("section_id"), F.col("property"), F.col("components"), F.col("value"))
    return out.withColumn("mixture", mixture).withColumn("measurement_key", key)


def _names(c):
    return F.array_sort(F.array_distinct(F.transform(F.array_compact(c), lambda x: names.norm_key(x))))


def duplicates(rows: DataFrame, measured: DataFrame) -> DataFrame:
    """Claims with duplicate_of and duplicate_kind: the first table value close to theirs with the same components, else any of the property."""
    table = measured.select("property", F.col("value").alias("table_value"), _names(F.col("components")).alias("table_names"), "measurement_key", "paper_key", "source_row").select(
        "property", "table_value", "table_names", F.col("measurement_key").alias("table_key"), F.struct("paper_key", "source_row", "measurement_key").alias("table_pos")
    )
    mine = rows.filter("value is not null").select("draft_key", "property", "value", _names(F.col("components")).alias("own_names"))
    close = matching.close_join(mine, table, "value", "table_value", ["property"])
    same = F.col("own_names") == F.col("table_names")
    best = close.groupBy("draft_key").agg(F.min_by("table_key", F.when(same, F.col("table_pos"))).alias("with_names"), F.bool_or(same).alias("same"), F.lit(True).alias("met"))
    joined = rows.join(best, "draft_key", "left")
    kind = F.when(F.col("same"), "key+value").when(F.col("met"), "value_only")
    return joined.withColumn("duplicate_of", F.when(F.col("same"), F.col("with_names"))).withColumn("duplicate_kind", kind).drop("with_names", "same", "met")


def status() -> Column:
    """The first reason that keeps a claim out, or ok."""
    steps = (F.col("value").isNull(), ~F.col("verified"), F.col("duplicate_of").isNotNull(), F.col("component_status") != "resolved")
    return matching.ladder(*zip(steps, vocab.PROSE_STATUSES), otherwise="ok")


def finished(rows: DataFrame, measured: DataFrame) -> DataFrame:
    """Claims with duplicates marked, status and a dense number within their paper."""
    n = F.row_number().over(Window.partitionBy("paper_key").orderBy("section_pos", "draft_pos"))
    return duplicates(rows, measured).withColumn("status", status()).withColumn("row_id", F.format_string("P-%04d", n))


def tally(rows: DataFrame, column: str = "status", order: tuple[str, ...] = vocab.PROSE_STATUSES) -> DataFrame:
    """Counts in the order of the ladder."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in order]), F.col(column)), F.lit(0))
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(place)


def unresolved_names(rows: DataFrame) -> DataFrame:
    """Names that no lookup knows, most used first."""
    each = rows.select(F.explode("unresolved").alias("name")).select(F.trim("name").alias("name")).filter("name <> ''")
    return each.groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name")
