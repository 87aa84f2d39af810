"""Names of components: an index from what tables and lookups say, and resolution by lookup only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import names
from lodestrata.operators import matching


@dataclass(frozen=True)
class Index:
    """Lookup tables (k, name), each with one row a key."""

    aliases: DataFrame
    canonical: DataFrame
    alnum: DataFrame
    prose: DataFrame


def index(mixtures: DataFrame, aliases: DataFrame, lookups: DataFrame) -> Index:
    """From mixtures (components in order), an alias file (abbr, name) and lookups (name, lookup_status)."""
    used = mixtures.select(F.posexplode("components").alias("col", "name"), "paper_key", "table_pos", "source_row").filter("name is not null")
    keyed = used.withColumn("k", names.norm_key(F.col("name")))
    canonical = matching.spelling(keyed, "k", "name", ["col", "paper_key", "table_pos", "source_row"])
    loose = matching.spelling(keyed.withColumn("k", names.alnum_key(F.col("k"))).filter("k <> ''"), "k", "name", ["col", "paper_key", "table_pos", "source_row"])
    known = aliases.filter("name is not null and not ambiguous").groupBy(F.lower("abbr").alias("k")).agg(F.min("name").alias("name"))
    redirect = known.withColumn("to", names.norm_key(F.col("name"))).join(canonical.select(F.col("k").alias("to"), F.col("name").alias("busier")), "to", "left")
    found = lookups.filter("lookup_status = 'ok'").select(names.norm_key(F.col("name")).alias("k"), "name").groupBy("k").agg(F.min("name").alias("name"))
    return Index(redirect.select("k", F.coalesce("busier", "name").alias("name")), canonical, loose, found.join(canonical.select("k"), "k", "left_anti"))


def resolve(df: DataFrame, name: str, idx: Index) -> DataFrame:
    """df with resolved (null if unknown) and how: the first table that knows the name, human aliases first."""
    raw = F.trim(F.coalesce(F.col(name), F.lit("")))
    keyed = df.withColumn("__raw", F.lower(raw)).withColumn("__key", names.norm_key(raw)).withColumn("__abbr", names.trailing_abbreviation(raw)).withColumn("__loose", names.alnum_key(names.norm_key(raw)))
    steps = (("__raw", idx.aliases, "alias"), ("__key", idx.canonical, "table"), ("__abbr", idx.aliases, "alias"), ("__loose", idx.alnum, "alnum"), ("__key", idx.prose, "pubchem"))
    for i, (key, table, _) in enumerate(steps):
        keyed = keyed.join(table.select(F.col("k").alias(key), F.col("name").alias(f"__n{i}")), key, "left")
    how = matching.ladder((raw == "", "empty"), *[(F.col(f"__n{i}").isNotNull(), how) for i, (_, _, how) in enumerate(steps)], otherwise="unresolved")
    found = F.when(raw != "", F.coalesce(*[F.col(f"__n{i}") for i in range(len(steps))]))
    return keyed.select(*df.columns, found.alias("resolved"), how.alias("how"))


def resolve_lists(df: DataFrame, key: str, listed: str, idx: Index, phrases: bool = False) -> DataFrame:
    """key, resolved, unresolved (arrays in order) and status (resolved, partial or unresolved) of each row's names.

    phrases: a name may stand inside a phrase; its longest known prefix or suffix counts.
    """
    each = df.select(key, F.posexplode(listed).alias("pos", "name"))
    if phrases:
        tried = each.select(key, "pos", "name", F.explode(names.windows(F.col("name"))).alias("w")).select(key, "pos", "name", F.col("w.rank").alias("rank"), F.col("w.name").alias("part"))
        hits = resolve(tried, "part", idx).filter("resolved is not null").groupBy(key, "pos").agg(F.min_by("resolved", "rank").alias("resolved"))
        found = each.join(hits, [key, "pos"], "left")
    else:
        found = resolve(each, "name", idx)
    rows = F.array_sort(F.collect_list(F.struct("pos", "resolved", F.trim("name").alias("name"))))
    lists = found.groupBy(key).agg(rows.alias("r"))
    good = F.transform(F.filter("r", lambda x: x["resolved"].isNotNull()), lambda x: x["resolved"])
    bad = F.transform(F.filter("r", lambda x: x["resolved"].isNull()), lambda x: x["name"])
    out = df.select(key).join(lists.select(key, good.alias("resolved"), bad.alias("unresolved")), key, "left")
    none = F.array().cast("array<string>")
    out = out.select(key, F.coalesce("resolved", none).alias("resolved"), F.coalesce("unresolved", none).alias("unresolved"))
    status = matching.ladder((F.size("resolved") == 0, "unresolved"), (F.size("unresolved") > 0, "partial"), otherwise="resolved")
    return out.withColumn("component_status", status)


def distinct_components(mixtures: DataFrame) -> DataFrame:
    """Each component once, in order of first use."""
    each = mixtures.select(F.posexplode("components").alias("col", "name"), "paper_key", "table_pos", "source_row").filter("name is not null")
    return each.groupBy("name").agg(F.min(F.struct("col", "paper_key", "table_pos", "source_row")).alias("first")).orderBy("first").select("name")
