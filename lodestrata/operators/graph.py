"""The property graph as node and edge tables: merges by key, shaping, pattern matches as joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import numbers, vocab


def merge(df: DataFrame, key: list[str], order: list[str], last: list[str] = (), first: list[str] = (), filled: list[str] = ()) -> DataFrame:
    """One node for each key in order of writing: last value, first value, or last value that isn't null."""
    seq = F.struct(*order)
    aggregates = (
        [F.max_by(c, seq).alias(c) for c in last]
        + [F.min_by(c, seq).alias(c) for c in first]
        + [F.max_by(c, F.when(F.col(c).isNotNull(), seq)).alias(c) for c in filled]
    )
    return df.groupBy(*key).agg(*aggregates)


def edges(df: DataFrame, src: Column, dst: Column, kind: str | Column, *props: Column) -> DataFrame:
    """src, dst, type and properties, each edge once."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return df.select(src.alias("src"), dst.alias("dst"), kind.alias("type"), *props).filter("src is not null and dst is not null").dropDuplicates(["src", "dst", "type"])


#: What a lookup tells of a component beyond its identity.
SCALARS = ("molecular_weight", "tpsa", "xlogp", "complexity", "melting_point_c", "boiling_point_c", "density_g_cm3")


#: What is known of a paper, and the type of what isn't text.
PAPER = {"doi": "string", "title": "string", "authors": "string", "journal": "string", "volume": "string", "issue": "string", "pages": "string", "year": "string", "ref_number": "int", "match_score": "double", "title_agreement": "double"}


def _fields(df: DataFrame) -> list[Column]:
    """The fields of papers that df has, blank ones null."""
    return [(F.nullif(F.col(c), F.lit("")) if t == "string" else F.col(c)).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in PAPER.items()]


def mixture_rows(mixtures: DataFrame, claims: DataFrame | None = None) -> DataFrame:
    """Mixtures of tables and (of accepted claims) of prose in one shape: mixture, origin, seq (tables first), row_id, ratio_raw, components, ratio, paper_key, ref_numbers, source_keys."""
    fields = ["mixture", "row_id", "ratio_raw", "components", "ratio", "ratio_flag", "component_flag", "paper_key"]
    keys_of = F.col("source_keys") if "source_keys" in mixtures.columns else F.array().cast("array<string>")
    seq = F.struct(F.lit(0).alias("route"), F.coalesce("paper_key", F.lit("")).alias("paper"), "table_pos", "source_row", F.lit(0).alias("draft"))
    rows = mixtures.select(*fields, F.lit("table").alias("origin"), F.coalesce("ref", F.lit("")).alias("ref_numbers"), keys_of.alias("source_keys"), seq.alias("seq"))
    if claims is None:
        return rows.filter("mixture is not null")
    stated = numbers.ratio(F.coalesce("molar_ratio", F.lit("")))
    ratio = F.slice(F.concat(stated, F.array_repeat(F.lit(None).cast("double"), F.size("components"))), F.lit(1), F.greatest(F.size("components"), F.lit(1)))
    told = claims.filter("status = 'ok' and mixture is not null").select(
        "mixture", "row_id", F.coalesce("molar_ratio", F.lit("")).alias("ratio_raw"), "components", ratio.alias("ratio"), F.lit("").alias("ratio_flag"), F.lit(None).cast("string").alias("component_flag"), "paper_key", F.lit("prose").alias("origin"),
        F.array_join(F.transform("refs", lambda x: x.cast("string")), ",").alias("ref_numbers"), (F.col("source_keys") if "source_keys" in claims.columns else F.array().cast("array<string>")).alias("source_keys"),
        F.struct(F.lit(1).alias("route"), F.coalesce("paper_key", F.lit("")).alias("paper"), F.col("section_pos").alias("table_pos"), F.col("draft_pos").alias("source_row"), F.lit(1).alias("draft")).alias("seq"),
    )
    return rows.filter("mixture is not null").unionByName(told)


def measurement_rows(measurements: DataFrame, claims: DataFrame | None = None) -> DataFrame:
    """Values of tables and of accepted claims in one shape."""
    fields = ["key", "mixture", "property", "value", "unit", "temperature_c", "locus", "origin", "plausible", "plausibility_note", "dedup_key", "evidence", "paper_key", "source_keys", "ref_numbers"]
    rows = measurements.select(
        F.col("measurement_key").alias("key"), "mixture", "property", "value", "unit", "temperature_c", F.concat_ws(" ", "table_id", F.col("source_row").cast("string")).alias("locus"), F.lit("table").alias("origin"),
        "plausible", "plausibility_note", "dedup_key", F.lit("").alias("evidence"), "paper_key", "source_keys", F.coalesce("ref", F.lit("")).alias("ref_numbers"),
    )
    if claims is None:
        return rows.select(fields)
    told = claims.filter("status = 'ok'").select(
        F.col("measurement_key").alias("key"), "mixture", "property", "value", "unit", "temperature_c", F.trim(F.concat_ws(" ", "section_id", "section_title")).alias("locus"), F.lit("prose").alias("origin"),
        F.lit(True).alias("plausible"), F.lit("").alias("plausibility_note"), F.lit("").alias("dedup_key"), F.coalesce("source_text", F.lit("")).alias("evidence"), "paper_key",
        (F.col("source_keys") if "source_keys" in claims.columns else F.array().cast("array<string>")).alias("source_keys"), F.array_join(F.transform("refs", lambda x: x.cast("string")), ",").alias("ref_numbers"),
    )
    return rows.select(fields).unionByName(told.select(fields))


def _parts(mixed: DataFrame) -> DataFrame:
    """A row for each component of each mixture row: pos, name, its part of the ratio, role."""
    each = mixed.select("mixture", "seq", "origin", "ratio", F.posexplode("components").alias("pos", "name")).filter("name is not null")
    return each.withColumn("part", F.get("ratio", F.col("pos"))).withColumn("role", F.when(F.col("pos") == 0, F.lit("HBA")).otherwise(F.lit("HBD")))


def nodes(
    mixtures: DataFrame, measurements: DataFrame, references: DataFrame, components: DataFrame, claims: DataFrame | None = None, papers: DataFrame | None = None, properties: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Node tables by label.

    Mixtures are known by name: a table row sets what it says and the last one counts, a claim only adds mixtures that no
    table has. Components keep the route that met them first; lookups fill what they know. Papers are the bibliography,
    one review node for each paper read, and whatever is cited without an entry. properties: component properties.
    """
    mixed = mixture_rows(mixtures, claims)
    told = measurement_rows(measurements, claims)
    # By a table the last row's word counts, by prose the first.
    table_last = F.when(F.col("origin") == "table", F.col("seq"))
    said = F.struct("row_id", "ratio_raw", "ratio_flag", "component_flag", F.size("components").alias("n_components"), "origin")
    mixture = mixed.groupBy(F.col("mixture").alias("key")).agg(F.max_by(said, table_last).alias("t"), F.min_by(said, "seq").alias("p")).select("key", F.coalesce("t", "p").alias("s")).select("key", "s.*")
    component = merge(_parts(mixed).withColumn("key", F.col("name")), ["key"], ["seq", "pos"], first=["origin"]).join(components.withColumnRenamed("name", "key"), "key", "left")
    listed = references.select("key", *_fields(references), F.lit("primary").alias("role"), F.lit(0).alias("rank"), F.col("ref_number").cast("int").alias("pos"), "paper_key")
    cited = told.select(F.explode("source_keys").alias("key")).union(mixed.select(F.explode("source_keys").alias("key"))).distinct()
    every = listed.unionByName(cited.select("key", F.lit("cited").alias("role"), F.lit(-1).alias("rank"), F.lit("").alias("paper_key")), allowMissingColumns=True)
    if papers is not None:
        own = papers.withColumn("key", F.col("paper_key")).withColumn("doi", F.col("paper_doi"))
        every = every.unionByName(own.select("key", *_fields(own), F.lit("review").alias("role"), F.lit(1).alias("rank"), "paper_key"), allowMissingColumns=True)
    out = {
        "Component": component,
        "Mixture": mixture,
        "Paper": merge(every, ["key"], ["rank", "paper_key", "pos"], last=["role"], filled=list(PAPER)),
        "Measurement": merge(told.withColumn("label", F.col("property")), ["key"], ["origin", "paper_key", "mixture"], last=["label", "value", "unit", "temperature_c", "locus", "origin", "plausible", "plausibility_note", "dedup_key", "evidence"]),
    }
    if properties is not None:
        fine = properties.filter("status = 'ok'").join(component.select(F.col("key").alias("name")), "name", "left_semi")
        kept = ["name", "property", "value", "unit", "temperature_c", "pressure", "qualifier", "raw_string", "extractor"]
        out["ComponentProperty"] = merge(fine, ["key"], ["name", "property"], last=kept)
        base = fine.select(F.col("source_db").alias("key"), F.lit("database").alias("kind"), F.lit(0).alias("rank"))
        told_by = fine.filter("coalesce(data_source, '') <> ''").select(F.col("data_source").alias("key"), F.lit("attribution").alias("kind"), F.lit(1).alias("rank"))
        out["Source"] = merge(base.unionByName(told_by).filter("key is not null"), ["key"], ["rank"], first=["kind"])
    return out


_PROPS = ("role", "molar_ratio", "temperature_c", "ref_numbers", "data_source")


def _edge(df: DataFrame, src: str, dst: str, kind: str | Column, last: Column, **props: Column) -> DataFrame:
    """Each edge once, with the properties of its last row."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    types = {"molar_ratio": "double", "temperature_c": "double"}
    values = [props.get(p, F.lit(None)).cast(types.get(p, "string")).alias(p) for p in _PROPS]
    rows = df.select(F.col(src).alias("src"), F.col(dst).alias("dst"), kind.alias("type"), last.alias("__seq"), F.struct(*values).alias("__p")).filter("src is not null and dst is not null")
    return rows.groupBy("src", "dst", "type").agg(F.max_by("__p", "__seq").alias("p")).select("src", "dst", "type", "p.*")


def relations(mixtures: DataFrame, measurements: DataFrame, claims: DataFrame | None = None, components: DataFrame | None = None, properties: DataFrame | None = None) -> DataFrame:
    """All edges, each once: PART_OF (the first component accepts hydrogen bonds, others donate), HAS_<PROPERTY>, REPORTED_IN, REVIEW_PAPER.

    components (key) and properties add the components' own values, those of component nodes and with status ok only.
    """
    mixed, told = mixture_rows(mixtures, claims), measurement_rows(measurements, claims)
    parts = _parts(mixed)
    named = told.join(mixed.select("mixture").distinct(), "mixture", "left_semi")
    own = F.struct("origin", "paper_key")
    reported = named.select("key", "origin", "paper_key", "ref_numbers", F.explode("source_keys").alias("paper"))
    mixed_reported = mixed.select("mixture", "seq", "ref_numbers", F.explode("source_keys").alias("paper"))
    found = [
        _edge(parts, "name", "mixture", "PART_OF", F.col("seq"), role=F.col("role"), molar_ratio=F.col("part")),
        _edge(mixed, "mixture", "paper_key", "REVIEW_PAPER", F.col("seq")),
        _edge(mixed_reported, "mixture", "paper", "REPORTED_IN", F.col("seq"), ref_numbers=F.col("ref_numbers")),
        _edge(named, "mixture", "key", F.concat(F.lit("HAS_"), F.upper("property")), own, temperature_c=F.col("temperature_c")),
        _edge(named, "key", "paper_key", "REVIEW_PAPER", own),
        _edge(reported, "key", "paper", "REPORTED_IN", own, ref_numbers=F.col("ref_numbers")),
    ]
    if properties is not None and components is not None:
        fine = properties.filter("status = 'ok'").join(components.select(F.col("key").alias("name")), "name", "left_semi")
        told_by = fine.filter("coalesce(data_source, '') <> ''")
        found += [
            _edge(fine, "name", "key", F.concat(F.lit("HAS_"), F.upper("property")), F.col("key"), data_source=F.col("data_source")),
            _edge(fine, "key", "source_db", "REPORTED_IN", F.col("key")),
            _edge(told_by, "key", "data_source", "REPORTED_IN", F.col("key")),
        ]
    return reduce(DataFrame.unionByName, found)


def load(
    mixtures: DataFrame, measurements: DataFrame, references: DataFrame, components: DataFrame, claims: DataFrame | None, papers: DataFrame, properties: DataFrame | None, prose: bool = True
) -> tuple[dict[str, DataFrame], DataFrame]:
    """(nodes by label, relations) of the whole graph; without prose its claims stay out. Writing the result again gives the same graph."""
    told = claims if prose else None
    found = nodes(mixtures, measurements, references, components, told, papers, properties)
    return found, relations(mixtures, measurements, told, found["Component"], properties)


def long_nodes(found: dict[str, DataFrame]) -> DataFrame:
    """label, key and properties (JSON) of all nodes: one table that a graph store loads in bulk."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(label).alias("label"), "key", F.to_json(F.struct(*[c for c in df.columns if c != "key"])).alias("properties")) for label, df in found.items()])


def component_edges(rows: DataFrame, components: DataFrame) -> DataFrame:
    """HAS_<PROPERTY> edges of component properties whose component is a node and whose status is ok."""
    fine = rows.filter("status = 'ok'").join(components.select(F.col("key").alias("name")), "name", "left_semi")
    return edges(fine, F.col("name"), F.col("key"), F.concat(F.lit("HAS_"), F.upper("property")), F.lit(None).cast("string").alias("role"))


def unique(df: DataFrame, key: str = "key") -> DataFrame:
    """Keys that break uniqueness: empty for a sound node table."""
    return df.groupBy(key).count().filter("count > 1")


def dangling(relations: DataFrame, keys: DataFrame, side: str = "dst") -> DataFrame:
    """Edges whose end isn't a node."""
    return relations.join(keys.select(F.col("key").alias(side)), side, "left_anti")


def orphans(nodes: DataFrame, relations: DataFrame, key: str, side: str) -> DataFrame:
    """Nodes without an edge."""
    return nodes.join(relations.select(F.col(side).alias(key)), key, "left_anti")


def path(start: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """A chain of equi-joins: each step is (table, column so far, the table's column)."""
    out = start
    for table, mine, other in steps:
        out = out.join(table, F.col(mine) == F.col(other))
    return out


def values_of(prop: str, graph: DataFrame, values: DataFrame) -> DataFrame:
    """component, mixture, value, paper of all (Component)-[PART_OF]->(Mixture)-[HAS_x]->(value)-[REPORTED_IN]->(Paper)."""
    part = graph.filter("type = 'PART_OF'").select(F.col("src").alias("component"), F.col("dst").alias("mixture"))
    has = graph.filter(F.col("type") == f"HAS_{prop.upper()}").select(F.col("src").alias("m"), F.col("dst").alias("v"))
    told = graph.filter("type = 'REPORTED_IN'").select(F.col("src").alias("w"), F.col("dst").alias("paper"))
    chain = path(part, (has, "mixture", "m"), (told, "v", "w"), (values.select(F.col("key").alias("k"), "value"), "v", "k"))
    return chain.select("component", "mixture", "value", "paper")


def counts(**labels: DataFrame) -> DataFrame:
    """label and n of node or edge tables."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("label"), "n") for name, df in labels.items()])


def property_keys(nodes: dict[str, DataFrame]) -> dict[str, list[str]]:
    """Each label's property names."""
    return {label: [c for c in df.columns if c != "key"] for label, df in nodes.items()}


def without_doi(papers: DataFrame) -> DataFrame:
    """Papers that no lookup has given a DOI."""
    return papers.filter("doi is null")


def weak_agreement(references: DataFrame, least: float = 0.5) -> DataFrame:
    """References whose looked-up title hardly agrees with the printed one, weakest first."""
    return references.filter(F.col("title_agreement") < least).orderBy("title_agreement", "key")


def top_sources(relations: DataFrame, k: int = 6) -> DataFrame:
    """Papers that report most."""
    return relations.filter("type = 'REPORTED_IN'").groupBy("dst").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dst").limit(k)


RELATION_TYPES = ("PART_OF", "REPORTED_IN", *(f"HAS_{p.upper()}" for p in vocab.PROPERTY_NAMES))
