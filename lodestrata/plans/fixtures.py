"""Each operator on a table of the same shape: queries over whole tables and DuckDB SQL with the same rows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import citations, keys, names, numbers, text, units
from lodestrata.operators import aliases, components, graph, matching, profile, prose, quality, resolve, tables
from lodestrata.sources import caches, store

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cell(col: int, value: Column) -> Column:
    """A body cell as the table route has it."""
    none = F.array().cast("array<string>")
    return F.struct(F.lit(col).alias("col"), value.cast("string").alias("text"), none.alias("markers"), none.alias("lines"), none.alias("ref_ids"))


def _profile(*columns: tuple[str, str]) -> Column:
    """A profile whose columns have these (role, header or property)."""
    listed = [{"index": i, "header": name, "role": role, "property": name if role == "property" else None, "unit_as_written": None, "component_role": None, "context_field": None, "multi_valued": False} for i, (role, name) in enumerate(columns)]
    whole = {"relevant": True, "record_type": "des_properties", "reason": "", "header_row_count": 1, "columns": listed, "footnote_markers": [], "missing_value_tokens": [], "default_temperature_C": None}
    return F.from_json(F.lit(json.dumps(whole)), profile.PROFILE)


def _grid(df: DataFrame, paper: Column, cells: Column, *columns: tuple[str, str]) -> DataFrame:
    """df's rows as rows of a table of a paper, with a profile."""
    named = {"paper_key": paper.cast("string"), "slug": paper.cast("string"), "table_pos": F.lit(0), "table_id": F.lit("t"), "source_row": F.lit(0), "cells": cells, "profile": _profile(*columns)}
    return df.withColumns(named)


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@_query("""
SELECT l_partkey, l_suppkey, l_returnflag, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_papers,
  count(DISTINCT l_orderkey) > 1 AS cross_paper, count(DISTINCT round(l_quantity, 6)) <= 1 AS agree
FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def q01_duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["l_partkey", "l_suppkey", "l_returnflag"]
    found = quality.duplicates(_read(spark, sf_dir, "lineitem"), key, F.col("l_quantity"), F.col("l_orderkey"), F.col("l_linenumber"))
    return found.select(*key, "n_rows", "n_papers", "cross_paper", "agree")


@_query("""
SELECT p_partkey, 'p_size' AS property, p_size::DOUBLE AS value FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part
""")
def q02_wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    cells = F.array(_cell(0, F.col("p_size")), _cell(1, F.col("p_retailprice")))
    rows = _grid(part, F.col("p_partkey"), cells, ("property", "p_size"), ("property", "p_retailprice"))
    mixed = rows.withColumns({"row_id": F.col("paper_key"), "mixture": F.lit(""), "paper_doi": F.lit(""), "components": F.array().cast("array<string>"), "ratio": F.array().cast("array<double>"), "ratio_raw": F.lit(""), "ref": F.lit("")})
    bounds = spark.createDataFrame([], "property string, low double, high double")
    return tables.measurements(mixed, bounds).select(F.col("paper_key").cast("long").alias("p_partkey"), "property", "value")


@_query("""
SELECT user_id, max(value) FILTER (event_type = 'view') AS view, max(value) FILTER (event_type = 'click') AS click,
  max(value) FILTER (event_type = 'purchase') AS purchase FROM events GROUP BY user_id
""")
def q03_long_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    names_of = {"view": "Density", "click": "Viscosity", "purchase": "Conductivity"}
    prop = F.try_element_at(F.create_map(*[F.lit(x) for pair in names_of.items() for x in pair]), F.col("event_type"))
    none = {"unit": F.lit(""), "temperature_c": F.lit(25.0), "source_col": F.lit(0)}
    measured = _read(spark, sf_dir, "events").select(F.col("user_id").alias("row_id"), F.coalesce(prop, F.lit("Other")).alias("property"), "value").withColumns(none)
    return tables.wide(measured).select(F.col("row_id").alias("user_id"), *[F.col(f"{p}_value").alias(e) for e, p in names_of.items()])


@_query(r"""
WITH t AS (SELECT o_orderkey AS id, replace(translate(trim(concat(split_part(o_orderpriority, '-', 1), CASE WHEN o_orderkey % 3 = 0 THEN 'd' WHEN o_orderkey % 3 = 1 THEN ',000.5' ELSE '' END)), '−–—', '---'), ',', '') AS x FROM orders)
SELECT id, CASE WHEN regexp_full_match(x, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN TRY_CAST(x AS DOUBLE) END AS value FROM t
""")
def q04_clean_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.when(F.col("o_orderkey") % 3 == 0, "d").when(F.col("o_orderkey") % 3 == 1, ",000.5").otherwise("")
    raw = _text(F.split_part("o_orderpriority", F.lit("-"), F.lit(1)), mark)
    return _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), numbers.number(raw).alias("value"))


@_query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 4::INT AS n_refs, (4 * l_linenumber + 9)::BIGINT AS sum_refs FROM lineitem
""")
def q05_expand_ref_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = _read(spark, sf_dir, "lineitem").select(*key, citations.expand(_text(n, ",", n + 2, "-", n + 4, ",9-3,x")).alias("refs"))
    total = F.aggregate("refs", F.lit(0).cast("long"), lambda a, x: a + x)
    return lines.select(*key, F.size("refs").alias("n_refs"), total.alias("sum_refs"))


@_query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linenumber::DOUBLE AS r1, l_quantity::INT::DOUBLE AS r2, NULL::DOUBLE AS r3 FROM lineitem
""")
def q06_split_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = numbers.ratio(_text(F.col("l_linenumber"), ":", F.col("l_quantity").cast("int")))
    return _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *[r[i].alias(f"r{i + 1}") for i in range(3)])


@_query(r"""
SELECT page_id, lower(trim(regexp_replace(url, '^(https?://(dx\.)?doi\.org/|doi:\s*)', '', 'i'))) AS norm,
  regexp_replace(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\.[^.]*$', ''), '[^A-Za-z0-9_.-]', '_', 'g') AS slug FROM pages
""")
def q07_normalise_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "pages").select("page_id", text.doi(F.col("url")).alias("norm"), text.slug(F.col("url")).alias("slug"))


_NUMBERS = r"""list_distinct(list_transform(regexp_extract_all(translate({}, '−–—', '---'), '-?\d+(?:\.\d+)?'),
  lambda x: CASE WHEN contains(x, '.') THEN coalesce(nullif(regexp_replace(regexp_replace(x, '0+$', ''), '\.$', ''), ''), '0') ELSE x END))"""


@_query(f"SELECT doc_id, len({_NUMBERS.format('text')})::INT AS n_numbers FROM documents")
def q08_numbers_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", F.size(numbers.numbers_in(F.col("text"))).alias("n_numbers"))


@_query(f"SELECT event_id, list_contains({_NUMBERS.format('props')}, (user_id % 100)::VARCHAR) AS verified FROM events")
def q09_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select("event_id", numbers.verified((F.col("user_id") % 100).cast("string"), F.col("props")).alias("verified"))


_BOUNDS = (("AUTOMOBILE", 0.0, 5000.0), ("BUILDING", -500.0, 9000.0), ("FURNITURE", 100.0, 8000.0), ("MACHINERY", -999.0, 9999.0))


@_query("""
WITH b(seg, low, high) AS (VALUES ('AUTOMOBILE', 0.0::DOUBLE, 5000.0::DOUBLE), ('BUILDING', -500.0, 9000.0), ('FURNITURE', 100.0, 8000.0), ('MACHINERY', -999.0, 9999.0))
SELECT c_custkey, coalesce(c_acctbal BETWEEN low AND high, true) AS plausible,
  CASE WHEN coalesce(c_acctbal BETWEEN low AND high, true) THEN '' ELSE concat(c_mktsegment, ' outside ', low::VARCHAR, ' to ', high::VARCHAR) END AS note
FROM customer LEFT JOIN b ON seg = c_mktsegment
""")
def q10_plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = spark.createDataFrame(_BOUNDS, "segment string, low double, high double")
    return quality.implausible(_read(spark, sf_dir, "customer"), bounds, "c_mktsegment", "c_acctbal").select("c_custkey", "plausible", "note")


@_query("""
SELECT 'duplicate_key' AS "check", (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS n
UNION ALL SELECT 'missing_key', (SELECT count(*) FROM orders WHERE o_custkey IS NULL)
UNION ALL SELECT 'orphan_citation', (SELECT count(DISTINCT o_custkey) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey))
UNION ALL SELECT 'dangling_measurement', (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey))
""")
def q11_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "lineitem")
    return quality.invariants(
        duplicate_key=quality.repeated_keys(lines, ["l_orderkey", "l_linenumber"]),
        missing_key=orders.filter("o_custkey is null").agg(F.count("*").alias("n")),
        orphan_citation=quality.missing(orders, _read(spark, sf_dir, "customer"), "o_custkey", "c_custkey"),
        dangling_measurement=quality.missing(lines, orders, "l_orderkey", "o_orderkey"),
    )


@_query("""
SELECT CASE WHEN l_quantity < 5 THEN 'qualitative' WHEN l_returnflag = 'R' THEN 'unverified' WHEN l_discount > 0.08 THEN 'duplicate'
  WHEN l_linestatus = 'O' THEN 'unresolved_components' ELSE 'ok' END AS status, count(*) AS n FROM lineitem GROUP BY ALL
""")
def q12_status_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = _read(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_quantity") >= 5, F.col("l_quantity")).alias("value"), (F.col("l_returnflag") != "R").alias("verified"), F.when(F.col("l_discount") > 0.08, "x").alias("duplicate_of"),
        F.when(F.col("l_linestatus") == "O", "partial").otherwise("resolved").alias("component_status"),
    )
    return prose.tally(claims.withColumn("status", prose.status()))


@_query("""
SELECT l_orderkey, string_agg(p_partkey::VARCHAR, '|' ORDER BY l_linenumber, l_partkey, l_suppkey) AS keys,
  string_agg(replace(p_name, '|', '/'), '|' ORDER BY l_linenumber, l_partkey, l_suppkey) AS names
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey
""")
def q13_aligned_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    joined = lines.join(_read(spark, sf_dir, "part").select(F.col("p_partkey").alias("keys"), F.col("p_name").alias("names")), F.col("keys") == F.col("l_partkey"))
    return matching.aligned(joined, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], ["keys", "names"])


@_query(r"""
WITH t AS (SELECT lower(trim(regexp_replace(trim(regexp_replace(p_brand, '\s+', ' ', 'g')), '\s*\([A-Za-z0-9\[\]\-]{1,12}\)\s*$', ''))) AS norm_key, p_name AS name, p_partkey FROM part),
c AS (SELECT norm_key, name, count(*) AS n, min(p_partkey) AS pos FROM t GROUP BY ALL)
SELECT norm_key, name FROM c QUALIFY row_number() OVER (PARTITION BY norm_key ORDER BY n DESC, pos) = 1
""")
def q14_canonical_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part").select(names.norm_key(F.col("p_brand")).alias("norm_key"), F.col("p_name").alias("name"), "p_partkey")
    return matching.spelling(part, "norm_key", "name", ["p_partkey"])


@_query("""
WITH a AS (SELECT lower(c_name) AS k, min(concat('alias ', c_custkey)) AS name FROM customer WHERE c_acctbal > 5000 GROUP BY 1),
b AS (SELECT regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS k, min(concat('table ', c_custkey)) AS name FROM customer WHERE c_mktsegment < 'C' GROUP BY 1)
SELECT c.c_custkey, coalesce(a.name, b.name) AS name, CASE WHEN a.name IS NOT NULL THEN 'alias' WHEN b.name IS NOT NULL THEN 'alnum' ELSE 'unresolved' END AS how
FROM customer c LEFT JOIN a ON a.k = lower(c.c_name) LEFT JOIN b ON b.k = regexp_replace(lower(c.c_name), '[^a-z0-9]', '', 'g')
""")
def q15_resolve_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    alias = c.filter("c_acctbal > 5000").groupBy(F.lower("c_name").alias("k")).agg(F.min(_text("alias ", F.col("c_custkey"))).alias("name"))
    table = c.filter("c_mktsegment < 'C'").groupBy(names.alnum_key(F.col("c_name")).alias("k")).agg(F.min(_text("table ", F.col("c_custkey"))).alias("name"))
    none = spark.createDataFrame([], "k string, name string")
    found = resolve.resolve(c, "c_name", resolve.Index(aliases=alias, canonical=none, alnum=table, prose=none))
    return found.select("c_custkey", F.col("resolved").alias("name"), "how")


@_query("""
SELECT s_suppkey, c_custkey, CASE WHEN s_nationkey = c_nationkey THEN 'key+value' ELSE 'value_only' END AS kind
FROM supplier JOIN customer ON abs(s_acctbal - c_acctbal) <= greatest(1e-3::DOUBLE * greatest(abs(s_acctbal), abs(c_acctbal)), 1e-9::DOUBLE)
""")
def q16_isclose_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = matching.close_join(_read(spark, sf_dir, "supplier"), _read(spark, sf_dir, "customer"), "s_acctbal", "c_acctbal")
    return pairs.select("s_suppkey", "c_custkey", F.when(F.col("s_nationkey") == F.col("c_nationkey"), "key+value").otherwise("value_only").alias("kind"))


@_query("""
WITH m AS (SELECT a.p_brand AS name, b.p_name AS candidate, count(*) AS n FROM (SELECT DISTINCT p_brand, p_size FROM part) a
  JOIN part b ON a.p_size = b.p_size GROUP BY ALL)
SELECT name, candidate, n, row_number() OVER (PARTITION BY name ORDER BY n DESC, candidate) AS rank FROM m QUALIFY rank <= 3
""")
def q17_candidates_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part").select("p_brand", "p_name", F.col("p_size").cast("double").alias("size"))
    wanted = part.select(F.col("p_brand").alias("name"), F.col("size").alias("wanted")).distinct()
    met = matching.close_join(wanted, part, "wanted", "size").groupBy("name", F.col("p_name").alias("candidate")).agg(F.count("*").alias("n"))
    return matching.top(met, ["name"], 3, F.desc("n"), F.asc("candidate"))


@_query("""
SELECT token, count(*) AS n FROM (SELECT trim(unnest(string_split(text, ','))) AS token FROM documents) WHERE token <> '' GROUP BY token
""")
def q18_unresolved_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _read(spark, sf_dir, "documents").select(F.split("text", ",").alias("unresolved"))
    return prose.unresolved_names(listed).withColumnRenamed("name", "token")


@_query(r"""
WITH w AS (SELECT item_id, list_distinct(list_filter(regexp_extract_all(lower(regexp_replace(text, '[^\x00-\x7F]', ' ', 'g')), '\w+'), lambda x: length(x) > 3)) AS words FROM benchmark)
SELECT a.item_id, round_even(len(list_intersect(a.words, b.words)) / len(a.words), 3) AS score FROM w a JOIN w b ON b.item_id = a.item_id + 1 WHERE len(a.words) > 0 AND len(b.words) > 0
""")
def q19_title_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _read(spark, sf_dir, "benchmark").withColumn("text", F.regexp_replace("text", r"[^\x00-\x7F]", " "))
    after = items.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other"))
    return items.join(after, "item_id").select("item_id", names.agreement(F.col("text"), F.col("other")).alias("score")).filter("score is not null")


@_query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, array_to_string(list_sort(list_distinct([l_linenumber, l_linenumber + 2, l_linenumber + 3, 40])), ',') AS refs FROM lineitem
""")
def q20_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    caption = _text("Densities [", n, ",", n + 2, "–", n + 3, "] and viscosities [40] (see [a])")
    refs = F.array_join(F.transform(citations.cited(caption), lambda x: x.cast("string")), ",")
    return _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", refs.alias("refs"))


@_query("""
SELECT event_id, CASE event_type WHEN 'view' THEN 'g*cm^-3' WHEN 'click' THEN 'mPa*s' WHEN 'purchase' THEN 'C' ELSE concat(event_type, ' unit') END AS unit FROM events
""")
def q21_unit_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.when(F.col("event_type") == "view", "  g/cm3").when(F.col("event_type") == "click", "mPa  s").when(F.col("event_type") == "purchase", "°C").otherwise(_text(F.col("event_type"), " unit "))
    return _read(spark, sf_dir, "events").select("event_id", units.canonical(written).alias("unit"))


@_query("""
SELECT p_partkey, round_even((p_size - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE, 3) AS celsius, p_size::DOUBLE + 1.5 AS middle FROM part
""")
def q22_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size")
    fahrenheit = units.temperature(F.array(F.lit("no number"), _text(n, " °F (NTP, 1992)")))
    middle = units.temperature(F.array(_text(n, " - ", n + 3, " °C")))
    return _read(spark, sf_dir, "part").select("p_partkey", fahrenheit.alias("celsius"), middle.alias("middle"))


@_query("SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY o_custkey")
def q23_merge_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.merge(_read(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status"), ["o_custkey"], ["o_orderdate", "o_orderkey"], last=["status"])


@_query("""
SELECT o_custkey, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS origin, arg_max(high, (o_orderdate, o_orderkey)) FILTER (high IS NOT NULL) AS high
FROM (SELECT *, CASE WHEN o_totalprice > 200000 THEN o_orderkey END AS high FROM orders) GROUP BY o_custkey
""")
def q24_merge_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").withColumn("high", F.when(F.col("o_totalprice") > 200000, F.col("o_orderkey"))).withColumnRenamed("o_orderstatus", "origin")
    return graph.merge(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], first=["origin"], filled=["high"])


@_query("""
SELECT c_name, p_name, l_quantity FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
""")
def q25_graph_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    steps = ((_read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "l_orderkey", "o_orderkey"), (_read(spark, sf_dir, "customer").select("c_custkey", "c_name"), "o_custkey", "c_custkey"), (_read(spark, sf_dir, "part").select("p_partkey", "p_name"), "l_partkey", "p_partkey"))
    return graph.path(lines, *steps).select("c_name", "p_name", "l_quantity")


@_query("""
SELECT 'nation' AS label, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'supplier', count(*) FROM supplier
""")
def q26_graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.counts(**{t: _read(spark, sf_dir, t) for t in ("nation", "region", "supplier")})


@_query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def q27_orphan_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.orphans(_read(spark, sf_dir, "customer").select("c_custkey"), _read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'"), "c_custkey", "o_custkey")


@_query("""
SELECT 1 AS priority, 'implausible' AS kind, c_mktsegment AS detail, count(*) AS rows_affected FROM customer WHERE c_acctbal < 0 GROUP BY c_mktsegment
UNION ALL SELECT 2, 'duplicate_key', l_returnflag, count(*) FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL HAVING count(*) > 1) GROUP BY l_returnflag
UNION ALL SELECT 3, 'weak_label', concat('toxic ', toxic), count(*) FROM labels WHERE quality = 0 GROUP BY toxic
""")
def q28_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = _read(spark, sf_dir, "customer").filter("c_acctbal < 0").groupBy(F.col("c_mktsegment").alias("detail")).agg(F.count("*").alias("rows_affected"))
    keyed = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), F.min("l_returnflag").alias("detail")).filter("n > 1")
    weak = _read(spark, sf_dir, "labels").filter("quality = 0").groupBy(_text("toxic ", F.col("toxic")).alias("detail")).agg(F.count("*").alias("rows_affected"))
    queue = quality.review_queue((1, "implausible", bad), (2, "duplicate_key", keyed.groupBy("detail").agg(F.count("*").alias("rows_affected"))), (3, "weak_label", weak))
    return queue.select("priority", "kind", "detail", "rows_affected")


@_query(r"""
SELECT source, avg(CASE WHEN regexp_matches(text, '\d') THEN 1 ELSE 0 END)::DOUBLE AS fraction, count(*) AS n FROM documents
WHERE trim(text) NOT IN ('–', '—', '-', '−', '') GROUP BY source
""")
def q29_numeric_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _read(spark, sf_dir, "documents").select(F.col("source").alias("paper_key"), F.lit("t").alias("table_id"), F.lit("body").alias("part"), F.lit(0).alias("row"), F.lit(0).alias("col"), "text")
    return profile.numeric_share(cells).select(F.col("paper_key").alias("source"), F.col("share").alias("fraction"), F.col("filled").alias("n"))


@_query("""
SELECT source, count(*) AS n, avg(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END)::DOUBLE AS share, avg(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) >= 0.75 AS accepted
FROM documents JOIN labels USING (doc_id) GROUP BY source
""")
def q30_report_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _read(spark, sf_dir, "documents").select("doc_id", "source").join(_read(spark, sf_dir, "labels"), "doc_id")
    return quality.report(judged, "source", (F.col("quality") == 1) & (F.col("toxic") == 0), 0.75)


@_query("SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def q31_todo_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.todo(_read(spark, sf_dir, "documents").select("doc_id"), _read(spark, sf_dir, "labels"), ["doc_id"])


@_query("""
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1])), '') AS abbr, p_name AS name FROM part
WHERE len(string_split(p_name, ' ')) BETWEEN 2 AND 5
""")
def q32_abbreviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    abbr = F.array_join(F.transform(words, lambda x: F.upper(F.substring(x, 1, 1))), "")
    part = _read(spark, sf_dir, "part").filter(F.size(words).between(2, 5)).select("p_partkey", _text(F.col("p_name"), " (", abbr, ") was used.").alias("t"))
    return part.select("p_partkey", F.explode(names.definitions(F.col("t"))).alias("d")).select("p_partkey", "d.abbr", "d.name")


@_query("""
SELECT conv_id, substr(sha256(string_agg(concat(turn, ' ', role, ' ', text), chr(10) ORDER BY turn, role, text)), 1, 16) AS sha256 FROM conversations GROUP BY conv_id
""")
def q33_card_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    card = F.array_join(F.transform(lines, lambda r: F.concat(r["turn"].cast("string"), F.lit(" "), F.coalesce(r["role"], F.lit("")), F.lit(" "), F.coalesce(r["text"], F.lit("")))), "\n")
    return _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(keys.short_hash(card).alias("sha256"))


@_query("""
SELECT page_id, replace(replace(replace(replace(replace(replace(nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), ''), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS title FROM pages
""")
def q34_html_unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "pages").select("page_id", text.html_title(F.col("html")).alias("title"))


@_query("SELECT doc_id FROM documents ORDER BY sha256(concat(doc_id, ':0')), doc_id LIMIT 50")
def q35_seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.sample(_read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 50)


@_query("""
SELECT o_orderkey, concat(o_custkey, ':t:', lpad(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::VARCHAR, 4, '0')) AS row_id FROM orders
""")
def q36_dense_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    rows = _grid(orders, F.col("o_custkey"), F.array(_cell(0, F.col("o_orderstatus"))), ("component", "HBA")).withColumn("source_row", F.col("o_orderkey")).withColumn("reason", F.lit(None).cast("string"))
    papers = spark.createDataFrame([], "paper_key string, paper_doi string")
    return tables.mixtures(rows, papers).select(F.col("source_row").alias("o_orderkey"), "row_id")


@_query("""
WITH w AS (SELECT p_partkey, string_split(p_name, ' ')[1] AS a, string_split(p_name, ' ')[2] AS b FROM part),
s AS (SELECT *, length(regexp_replace(a, '[^A-Za-z]', '', 'g')) >= 3 AND length(regexp_replace(b, '[^A-Za-z]', '', 'g')) >= 3 AS splits FROM w)
SELECT p_partkey, CASE WHEN splits THEN a ELSE concat(a, '/', b) END AS c1, CASE WHEN splits THEN b ELSE concat('D/L-', a) END AS c2, CASE WHEN splits THEN concat('D/L-', a) ELSE 'x' END AS c3,
  CASE WHEN splits THEN 'quaternary+' END AS flag FROM s
""")
def q37_component_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    cells = F.array(_text(a, "/", b), F.lit(" "), _text("D/L-", a), F.lit("x"))
    part = _read(spark, sf_dir, "part").select("p_partkey", names.components(cells).alias("c"))
    return part.select("p_partkey", *[F.col("c.names")[i].alias(f"c{i + 1}") for i in range(3)], "c.flag")


@_query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN '6:4' WHEN 1 THEN '2:1' WHEN 2 THEN '' ELSE '1:2' END AS raw,
  CASE l_linenumber % 4 WHEN 0 THEN 'weight_ratio' WHEN 1 THEN 'unstable' WHEN 2 THEN 'unknown_ratio' ELSE '' END AS flag,
  CASE l_linenumber % 4 WHEN 0 THEN 6.0::DOUBLE WHEN 1 THEN 2.0 WHEN 3 THEN 1.0 END AS r1 FROM lineitem
""")
def q38_ratio_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_linenumber") % 4
    printed = F.when(k == 0, "i6:4").when(k == 1, "us2:1").when(k == 2, "C-").otherwise("1:2")
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", tables.parse_ratio(printed, F.array().cast("array<string>")).alias("r"))
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "r.raw", "r.flag", F.col("r.parts")[0].alias("r1"))


@_query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linenumber % 5 IN (0, 1, 4) THEN l_quantity END AS value,
  CASE l_linenumber % 5 WHEN 0 THEN 60.0::DOUBLE WHEN 1 THEN 30.0 WHEN 4 THEN 25.0 END AS temperature_c,
  CASE l_linenumber % 5 WHEN 2 THEN 'not reported' WHEN 3 THEN 'no numeric value' ELSE '' END AS note FROM lineitem
""")
def q39_read_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("l_linenumber") % 5, F.col("l_quantity")
    printed = F.when(k == 0, _text("d", n)).when(k == 1, _text(n, "a")).when(k == 2, "–").when(k == 3, "DT").otherwise(n.cast("string"))
    cell = F.struct(printed.alias("text"), F.when(k == 1, F.array(F.lit("-"), F.lit("a"))).otherwise(F.array().cast("array<string>")).alias("markers"))
    marks = F.expr("array(named_struct('marker', 'a', 'meaning', 'temperature', 'temperature_C', 30D, 'note', ''), named_struct('marker', 'd', 'meaning', 'temperature', 'temperature_C', 60D, 'note', ''))")
    profile = F.struct(marks.alias("footnote_markers"), F.array(F.lit("n.r.")).alias("missing_value_tokens"), F.lit(None).cast("double").alias("default_temperature_C"))
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", tables.read_value(cell, profile).alias("v"))
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "v.value", "v.temperature_c", "v.note")


@_query("""
SELECT CASE l_linenumber WHEN 1 THEN 'single' WHEN 2 THEN 'binary' ELSE 'ternary' END AS what, count(*) AS n FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, count(*) FROM lineitem GROUP BY 1
UNION ALL SELECT 'away from default temperature', count(*) FROM lineitem WHERE l_quantity <> 25
""")
def q40_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem")
    listed = F.array_repeat(F.lit("x"), F.least("l_linenumber", F.lit(3)).cast("int"))
    mixed = lines.select(listed.alias("components"), F.lit(None).cast("string").alias("component_flag"))
    return tables.tallies(mixed, lines.select(F.col("l_returnflag").alias("property"), F.col("l_quantity").alias("temperature_c")))


@_query("""
SELECT s_suppkey, p_partkey FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey WHERE r_name = 'EUROPE' AND ends_with(p_brand, '1') GROUP BY ALL
""")
def q41_pattern_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = _read(spark, sf_dir, "region").filter("r_name = 'EUROPE'").select("r_regionkey")
    steps = (
        (_read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), "r_regionkey", "n_regionkey"),
        (_read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "n_nationkey", "s_nationkey"),
        (_read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey"), "s_suppkey", "l_suppkey"),
        (_read(spark, sf_dir, "part").filter(F.col("p_brand").endswith("1")).select("p_partkey"), "l_partkey", "p_partkey"),
    )
    return graph.path(start, *steps).select("s_suppkey", "p_partkey").distinct()


@_query("""
SELECT c_custkey, o_orderkey, o_totalprice FROM (SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n = 1
""")
def q42_first_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return matching.first_by(orders, ["c_custkey"], F.desc("o_totalprice"), F.asc("o_orderkey"))


@_query("""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' UNION ALL
SELECT o_orderkey, o_custkey, 'old' FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01' OR o_orderdate IS NULL
""")
def q43_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    arrivals = orders.filter("o_orderdate >= TIMESTAMP '1995-01-01'").drop("o_orderdate")
    return store.upsert(orders.drop("o_orderdate").withColumn("o_orderstatus", F.lit("old")), arrivals, "o_orderkey")


@_query("""
SELECT doc_id, len(list_distinct(list_filter(string_split(trim(regexp_replace(text, '[ \n]+', ' ', 'g')), ' '), lambda x: x <> '')))::INT AS n_words FROM documents
""")
def q44_squashed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", F.size(F.array_distinct(F.filter(F.split(text.squash(F.col("text")), " "), lambda x: x != ""))).alias("n_words"))


@_query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'header' WHEN p_size % 4 = 1 THEN 'no component' END AS reason FROM part
""")
def q45_left_out_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14, P-2: repeated headers and rows without a component."""
    kind = F.col("p_size") % 4
    part = _read(spark, sf_dir, "part").select(F.col("p_brand").alias("paper_key"), F.col("p_brand").alias("slug"), F.lit(0).alias("table_pos"), F.lit("t").alias("table_id"), F.lit("body").alias("part"), F.col("p_partkey").cast("int").alias("row"), kind.alias("kind"), "p_name")
    texts = F.array(F.when(F.col("kind") == 0, " hba ").when(F.col("kind") == 1, " ").otherwise(F.col("p_name")), F.when(F.col("kind") == 0, "Ratio").otherwise("1:2"))
    none = F.array().cast("array<string>")
    cells = part.select("*", F.posexplode(texts).alias("col", "text")).withColumns({"markers": none, "lines": none, "ref_ids": none})
    known = part.select("paper_key", "table_id").distinct()
    found = known.withColumn("ragged", F.array().cast("array<struct<row:int,width:int>>"))
    rows = tables.profiled_rows(cells, found, known.withColumn("profile", _profile(("component", "HBA"), ("ratio", "Ratio"))))
    return rows.select(F.col("source_row").cast("long").alias("p_partkey"), "reason")


@_query("""
SELECT event_id, CASE event_type WHEN 'view' THEN 'g*cm^-3' WHEN 'click' THEN 'mPa*s' ELSE 'mN*m^-1' END AS unit FROM events
""")
def q46_column_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a column's unit as written, else its property's."""
    written = F.when(F.col("event_type") == "view", "(g/cm3)").when(F.col("event_type") == "click", "").otherwise("( mN/m )")
    prop = F.when(F.col("event_type") == "click", "Viscosity").otherwise("Density")
    return _read(spark, sf_dir, "events").select("event_id", units.unit_of(written, prop).alias("unit"))


@_query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  substr(sha1(concat(CASE WHEN lower(l_returnflag) < 'b' THEN concat(lower(l_returnflag), '+b') ELSE concat('b+', lower(l_returnflag)) END, '|1:2|Density|', l_quantity::BIGINT, '|', l_linenumber, '|10.1/', l_suppkey)), 1, 16) AS dedup_key FROM lineitem
""")
def q47_dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the key of a datum, whatever the order of its components."""
    named = F.array(F.lit(" B "), F.col("l_returnflag"), F.lit(None).cast("string"), F.lit(" "))
    key = keys.dedup_key(named, F.lit("1:2"), F.lit("Density"), F.col("l_quantity"), F.col("l_linenumber").cast("double"), _text("10.1/", F.col("l_suppkey")))
    return _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", key.alias("dedup_key"))


@_query("""
WITH t AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN []::INT[] ELSE [l_linenumber + 1, l_linenumber] END AS a,
  CASE WHEN l_returnflag = 'A' THEN []::INT[] WHEN l_returnflag = 'N' THEN [40, l_linenumber] ELSE [50, 49, 50] END AS b FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, array_to_string(list_sort(list_distinct(CASE WHEN len(list_intersect(a, b)) > 0 THEN list_intersect(a, b) WHEN len(a) > 0 THEN a ELSE b END)), ',') AS refs,
  CASE WHEN len(list_intersect(a, b)) > 0 THEN 'agreed' WHEN len(a) > 0 THEN 'text' WHEN len(b) > 0 THEN 'llm' ELSE 'none' END AS how FROM t
""")
def q48_harvested_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """what text and model both cite, else the text, else the model."""
    n, none = F.col("l_linenumber").cast("int"), F.array().cast("array<int>")
    a = F.when(n % 3 == 0, none).otherwise(F.array(n + 1, n))
    b = F.when(F.col("l_returnflag") == "A", none).when(F.col("l_returnflag") == "N", F.array(F.lit(40), n)).otherwise(F.array(F.lit(50), F.lit(49), F.lit(50)))
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", citations.harvest(a, b).alias("h"))
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.array_join(F.transform("h.refs", lambda x: x.cast("string")), ",").alias("refs"), "h.how")


@_query(r"""
SELECT p_partkey, p_size % 3 <> 0 AND length(trim(p_name)) >= 4 AND regexp_matches(p_name, '[a-z]{3}')
  AND NOT regexp_matches(p_name, '\b(acids|salts?|halides|bromides|chlorides|iodides|compounds?|derivatives|analogues|mixtures?|species|based)\b', 'i') AS chemical FROM part
""")
def q49_looks_chemical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """names worth a lookup; abbreviations in capitals and classes aren't."""
    name = F.when(F.col("p_size") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return _read(spark, sf_dir, "part").select("p_partkey", names.chemical(name).alias("chemical"))


@_query("SELECT p_partkey, p_size + 0.5::DOUBLE AS density FROM part")
def q50_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F32: the first string that states a density."""
    strings = F.array(F.lit("denser than water"), _text(F.col("p_size"), ".5 g/cu cm at 20 C"), F.lit("9.9 g/mL"))
    return _read(spark, sf_dir, "part").select("p_partkey", units.density(strings).alias("density"))


@_query("""
SELECT p_partkey AS id, CASE WHEN p_size % 6 = 0 THEN 'rejected' WHEN p_size % 6 = 1 THEN 'conflicts_with_table' WHEN p_size % 6 = 2 THEN 'new' WHEN p_size % 6 = 3 THEN 'deliberately_unresolved'
  WHEN p_size % 6 = 4 THEN 'agrees' ELSE 'conflicts_with_file' END AS verdict, p_brand < 'Brand#3' AS name_in_table FROM part
""")
def q51_alias_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions held against the tables and the alias file."""
    kind = F.col("p_size") % 6
    part = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), _text("A", F.col("p_partkey")).alias("abbreviation"), F.col("p_brand").alias("name"), kind.alias("kind"))
    found = part.select("id", "abbreviation", "name", F.lower("abbreviation").alias("k"), F.when(F.col("kind") == 0, "rejected").otherwise("candidate").alias("status"))
    other = F.when(F.col("kind") == 4, F.upper("name")).when(F.col("kind") == 5, F.lit("another"))
    file = part.filter("kind in (0, 3, 4, 5)").select(F.col("abbreviation").alias("abbr"), other.alias("name"))
    hints = part.filter("kind = 1").select(F.col("abbreviation").alias("name"), F.lit("Something").alias("candidate"), F.lit(1).alias("n"))
    used = part.filter("name < 'Brand#3'").select(F.array("name", F.lit(None).cast("string")).alias("components"))
    return aliases.checked(found, file, used, hints).select("id", "verdict", "name_in_table")


@_query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 'no such cell' WHEN l_discount > 0.05 THEN 'value differs' WHEN l_linestatus = 'F' THEN 'temperature differs' END AS problem
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber) AS c FROM lineitem) WHERE c = 1
""")
def q52_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored values against cells read again."""
    one = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = _read(spark, sf_dir, "lineitem")
    lines = lines.join(lines.groupBy(*one).count().filter("count = 1").drop("count"), one, "left_semi")
    at = {"paper_key": F.col("l_orderkey"), "table_id": F.col("l_partkey"), "source_row": F.col("l_suppkey"), "source_col": F.col("l_linenumber")}
    stored = lines.select(*one, *[c.alias(k) for k, c in at.items()], F.col("l_quantity").alias("value"), F.lit(25.0).alias("temperature_c"))
    again = lines.filter("l_returnflag <> 'A'").select(*[c.alias(k) for k, c in at.items()], (F.col("l_quantity") + F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("value"), F.when(F.col("l_linestatus") != "F", 25.0).alias("temperature_c"))
    return quality.fidelity(stored, again).select(*one, "problem")


@_query("""
SELECT event_id, CASE WHEN value < 10 THEN 'qualitative' WHEN event_type = 'view' THEN 'unverified' WHEN user_id % 2 = 0 THEN 'different_substance' WHEN event_type = 'click' THEN 'unhandled_unit' ELSE 'ok' END AS status FROM events
""")
def q53_component_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reason that keeps a component's property out."""
    drafts = _read(spark, sf_dir, "events").select(
        "event_id", F.when(~(F.col("value") < 10), F.col("value")).alias("value"), (F.col("event_type") != "view").alias("verified"), F.when(F.col("user_id") % 2 == 0, "its hydrate").alias("applies_to"),
        F.lit("Density").alias("property"), F.when(F.col("event_type") != "click", "g*cm^-3").alias("unit"),
    )
    return drafts.select("event_id", components.status().alias("status"))


@_query("""
SELECT 1 AS priority, 'table not extracted' AS kind, concat(p_brand, ': ', p_type) AS detail, p_size::BIGINT AS rows_affected, p_partkey::VARCHAR AS paper_key FROM part WHERE p_size < 10
UNION ALL SELECT 2, 'unresolved abbreviation', concat(r_name, ' is in no table and no alias file'), r_regionkey::BIGINT, '' FROM region
UNION ALL SELECT 3, 'implausible value', concat(c_name, ', Density ', c_nationkey, ' C (', c_mktsegment, ')'), 1, c_custkey::VARCHAR FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 4, 'doubtful Crossref match', concat('reference ', s_suppkey, ' ', s_name, ' agrees by 0.25 with its title: ', substr(s_name, 1, 60)), 1, 's' FROM supplier WHERE s_acctbal < 1000
UNION ALL SELECT 5, 'prose value not in the text', concat(n_name, ', Viscosity ', n_nationkey), 1, n_regionkey::VARCHAR FROM nation WHERE n_nationkey < 12
""")
def q54_review_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What people have to look at, by kind and urgency."""
    tables_left = _read(spark, sf_dir, "part").filter("p_size < 10").select(F.col("p_brand").alias("label"), F.lit("").alias("table_id"), F.col("p_type").alias("status"), F.col("p_size").alias("n_rows"), F.col("p_partkey").cast("string").alias("paper_key"))
    unresolved = _read(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("n"))
    measured = _read(spark, sf_dir, "customer").select(F.col("c_name").alias("mixture"), F.lit("Density").alias("property"), F.col("c_nationkey").alias("value"), F.lit("C").alias("unit"), F.col("c_mktsegment").alias("plausibility_note"), (F.col("c_acctbal") >= 0).alias("plausible"), F.col("c_custkey").cast("string").alias("paper_key"))
    refs = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ref_number"), F.col("s_name").alias("doi"), F.when(F.col("s_acctbal") < 1000, 0.25).alias("title_agreement"), F.col("s_name").alias("title"), F.lit("s").alias("paper_key"))
    claims = _read(spark, sf_dir, "nation").select(F.array("n_name").alias("components"), F.lit("Viscosity").alias("property"), F.col("n_nationkey").alias("value"), F.when(F.col("n_nationkey") < 12, "unverified").otherwise("ok").alias("status"), F.col("n_regionkey").cast("string").alias("paper_key"))
    queue = quality.review_queue(*quality.review_kinds(tables_left, claims, unresolved, measured, refs))
    return queue.select("priority", "kind", "detail", "rows_affected", "paper_key")


@_query("""
WITH p AS (SELECT l_suppkey, count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS source_rows, avg(CASE WHEN l_discount > 0.09 THEN 1 ELSE 0 END) AS bad, count(*) FILTER (l_quantity > 49.5) AS mismatches FROM lineitem GROUP BY l_suppkey),
s AS (SELECT s_suppkey, 30::BIGINT AS reviewed, 0 AS wrong FROM supplier WHERE s_acctbal > 0)
SELECT l_suppkey, n, mismatches, coalesce(reviewed, 0) AS reviewed, mismatches = 0 AND bad < 0.1 AND coalesce(reviewed, 0) >= least(20, source_rows) AS accepted FROM p LEFT JOIN s ON s_suppkey = l_suppkey
""")
def q55_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of each paper and whether it is accepted."""
    lines = _read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("paper_key"), F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").alias("source_row"), (~(F.col("l_discount") > 0.09)).alias("plausible"), F.when(F.col("l_quantity") > 49.5, "x").alias("problem"))
    seen = _read(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("paper_key"), F.lit("yes").alias("correct"), F.explode(F.array_repeat(F.lit(1), 30)))
    out = quality.verdict(lines, lines, seen, most=0.1)
    return out.select(F.col("paper_key").alias("l_suppkey"), "n", "mismatches", "reviewed", "accepted")


@_query("""
SELECT min(accepted) AS accepted FROM (SELECT count(*) FILTER (s_acctbal < -999) = 0 AS accepted FROM supplier GROUP BY s_nationkey)
""")
def q56_all_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every paper is accepted."""
    by = _read(spark, sf_dir, "supplier").groupBy("s_nationkey").agg((F.count_if(F.col("s_acctbal") < -999) == 0).alias("accepted"))
    return quality.all_accepted(by)


@_query("""
WITH m AS (SELECT o_orderkey, concat('mix ', o_custkey) AS mixture, o_custkey::VARCHAR AS paper, o_orderstatus, o_orderpriority, o_orderdate FROM orders),
parts AS (SELECT mixture, o_orderstatus AS name, 'HBA' AS role, o_orderkey, 0 AS pos FROM m UNION ALL SELECT mixture, o_orderpriority, 'HBD', o_orderkey, 1 FROM m),
e AS (
  SELECT name AS src, mixture AS dst, 'PART_OF' AS type, arg_max(role, (o_orderkey, pos)) AS role FROM parts GROUP BY ALL
  UNION ALL SELECT DISTINCT mixture, paper, 'REVIEW_PAPER', NULL FROM m
  UNION ALL SELECT DISTINCT mixture, concat('k', o_orderstatus), 'REPORTED_IN', NULL FROM m
  UNION ALL SELECT mixture, concat('v', o_orderkey), 'HAS_DENSITY', NULL FROM m
  UNION ALL SELECT concat('v', o_orderkey), paper, 'REVIEW_PAPER', NULL FROM m
  UNION ALL SELECT concat('v', o_orderkey), concat('k', o_orderstatus), 'REPORTED_IN', NULL FROM m
)
SELECT src, dst, type, role FROM e
""")
def q57_graph_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of mixtures and values, each once, labelled by property, the first component as acceptor."""
    none = F.lit(None).cast("string")
    base = _read(spark, sf_dir, "orders").select("o_orderkey", _text("mix ", F.col("o_custkey")).alias("mixture"), F.col("o_custkey").cast("string").alias("paper_key"), F.array(_text("k", F.col("o_orderstatus"))).alias("source_keys"), F.array("o_orderstatus", "o_orderpriority").alias("components"), F.lit("").alias("ref"))
    mixed = base.withColumns({"row_id": F.col("o_orderkey").cast("string"), "ratio_raw": F.lit(""), "ratio": F.array().cast("array<double>"), "ratio_flag": F.lit(""), "component_flag": none, "table_pos": F.lit(0), "source_row": F.col("o_orderkey")})
    told = base.withColumns({"measurement_key": _text("v", F.col("o_orderkey")), "property": F.lit("Density"), "value": F.lit(1.0), "unit": none, "temperature_c": F.lit(25.0), "table_id": none, "source_row": F.col("o_orderkey"), "plausible": F.lit(True), "plausibility_note": none, "dedup_key": none})
    return graph.relations(mixed, told).select("src", "dst", "type", "role")


@_query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN l_quantity * 1000.0::DOUBLE WHEN 1 THEN l_quantity * 0.001::DOUBLE WHEN 2 THEN l_quantity - 273.15::DOUBLE END AS value,
  CASE l_linenumber % 4 WHEN 0 THEN 'mPa*s' WHEN 1 THEN 'g*cm^-3' WHEN 2 THEN 'C' END AS unit FROM lineitem
""")
def q58_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values in their property's unit; null where the written unit isn't known."""
    k = F.col("l_linenumber") % 4
    prop = F.when(k == 0, "Viscosity").when(k == 1, "Density").when(k == 2, "Melting_point").otherwise("Conductivity")
    unit = F.when(k == 0, "Pa s").when(k == 1, "kg/m3").when(k == 2, "K").otherwise("furlong")
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", units.convert(prop, F.col("l_quantity"), unit).alias("v"))
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "v.value", "v.unit")


@_query("""
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'melting point' WHEN 1 THEN 'density' END AS name, CASE p_size % 3 WHEN 0 THEN p_size + 1.5::DOUBLE WHEN 1 THEN p_size * 10.0::DOUBLE END AS value,
  CASE p_size % 3 WHEN 0 THEN '°C' WHEN 1 THEN 'g/cm3' END AS unit, CASE p_size % 3 WHEN 0 THEN 'dec. air' WHEN 1 THEN 'Temp: 20' END AS comment FROM part
""")
def q59_registry_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property strings of a registry."""
    n, k = F.col("p_size"), F.col("p_size") % 3
    name = F.when(k == 0, "Melting Point").when(k == 1, "Density").otherwise("Odour")
    stated = F.when(k == 0, _text(n, "-", n + 3, " °C  dec. air")).otherwise(_text(n, " x 10 g/cm3 Temp: 20"))
    return _read(spark, sf_dir, "part").select("p_partkey", units.cas_property(name, stated).alias("v")).select("p_partkey", "v.*")


@_query("""
SELECT s_suppkey AS identifier, CASE s_nationkey % 4 WHEN 0 THEN 'crossref' WHEN 1 THEN 'elsevier' WHEN 2 THEN 'unpaywall' END AS route FROM supplier
""")
def q60_first_full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first route that answered with a full text."""
    wanted = _read(spark, sf_dir, "supplier").select(_text("10.1/", F.col("s_suppkey")).alias("identifier"), (F.col("s_nationkey") % 4).alias("k"))
    each = wanted.select("identifier", "k", F.posexplode(F.array(*[F.lit(r) for r in caches.ROUTES])).alias("pos", "route"))
    whole, stub = F.concat(F.lit("<doc><body>"), F.repeat(F.lit("x"), 20_000)), F.lit("<doc><coredata/></doc>")
    attempts = each.select("identifier", "route", F.when(F.col("pos") > F.col("k"), 403).otherwise(200).alias("status"), F.when(F.col("pos") >= F.col("k"), whole).otherwise(stub).cast("binary").alias("content"))
    found = caches.fetched(wanted.select("identifier"), attempts)
    return found.select(F.substring("identifier", 6, 20).cast("long").alias("identifier"), "route")
