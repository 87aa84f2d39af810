"""Secret scans by an incremental ledger of blobs, in column expressions only.

A text version is content-addressed by its SHA-256. The ledger holds a row for each (blob, rule version) that was
ever scanned, with what was found; only pairs that it doesn't hold are scanned, each blob once however many paths
share it, and findings are joined back to every path. A changed rule set has another version, so it is scanned anew.

To find each blob once, (path, blob) rows without text are pre-aggregated to one path a blob, then held against the
ledger; only those paths' texts move, keyed by path and blob. Blobs that a large share of paths have (see ``_skew``)
are dealt over several tasks when findings join back. Where matches lie follows from the text's pieces between them:
``split`` and ``regexp_extract_all`` walk the same leftmost non-overlapping matches of a whole text, and a window over
the pieces' lengths sums up to their places, so time grows with a text's length and n log n of its matches. Texts are
redacted block by block of ``BLOCK`` code points.

Spans count code points, ends exclusive. The base kinds are assign, access and hex; ``EXTRA`` adds kinds, which
never remove base spans. Defined results: a null or empty text is the empty blob without spans. Rows that repeat a
path and text give the same row each; paths with equal texts the same spans. A null path is judged like any other.
Spans at one start go by kind as listed. Extra columns are left alone. An empty table gives an empty result. Texts of
any length are scanned whole.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm import _scratch, _skew


@dataclass(frozen=True)
class Kind:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    name: str
    pattern: str
    group: int
    least: int


#: The base kinds, in the order of spans that start together.
BASE = (
    Kind("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32),
)

#: Kinds that the method adds.
EXTRA = (
    Kind("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Kind("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Kind("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Kind("jwt", r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 32),
)

#: Code points that are cut at once where a text is redacted.
BLOCK = 1024
SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
LEDGER = f"blob binary, rules string, spans {SPANS}"


def version(kinds: tuple[Kind, ...]) -> str:
    """The name of a rule set: it changes with any rule."""
    return hashlib.sha256(repr(kinds).encode()).hexdigest()[:16]


def _matches(text: Column, kind: Kind, rank: int) -> Column:
    """The kind's matches of a text, in order: rank, place among them, code points since the last one, its own, and whether it is long enough."""
    pattern = F.lit(kind.pattern)
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda x: F.length(x))
    found, tested = F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(kind.group))

    def match(x: Column, i: Column) -> Column:
        return F.struct(F.lit(rank).alias("rank"), i.alias("place"), x["gap"].alias("gap"), F.length(x["m"]).alias("size"), (F.length(x["g"]) >= kind.least).alias("ok"))

    matches = F.transform(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("m"), tested.alias("g")), match)
    return F.when(F.regexp_like(text, pattern), matches).otherwise(F.array().cast("array<struct<rank:int,place:int,gap:int,size:int,ok:boolean>>"))


def scan(blobs: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """blob, rules, spans of every different blob of blobs (blob, text)."""
    matches = F.concat(*[_matches(F.col("text"), kind, rank) for rank, kind in enumerate(kinds)])
    rows = blobs.select("blob", F.explode_outer(matches).alias("x")).select("blob", "x.*").repartition("blob")
    # Rows that repeat a blob found the same.
    once = rows.groupBy("blob", "rank", "place").agg(F.max("gap").alias("gap"), F.max("size").alias("size"), F.max("ok").alias("ok"))
    before = Window.partitionBy("blob", "rank").orderBy("place")
    ended = once.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before).cast("int"))
    name = F.element_at(F.array(*[F.lit(k.name) for k in kinds]), F.col("rank") + 1)
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "rank", name.alias("kind"), "end")
    spans = F.array_sort(F.collect_list(F.when(F.col("ok"), span)))
    return ended.groupBy("blob").agg(spans.cast(SPANS).alias("spans")).select("blob", F.lit(version(kinds)).alias("rules"), "spans")


def versions(docs: DataFrame, path: str = "doc_id") -> DataFrame:
    """path and blob (the text's SHA-256) of every row."""
    return docs.select(F.col(path).cast("long").alias("path"), F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).alias("blob"))


def load(spark: SparkSession, table: str | None) -> DataFrame:
    """The rows of a stored ledger; none where nothing was stored yet."""
    empty = spark.createDataFrame([], LEDGER)
    if table is None or not _scratch.exists(spark, table):
        return empty
    return spark.read.schema(empty.schema).parquet(table)


def store(rows: DataFrame, table: str) -> None:
    """Adds rows to a stored ledger, by rule version."""
    rows.write.mode("append").partitionBy("rules").parquet(table)


def update(docs: DataFrame, ledger: DataFrame | None = None, kinds: tuple[Kind, ...] = BASE + EXTRA, path: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(paths, new ledger rows): path and blob of every row of docs, and the rows of blobs that the ledger lacks."""
    spark = docs.sparkSession
    paths = _scratch.table(versions(docs, path), "versions")
    known = (ledger if ledger is not None else load(spark, None)).filter(F.col("rules") == version(kinds)).select("blob")
    unseen = paths.groupBy("blob").agg(F.min("path").alias("path")).join(known, "blob", "left_anti")
    rows = docs.select(F.col(path).cast("long").alias("path"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2("text", 256)))
    named = unseen.select(F.col("blob").alias("own"), F.col("path").alias("first")).hint("shuffle_hash")
    texts = rows.join(named, (F.col("blob") == F.col("own")) & F.col("path").eqNullSafe(F.col("first")), "left_semi")
    return paths, _scratch.table(scan(texts.select("blob", "text"), kinds), "ledger")


def _joined(paths: DataFrame, ledger: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """path, blob and spans of every row of paths."""
    found = ledger.filter(F.col("rules") == version(kinds)).filter(F.size("spans") > 0).select("blob", "spans")
    joined = _skew.join(paths, found, "blob", "left")
    return joined.select("path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def findings(docs: DataFrame, ledger: DataFrame | None = None, kinds: tuple[Kind, ...] = BASE + EXTRA, path: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(path, blob and spans of every row of docs, the whole ledger after the scan)."""
    paths, new = update(docs, ledger, kinds, path)
    whole = new if ledger is None else ledger.select("blob", "rules", "spans").unionByName(new)
    return _joined(paths, whole, kinds), whole


def history(docs: DataFrame, table: str, kinds: tuple[Kind, ...] = BASE + EXTRA, path: str = "doc_id", arrivals: int = 1) -> DataFrame:
    """path, blob and spans of every row of docs, which come in so many arrivals: each is scanned against the ledger that earlier ones left in the table."""
    spark, seen = docs.sparkSession, []
    for k in range(arrivals):
        own = docs.filter(F.pmod(F.xxhash64(F.col(path).cast("long")), F.lit(arrivals)) == k) if arrivals > 1 else docs
        paths, new = update(own, load(spark, table), kinds, path)
        store(new, table)
        seen.append(paths)
    every = seen[0]
    for paths in seen[1:]:
        every = every.unionByName(paths)
    return _joined(every, load(spark, table), kinds)


def _named(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def document_findings(docs: DataFrame, table: str | None = None, arrivals: int = 1) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row; table: a stored ledger to use and to add to, else one of its own."""
    found = history(docs, table or _scratch.fresh(docs.sparkSession, "secret-ledger"), arrivals=arrivals)
    base = F.filter("spans", lambda x: x["rank"] < len(BASE))
    counts = [F.size(F.filter("spans", lambda x: x["kind"] == k.name)).cast("long").alias(f"n_{k.name}") for k in BASE]  # noqa: B023
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"))


def _cuts(found: DataFrame, mark: str) -> DataFrame:
    """path, blob, cuts: for each block of the text up to the last span, what is cut from it (start and end in the block, and what to put there)."""
    keys = ["path", "blob"]
    spans = found.select(*keys, F.explode("spans").alias("x")).select(*keys, "x.start", "x.end")
    ordered = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") < F.col("reach"), 0).otherwise(1)).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    merged = spans.withColumn("reach", reach).withColumn("island", island).groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    first = F.expr(f"start div {BLOCK}").cast("int")
    parts = merged.withColumn("block", F.explode(F.sequence(first, F.expr(f"(end - 1) div {BLOCK}").cast("int"))))
    at = F.col("block") * BLOCK
    put = F.when(F.col("block") == first, F.lit(mark)).otherwise("")
    cut = F.struct((F.greatest(F.col("start"), at) - at).alias("start"), (F.least(F.col("end"), at + BLOCK) - at).alias("end"), put.alias("put"))
    blocks = parts.groupBy(*keys, "block").agg(F.array_sort(F.collect_list(cut)).alias("cut"))
    listed = blocks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("block", "cut"))).alias("listed"))
    none = F.array().cast("array<struct<start:int,end:int,put:string>>")

    def dense(x: Column, i: Column) -> Column:
        last = F.when(i > 0, F.get(F.col("listed"), i - 1)["block"]).otherwise(-1)
        return F.concat(F.array_repeat(none, x["block"] - last - 1), F.array(x["cut"]))

    return listed.select(*keys, F.flatten(F.transform("listed", dense)).alias("cuts"))


def _clean(block: Column, cuts: Column) -> Column:
    """A block with its cuts made."""

    def step(acc: Column, x: Column) -> Column:
        before = block.substr(acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(x["end"].alias("at"), F.concat(acc["out"], before, x["put"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    made = F.aggregate(cuts, start, step, lambda acc: F.concat(acc["out"], block.substr(acc["at"] + 1, F.lit(BLOCK))))
    return F.when(F.coalesce(F.size(cuts), F.lit(0)) > 0, made).otherwise(block)


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span's text replaced by the mark and n_chars counted anew; other columns and rows unchanged."""
    found, _ = findings(docs)
    hits = _cuts(found.filter(F.size("spans") > 0).dropDuplicates(["path", "blob"]), mark)
    hits = hits.select(F.col("path").alias("__path"), F.col("blob").alias("__blob"), F.col("cuts").alias("__cuts")).hint("shuffle_hash")
    blob = F.unhex(F.sha2(F.col("text").cast("string"), 256))
    joined = docs.join(hits, F.col("doc_id").cast("long").eqNullSafe(F.col("__path")) & (blob == F.col("__blob")), "left")
    text, cuts = F.col("text"), F.col("__cuts")
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    clean = F.array_join(F.transform(blocks, lambda block, i: _clean(block, F.get(cuts, i))), "")
    out = joined.withColumn("text", F.when(cuts.isNotNull() & text.isNotNull(), clean).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cuts.isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
