"""Mixing sources to target weights by entropy balancing.

Document i of source s gets the rate min(2, exp(l_s * x_i)), x_i its size over its source's mean size: of all rates
in [0, 2] whose words meet the source's target, these are nearest to 1 in relative entropy. The multipliers l_s
solve the convex dual. Each Newton iteration is one distributed aggregation over the histogram (source, size), with
a bracket that falls back on bisection where the cap makes the dual only once differentiable.

Rates become copies 0, 1 or 2. Along a source's sizes, longest first, copies follow the running sum of rates, so
their words stay within one document of the target; one copy of the size nearest to what is left is then added or
removed. Within a cell (source, size) the documents that get one more copy are those of least keyed hash.

Sums of rates are decimals, so they don't depend on the order of rows, and reruns agree. Cells are split by
``SALTS`` hash values before any window, so a source or a size that holds a third of all rows meets no task whole;
the windows over a source run over its distinct sizes, not its rows.

Targets: sources by code point, null last, weigh 3, 1, 2, repeating, and share 150 % of all words; a target stops
at twice its source's words, and the excess is reshared by weight. Defined results: a null text has no words; a
source without words has target 0. A null source is one source. Rows that repeat a doc_id are documents of their
own. A null doc_id is a document like any other. Extra columns are left alone. An empty table gives an empty result. Texts of
any length are counted whole. A source that hasn't met its target after ``ROUNDS`` iterations keeps its last multiplier, with a warning.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm import _scratch

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SALTS = 4096
WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 60
TOLERANCE = 1e-7
#: Words that sums of decimals can't tell apart.
QUANTUM = 2e-6


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and salt of every row."""
    size = F.size(F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
    key = F.xxhash64(F.col("doc_id").cast("long"), F.lit("mix"))
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"), F.pmod(key, F.lit(SALTS)).cast("int").alias("salt"), key.alias("key"))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """sid, source, source_size, rows, target of each source (a row of source, source_size, rows): the water level of the capped shares."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("sid", F.row_number().over(order))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(CAP))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before, whole = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = ranked.withColumn("at", F.row_number().over(by_cap)).withColumn("level", level)
    first = F.min(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct("at", "level"))).over(whole)["level"]
    target = F.least(F.col("cap"), first * F.col("weight"))
    return filled.select("sid", "source", "source_size", "rows", F.coalesce(target, F.lit(0.0)).alias("target"))


def _exact(value):
    """A decimal of the value, for sums that don't depend on order."""
    return F.sum(value.cast("decimal(38,6)")).cast("double")


def multipliers(cells: DataFrame) -> DataFrame:
    """(sid, l) of each source: Newton iterations on the dual. cells: sid, size, n, x, target, full."""
    state = cells.filter("not full").groupBy("sid").agg(F.max("target").alias("target"))
    infinite = F.lit(math.inf)
    state = state.select("sid", "target", F.lit(0.0).alias("l"), (-infinite).alias("lo"), infinite.alias("hi"), F.lit(False).alias("done"))
    state = _scratch.table(state, "dual")
    for _ in range(ROUNDS):
        live = cells.drop("target").join(state.filter("not done"), "sid")
        tilt = F.col("l") * F.col("x")
        words = F.col("n") * F.col("size")
        inner = tilt < math.log(CAP)
        sums = live.groupBy("sid").agg(
            _exact(words * F.when(inner, F.exp(tilt)).otherwise(F.lit(float(CAP)))).alias("words"),
            _exact(F.when(inner, words * F.col("x") * F.exp(tilt)).otherwise(F.lit(0.0))).alias("slope"),
        )
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("l")).otherwise(F.col("lo"))
        high = F.when(gap > 0, F.col("l")).otherwise(F.col("hi"))
        stepped = state.join(sums, "sid", "left").select("sid", "target", "l", "done", gap.alias("gap"), "slope", low.alias("lo"), high.alias("hi"))
        newton = F.col("l") - F.col("gap") / F.col("slope")
        good = (F.col("slope") > 0) & (newton > F.col("lo")) & (newton < F.col("hi")) & (F.abs(newton - F.col("l")) < 8)
        far = F.greatest(F.lit(1.0), F.abs("l"))
        half = F.when((F.col("lo") > -infinite) & (F.col("hi") < infinite), (F.col("lo") + F.col("hi")) / 2).otherwise(F.col("l") - F.signum("gap") * far)
        met = F.col("done") | (F.abs("gap") <= F.greatest(TOLERANCE * F.col("target"), F.lit(QUANTUM)))
        new = F.when(met, F.col("l")).when(good, newton).otherwise(half)
        state = _scratch.table(stepped.select("sid", "target", new.alias("l"), "lo", "hi", met.alias("done")), "dual")
        if state.filter("not done").isEmpty():
            break
    else:
        warnings.warn(f"{state.filter('not done').count()} sources haven't met their target after {ROUNDS} iterations; their last multipliers count", stacklevel=2)
    return state.select("sid", "l")


def allocate(parts: DataFrame) -> DataFrame:
    """For each part (source, size, salt, m rows): the source's size and target, copies for every row, extra rows that get one more."""
    cells = parts.groupBy("source", "size").agg(F.sum("m").alias("n"))
    totals = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("rows"))
    goals = _scratch.table(targets(totals), "targets")
    same = cells["source"].eqNullSafe(goals["source"])
    mean = F.col("source_size") / F.col("rows")
    cells = cells.join(goals, same).select(
        "sid", goals["source"], "size", "n", "source_size", "target", (F.col("size") / F.when(mean > 0, mean).otherwise(1.0)).alias("x"), (F.col("target") >= CAP * F.col("source_size") * (1 - 1e-12)).alias("full")
    )
    cells = _scratch.table(cells, "cells")
    tilt = F.col("l") * F.col("x")
    rate = F.when(F.col("full") | (tilt >= math.log(CAP)), F.lit(float(CAP))).otherwise(F.exp(tilt))
    rated = cells.join(multipliers(cells), "sid", "left").withColumn("want", F.col("n") * rate)
    along = Window.partitionBy("sid").orderBy(F.desc("size"))
    upto = F.floor(F.sum("want").over(along) + 0.5)
    copied = rated.withColumn("upto", upto).withColumn("copies", F.col("upto") - F.coalesce(F.lag("upto").over(along), F.lit(0).cast("long"))).drop("upto")
    copied = _scratch.table(copied, "copies")
    left = copied.groupBy("sid").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("left"))
    room = F.when(F.col("left") > 0, F.col("copies") < CAP * F.col("n")).otherwise(F.col("copies") > 0)
    gap = F.abs(F.abs("left") - F.col("size"))
    mended = copied.join(left, "sid").filter(room & (F.col("size") > 0) & (gap < F.abs("left")))
    mended = mended.groupBy("sid").agg(F.min_by("size", F.struct(gap, F.col("size"))).alias("size"), F.signum(F.max("left")).cast("long").alias("one"))
    copied = copied.join(mended, ["sid", "size"], "left").withColumn("copies", F.col("copies") + F.coalesce("one", F.lit(0).cast("long")))
    shares = copied.select(F.col("source").alias("of"), F.col("size").alias("z"), "source_size", "target", "n", F.floor(F.col("copies") / F.col("n")).alias("base"), (F.col("copies") % F.col("n")).alias("more"))
    dealt = parts.join(shares, parts["source"].eqNullSafe(F.col("of")) & (parts["size"] == F.col("z")))
    within = Window.partitionBy("source", "size").orderBy("salt")
    upto = F.sum("m").over(within)
    extra = F.expr("more * upto div n - more * (upto - m) div n")
    return dealt.withColumn("upto", upto).select("source", "size", "salt", "source_size", "target", "base", extra.alias("extra"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and source of every row of docs."""
    rows = _scratch.table(sized(docs), "sizes")
    parts = _scratch.table(rows.groupBy("source", "size", "salt").agg(F.count("*").alias("m")), "parts")
    shares = allocate(parts).select(F.col("source").alias("of"), F.col("size").alias("z"), F.col("salt").alias("s"), "source_size", "target", "base", "extra")
    order = Window.partitionBy("source", "size", "salt").orderBy("key", "doc_id")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    joined = ranked.join(shares, ranked["source"].eqNullSafe(F.col("of")) & (ranked["size"] == F.col("z")) & (ranked["salt"] == F.col("s")))
    copies = F.col("base") + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)
    return joined.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"), copies.cast("int").alias("copies"), "source")


def repeated(docs: DataFrame) -> DataFrame:
    """docs as the mix takes them: each row as often as it has copies, all columns unchanged.

    Rows that repeat doc_id, source and size share their copies as evenly as whole copies allow.
    """
    taken = _scratch.table(mix(docs).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("c"), F.count("*").alias("n")).filter("c > 0"), "taken")
    taken = taken.select(F.col("doc_id").alias("__id"), F.col("source").alias("__of"), F.col("size").alias("__z"), F.col("c").alias("__c"), F.col("n").alias("__n"))
    size = F.size(F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
    joined = docs.withColumn("__size", size).join(
        taken, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & F.col("source").cast("string").eqNullSafe(F.col("__of")) & (F.col("__size") == F.col("__z"))
    )
    single = joined.filter("__n = 1").withColumn("__k", F.col("__c"))
    rank = F.row_number().over(Window.partitionBy("__id", "__of", "__z").orderBy(F.xxhash64("text")))
    shared = joined.filter("__n > 1").withColumn("__k", F.expr("__c div __n") + F.when(rank <= F.col("__c") % F.col("__n"), 1).otherwise(0)).filter("__k > 0")
    return single.unionByName(shared).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__k").cast("int")))).select(docs.columns)
