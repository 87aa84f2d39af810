"""MinHash near-dedup with min-max hashing.

A text's set holds its distinct runs of ``n`` words (white space: space and 9 to 13; A-Z lower-cased). Under each
of ``permutations`` permutations both the least and the greatest value of the set are kept, so 64 permutations
give 128 signature values. Both estimate the Jaccard similarity without bias. Bands of ``rows`` values deal the
sets into buckets; at similarity 0.75 two sets share none of the 32 default buckets with probability 5e-6.

Buckets only propose. Every link is confirmed on the full sets:

1. Texts with one set are one class, found by a 128-bit fingerprint; from here on only classes count.
2. Each class is held against the bucket's class of least and of greatest id, first against the one it shares most
   bands with, then against those that still are in another component. That is linear in the bucket, and settles
   buckets of up to three classes altogether.
3. Classes linked so far form components. A larger bucket that still holds several components goes, with its full
   sets, to tasks over pairs of blocks of about ``block`` classes each, one of them of classes outside the bucket's
   largest component: so the largest is copied once for each block outside it, and not at all against itself. There
   each class outside the largest is held against all classes of both blocks at once by counting shared runs. Nothing
   is capped: pairs within a component are skipped because they cannot change it.

Components come from min-label propagation with pointer jumping; links found later join components, not classes, and
cost no round over the earlier ones. No links or labels reach the driver. Where rows meet
by a bucket, a hub, a label or a fingerprint that a large share of them may have, ``_skew`` deals them over several tasks.

Defined results: a null or empty text, or one without words, has an empty set, is linked with nothing and is its
own component. A text with fewer than ``n`` words has its whole sequence as its one run. Rows that repeat a doc_id
are one node of the graph: what links any of them links all, also those without words. Where they differ in text,
``keep_one`` judges each text by itself, so no text goes for what another text of its doc_id is near to. A row whose
doc_id is null takes no part: its component is null and it is kept. Other columns, whatever their names, play no
role in the result. Texts of any length are taken whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm import _bytes, _scratch, _skew

N_WORDS = 5
PERMUTATIONS = 64
ROWS = 4
PERCENT = 75
BLOCK = 500


def _multipliers(permutations: int) -> np.ndarray:
    return (_bytes.mix(np.arange(1, permutations + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minmax(hashes: np.ndarray, offsets: np.ndarray, permutations: int) -> np.ndarray:
    """Signatures of the sets (all non-empty): the least values under each permutation, then the greatest."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(offsets) - 1, 2 * permutations), np.uint32)
    for i, a in enumerate(_multipliers(permutations)):
        values = low * a
        out[:, i] = np.minimum.reduceat(values, offsets[:-1])
        out[:, permutations + i] = np.maximum.reduceat(values, offsets[:-1])
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit bucket for each band of each signature; buckets of different bands differ."""
    sets, width = signatures.shape
    bands = width // rows
    parts = signatures[:, : bands * rows].reshape(sets, bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (sets, bands)).copy()
    for j in range(rows):
        keys = _bytes.mix(keys * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, j])
    return keys.view(np.int64)


def _sets(column: pa.Array, n: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct runs of each text), slice by slice."""
    for first, data, offsets in _bytes.slices(column):
        hashes, text, _ = _bytes.pieces(data, offsets)
        runs, at = _bytes.shingles(hashes, text, n, len(offsets) - 1)
        yield first, [np.unique(runs[at[i] : at[i + 1]]) for i in range(len(at) - 1)]


def sketches(docs: DataFrame, n: int = N_WORDS, permutations: int = PERMUTATIONS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, fp (16 bytes naming the set, null if empty), keys (a bucket for each band)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch.column(1), n):
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                fps: list[bytes | None] = [None] * len(sets)
                keys: list[np.ndarray | None] = [None] * len(sets)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    at = np.concatenate(([0], np.cumsum(sizes[full])))
                    prints = np.stack([np.add.reduceat(flat, at[:-1]), np.add.reduceat(_bytes.mix(flat), at[:-1])], 1)
                    buckets = band_keys(minmax(flat, at, permutations), rows)
                    for k, i in enumerate(full):
                        fps[i], keys[i] = prints[k].tobytes(), buckets[k]
                ids = batch.column(0).slice(first, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes), pa.array(fps, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "fp", "keys"],
                )
        _bytes.release()

    return _scratch.lean(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_shingles long, fp binary, keys array<long>")


def full_sets(docs: DataFrame, n: int = N_WORDS) -> DataFrame:
    """id (the doc_id), s (sorted distinct runs of words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch.column(1), n):
                values = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), values], ["id", "s"])
        _bytes.release()

    return _scratch.lean(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "id long, s array<long>")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label): the least id reachable over the links. Only linked ids have a row.

    Each round takes the least label among neighbours, then the label of that label; rounds end when nothing
    changes. Each round's labels are a table in the shared folder.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = _scratch.table(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct(), "links")
    hubs = _skew.heavy(both, "b")
    labels = _scratch.table(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "labels")
    while True:
        near = _skew.join(both, labels.select(F.col("id").alias("b"), F.col("label").alias("l")), "b", hot=hubs).groupBy(F.col("a").alias("id")).agg(F.min("l").alias("l"))
        low = labels.join(near, "id", "left").select("id", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        up = labels.select(F.col("id").alias("old"), F.col("label").alias("up"))
        jumped = _skew.join(low, up, "old", "left", hot=_skew.heavy(labels, "label"), by=("id",))
        new = _scratch.table(jumped.select("id", "old", F.least("label", "up").alias("label")), "labels")
        labels = new.select("id", "label")
        if new.filter("label != old").isEmpty():
            return labels


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Of the pairs (a, b; a written table), those of different components, and these: (a, b, la, lb)."""
    hubs = _skew.heavy(pairs, "b")
    left = _skew.join(pairs.select("a", "b"), labels.select(F.col("id").alias("a"), F.col("label").alias("la")), "a", "left")
    both = _skew.join(left, labels.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b", "left", hot=hubs, by=("a",))
    return both.select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")).filter("la != lb")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links (a, b; a written table): components of the components that the links join."""
    if links.isEmpty():
        return labels
    tops = components(_scratch.table(_apart(links, labels).select("la", "lb").distinct(), "joined"), "la", "lb")
    up = _skew.join(labels, tops.select(F.col("id").alias("label"), F.col("label").alias("top")), "label", "left", by=("id",))
    # Ids without a label so far are their own component, so they are among the tops' ids.
    return _scratch.table(up.select("id", F.coalesce("top", "label").alias("label")).unionByName(tops).distinct(), "labels")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those with 100 * intersection >= percent * union of their full sets."""
    size, other = F.size("sa"), F.size("sb")
    left = _skew.join(pairs, sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
    both = _skew.join(left, sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b", hot=_skew.heavy(pairs, "b"), by=("a",))
    near = both.filter(100 * F.least(size, other) >= percent * F.greatest(size, other))
    shared = near.select("a", "b", (size + other).alias("total"), F.size(F.array_intersect("sa", "sb")).alias("shared"))
    return shared.filter((100 + percent) * F.col("shared") >= percent * F.col("total")).select("a", "b")


def block_links(ids: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between classes of different components, as few as join them: exact, each class against all at once."""
    n = len(ids)
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.concatenate(([0], np.cumsum(sizes)))
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    names, root = np.unique(comps, return_inverse=True)
    mark = np.zeros(int(codes.max()) + 1, bool)
    weight = np.bincount(root, minlength=len(names))
    largest = int(weight.argmax())
    found = []
    for i in np.flatnonzero(root != largest):
        if (root == root[i]).all():
            break
        mine = codes[order[i] : order[i + 1]]
        mark[mine] = True
        shared = np.add.reduceat(mark[codes], order[:-1])
        mark[mine] = False
        near = np.flatnonzero(((100 + percent) * shared >= percent * (sizes + sizes[i])) & (root != root[i]))
        for j in near:
            if root[j] != root[i]:
                found.append((int(ids[i]), int(ids[j])))
                root[root == root[j]] = root[i]
    return found if n else []


def _shared_docs(own: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of each doc_id that has several: its least with the others."""
    held = own.select("doc_id", "fp").distinct().join(classes.select("fp", "id"), "fp").select("doc_id", "id").distinct()
    least = held.groupBy("doc_id").agg(F.min("id").alias("b"))
    return held.join(least, "doc_id").filter("id != b").select(F.col("id").alias("a"), "b")


def near_links(sketch: DataFrame, docs: DataFrame, n: int = N_WORDS, percent: int = PERCENT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(classes, labels): (fp, id) of each distinct set, and (id, label) of those linked with another."""
    own = sketch.filter("fp is not null and doc_id is not null")
    classes = own.groupBy("fp").agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("runs"), F.first("keys").alias("keys"))
    classes = _scratch.table(classes, "classes")
    repeated = not own.groupBy("doc_id").count().filter("count > 1").isEmpty()
    seats = classes.select(F.struct("id", "runs").alias("own"), F.explode("keys").alias("bucket"))
    shape = F.sum(F.xxhash64("own.id").cast("decimal(38,0)")).alias("shape")
    buckets = seats.groupBy("bucket").agg(F.count("*").alias("n"), F.min("own").alias("low"), F.max("own").alias("high"), shape).filter("n > 1")
    # Of the buckets with the same members one is enough.
    buckets = _scratch.table(buckets.groupBy("n", "low", "high", "shape").agg(F.min("bucket").alias("bucket"), F.count("*").alias("bands")).drop("shape"), "buckets")
    total = seats.count()
    hot = [r[0] for r in buckets.filter(F.col("n") * _skew.HOT >= total).select("bucket").limit(_skew.HOT).collect()]
    seats = _scratch.table(_skew.join(seats, buckets, "bucket", hot=hot).select("own.id", "own.runs", "bucket", "n", "bands", "low", "high"), "seats")
    pairs = seats.select("id", "runs", "bands", F.explode(F.array("low", "high")).alias("hub")).filter("id != hub.id")
    if not repeated:
        pairs = pairs.filter((100 * F.col("runs") >= percent * F.col("hub.runs")) & (100 * F.col("hub.runs") >= percent * F.col("runs")))
    # A class's hubs (two a band at most), that of most common bands first, ties to the smaller id.
    hubs = pairs.groupBy("id", F.col("hub.id").alias("hub")).agg(F.sum("bands").alias("bands")).groupBy("id")
    hubs = hubs.agg(F.sort_array(F.collect_list(F.struct("bands", F.bitwise_not("hub").alias("down"), "hub")), False).alias("hubs"))
    pairs = hubs.select("id", F.posexplode("hubs.hub").alias("turn", "hub")).groupBy(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b"))
    pairs = _scratch.table(pairs.agg(F.min("turn").alias("turn")), "pairs")
    met = seats.filter("n > 3").select("id").union(pairs.select("a")).union(pairs.select("b")).distinct()
    texts = docs.select("doc_id", "text").join(met.select(F.col("id").alias("doc_id")).hint("shuffle_hash"), "doc_id", "left_semi")
    sets = _scratch.table(full_sets(texts, n), "sets")
    sets = sets.dropDuplicates() if repeated else sets
    links = _confirmed(pairs.filter("turn = 0").select("a", "b"), sets, percent)
    links = _scratch.table(links.unionByName(_shared_docs(own, classes)).distinct() if repeated else links, "confirmed")
    labels = components(links)
    # Pairs within a component cannot change it.
    rest = _scratch.table(_apart(pairs.filter("turn > 0"), labels).select("a", "b"), "rest")
    if not rest.isEmpty():
        labels = merged(labels, _scratch.table(_confirmed(rest, sets, percent), "confirmed"))

    seen = seats.filter("n > 3").select("id", "bucket").distinct().join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    seen = _scratch.table(seen, "seen")
    sizes = seen.groupBy("bucket", "label").agg(F.count("*").alias("size")).groupBy("bucket")
    sizes = sizes.agg(F.max(F.struct("size", "label")).alias("top"), F.sum("size").alias("m"), F.count("*").alias("different")).filter("different > 1")
    many = [F.ceil(c / block).cast("int").alias(name) for c, name in ((F.col("m") - F.col("top.size"), "outer"), (F.col("top.size"), "inner"))]
    seen = _skew.join(seen, sizes.select("bucket", "top.label", *many).withColumnRenamed("label", "top"), "bucket", by=("id",))
    inside = F.col("label") == F.col("top")
    seen = seen.withColumn("own", F.pmod(F.xxhash64("id"), F.when(inside, F.col("inner")).otherwise(F.col("outer"))).cast("int"))
    # Pairs of blocks: of two outside the largest component (i <= j), and of one outside with one inside (j counts on).
    with_inside = F.transform(F.sequence(F.lit(0), F.col("inner") - 1), lambda k: F.struct(F.col("own").alias("i"), (F.col("outer") + k).alias("j")))
    with_outside = F.transform(F.sequence(F.lit(0), F.col("outer") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    against = F.transform(F.sequence(F.lit(0), F.col("outer") - 1), lambda k: F.struct(k.alias("i"), (F.col("outer") + F.col("own")).alias("j")))
    seen = seen.withColumn("at", F.explode(F.when(inside, against).otherwise(F.concat(with_outside, with_inside))))
    seen = seen.select("bucket", "at.i", "at.j", "id", "label").join(sets, "id")

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        found = block_links(group["id"].to_numpy(), group["label"].to_numpy(), [np.asarray(s) for s in group["s"]], percent)
        _bytes.release()
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    more = _scratch.table(seen.groupBy("bucket", "i", "j").applyInPandas(settle, "a long, b long"), "more")
    return classes, merged(labels, more)


def near_duplicates(docs: DataFrame, n: int = N_WORDS, permutations: int = PERMUTATIONS, rows: int = ROWS, percent: int = PERCENT) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, n_shingles, component_id, kept."""
    sketch = _scratch.table(sketches(docs, n, permutations, rows), "sketch")
    classes, labels = near_links(sketch, docs, n, percent)
    named = classes.join(labels, "id", "left").select("fp", F.coalesce("label", "id").alias("label"))
    out = _skew.join(sketch.select("doc_id", "n_shingles", "fp"), named, "fp", "left")
    mixed = sketch.groupBy("doc_id").agg(F.count("fp").alias("full"), F.count("*").alias("n")).filter("doc_id is not null and full > 0 and full < n").select("doc_id")
    if not mixed.isEmpty():
        node = out.join(mixed, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("label").alias("node"))
        out = out.join(node, "doc_id", "left").withColumn("label", F.coalesce("label", "node"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs whose doc_id is its component's least, all columns unchanged; rows that repeat a doc_id and its text stay once.

    Where a doc_id repeats, components are those of its texts: each different text of a doc_id is a node of its own.
    """
    named = docs.filter("doc_id is not null")
    if named.groupBy("doc_id").count().filter("count > 1").isEmpty():
        judged = _scratch.table(near_duplicates(named.select("doc_id", "text"), **options), "judged")
        kept = named.join(judged.filter("kept").select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
        return kept.unionByName(docs.filter("doc_id is null"))
    digest = F.coalesce(F.sha2(F.col("text").cast("string").cast("binary"), 256), F.lit(""))
    texts = named.select("doc_id", digest.alias("__digest")).groupBy("doc_id", "__digest").agg(F.count("*").alias("__copies"))
    # Ids in the order of doc_id, so the least node of a component has its least doc_id.
    nodes = _scratch.table(texts.orderBy("doc_id", "__digest").withColumn("__node", F.monotonically_increasing_id()), "nodes")
    seated = named.withColumn("__digest", digest).join(nodes, ["doc_id", "__digest"])
    judged = _scratch.table(near_duplicates(seated.select(F.col("__node").alias("doc_id"), "text"), **options), "judged")
    kept = seated.join(judged.filter("kept").select(F.col("doc_id").alias("__node")).distinct(), "__node", "left_semi")
    once = kept.filter("__copies > 1").dropDuplicates(["__node"])
    return kept.filter("__copies = 1").unionByName(once).select(docs.columns).unionByName(docs.filter("doc_id is null"))
