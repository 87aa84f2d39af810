"""Best-fit packing by patterns of few lengths, fitted by non-negative least squares.

Documents become token ids and an end id; only those longer than a sequence are cut. What is packed is the
histogram of piece lengths, at most ``capacity`` counts at any corpus size:

1. Lengths fall into ``BINS`` bins. All patterns of few bins that fill a sequence exactly are columns; non-negative
   least squares (Lawson-Hanson) finds how often each should repeat to reproduce the histogram. Patterns of up to two
   and of up to three documents are both planned; the plan with fewer sequences counts.
2. Repeats are rounded down and filled with real lengths, longest first, the last place of a pattern by the greatest
   length that still fits. Runs of equal sequences are made at once; a pattern ends where it can't fill up to ``SLACK``.
3. What is left goes, longest first, to the sequence with the least sufficient room, the patterns' own included, or
   opens a new one.

The plan is a list of runs (length, ranks from, to, first sequence, offset). Each piece has a rank among those of its
length: numbered within (length, salt), after the counts of lower salts, so the length that a third of all pieces
share meets no task whole. Pieces then find their place by binary search in the plan.

Defined results: a null or empty text is one piece that holds the end id. Rows that repeat a doc_id are packed each
(equal rows in any order). A null doc_id is kept. Extra columns are left alone. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm import _bytes, _scratch, _tokens

CAPACITY = 2048
BINS = 64
DEPTHS = (2, 3)
SALTS = 1024
#: Places that a pattern's sequence may leave empty; a pattern that would leave more ends there.
SLACK = 0


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every row."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, bounds in _tokens.flat_ids(batch.column(1), path):
                at, number, starts, ends = _tokens.cut(bounds, capacity)
                blob = memoryview(ids.astype("<u4").tobytes())
                columns = [
                    batch.column(0).take(pa.array(first + at)),
                    pa.array(number.astype(np.int32)),
                    pa.array(number * capacity),
                    pa.array(ends - starts),
                    pa.array([zlib.crc32(blob[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
        _bytes.release()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return _scratch.lean(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """x >= 0 with the least |a x - b| (Lawson and Hanson's active sets)."""
    x, inside = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[inside] = -np.inf
        k = int(slope.argmax())
        if slope[k] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        inside[k] = True
        while True:
            at = np.flatnonzero(inside)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            step = (x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)).min()
            x[at] += step * (z - x[at])
            gone = at[(x[at] <= 1e-12) & low]
            inside[gone if len(gone) else at[low]] = False
            x[~inside] = 0
    return x


def patterns(bins: int, depth: int) -> list[tuple[int, ...]]:
    """Descending bins, at most depth of them, that add up to all bins."""
    out = []
    for n in range(1, depth + 1):
        for head in combinations_with_replacement(range(1, bins + 1), n - 1):
            last = bins - sum(head)
            if last >= max(1, *head, 1):
                out.append((last, *reversed(head)))
    return out


class Histogram:
    """Counts by length, and the greatest length up to a bound that is still there."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def greatest(self, low: int, high: int) -> int:
        """The greatest length in (low, high] with a count, or 0."""
        found = np.flatnonzero(self.left[low + 1 : high + 1]) if high > low else []
        return int(found[-1]) + low + 1 if len(found) else 0


def plan(counts: dict[int, int], capacity: int = CAPACITY, bins: int = BINS, depths: tuple[int, ...] = DEPTHS) -> list[tuple[tuple[int, ...], int]]:
    """The runs of the depth that needs the fewest sequences."""
    return min((fitted(counts, capacity, bins, depth) for depth in depths), key=lambda runs: sum(n for _, n in runs))


def fitted(counts: dict[int, int], capacity: int, bins: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats): how many sequences hold pieces of these lengths, in this order."""
    stock = Histogram(counts, capacity)
    made: Counter[tuple[int, ...]] = Counter()
    if stock.left[capacity]:
        made[(capacity,)] = int(stock.left[capacity])
        stock.left[capacity] = 0
    width = -(-capacity // bins)
    shapes = patterns(bins, depth)
    matrix = np.zeros((bins, len(shapes)))
    for k, shape in enumerate(shapes):
        for b in shape:
            matrix[b - 1, k] += 1
    lengths = np.arange(1, capacity + 1)
    target = np.bincount((lengths - 1) // width, stock.left[1:], minlength=bins)[:bins]
    repeats = np.floor(nnls(matrix, target) + 1e-9).astype(np.int64)
    for k in sorted(np.flatnonzero(repeats), key=lambda k: shapes[k], reverse=True):
        todo = int(repeats[k])
        while todo:
            picked: list[int] = []
            for i, b in enumerate(shapes[k]):
                last = i == len(shapes[k]) - 1
                room = capacity - sum(picked)
                taken = Counter(picked)
                for p, n in taken.items():
                    stock.left[p] -= n
                length = stock.greatest(0 if last else (b - 1) * width, room if last else min(b * width, room))
                for p, n in taken.items():
                    stock.left[p] += n
                if not length:
                    break
                picked.append(length)
            if capacity - sum(picked) > SLACK:
                break
            taken = Counter(picked)
            n = min(todo, *(int(stock.left[p]) // c for p, c in taken.items()))
            for p, c in taken.items():
                stock.left[p] -= n * c
            made[tuple(picked)] += n
            todo -= n
    return fill(made, stock, capacity)


def fill(made: Counter, stock: Histogram, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The runs with all that is in stock added by best fit, longest first."""
    by_room: dict[int, list[list]] = {}
    rooms = np.zeros(capacity + 1, np.int64)

    def put(lengths: tuple[int, ...], n: int) -> None:
        room = capacity - sum(lengths)
        by_room.setdefault(room, []).append([lengths, n])
        rooms[room] += n

    for lengths, n in made.items():
        put(lengths, n)
    for length in range(capacity, 0, -1):
        n = int(stock.left[length])
        while n:
            fits = np.flatnonzero(rooms[length:])
            if not len(fits):
                each = capacity // length
                if n >= each:
                    put((length,) * each, n // each)
                if n % each:
                    put((length,) * (n % each), 1)
                n = 0
                continue
            room = int(fits[0]) + length
            run = by_room[room][-1]
            m = min(n, run[1])
            run[1] -= m
            rooms[room] -= m
            if not run[1]:
                by_room[room].pop()
            put((*run[0], length), m)
            n -= m
        stock.left[length] = 0
    joined: Counter[tuple[int, ...]] = Counter()
    for runs in by_room.values():
        for lengths, n in runs:
            joined[lengths] += n
    return sorted((k, n) for k, n in joined.items() if n)


def runs(packed: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, sequences, offsets) by key = length * 2**44 + first rank: where the pieces of a length go, in rank order."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for lengths, n in packed:
        offset = 0
        for length in lengths:
            rows.append(((length << 44) + used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    rows.sort()
    return tuple(np.array([r[i] for r in rows], np.int64) for i in range(3))


def ranked(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """rows (a written table) with rank (from 0) among those of one length. Equal rows are dealt by where they lie."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.spark_partition_id()), F.lit(salts)).cast("int"))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("m"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("length").alias("l"), F.col("salt").alias("s"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    joined = salted.withColumn("own", own).join(parts, (F.col("length") == F.col("l")) & (F.col("salt") == F.col("s")))
    return joined.withColumn("rank", F.col("before") + F.col("own")).drop("l", "s", "before", "own", "salt")


def placed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """rows (a written table of pieces) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    keys, sequences, offsets = runs(plan(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key = (length.to_numpy(np.int64) << 44) + rank.to_numpy(np.int64)
        at = np.searchsorted(keys, key, "right") - 1
        return pd.DataFrame({"sequence_id": sequences[at] + (key - keys[at]), "offset": offsets[at]})

    return ranked(rows).withColumn("at", place("length", "rank")).select(*rows.columns, "at.sequence_id", "at.offset")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    return placed(_scratch.table(pieces(docs, path or _tokens.default_path(), capacity), "pieces"), capacity)
