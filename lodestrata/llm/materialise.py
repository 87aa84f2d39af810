"""Training-order materialisation: every sequence gets a global slot by a keyed permutation.

Documents become token ids and an end id, cut into sequences of ``stride`` ids. They are written once as a table of
parts, with the runs of rows that each part read from one file. A sequence's number is that of its run's place in the
order of (file, row in the file), so numbering moves no sequence, no task sees all, and the files and the key alone
decide the slots, however they are split. The driver holds one row a run: one for each split of the input. A Feistel
network over the least even number of bits that hold n, with keyed round functions, permutes the numbers; numbers
that leave the range walk their cycle until they return. That is a bijection, known from key and n alone, with no
table and no sort key to store.

Slots are dealt to partitions of ``RANGE`` consecutive shards by arithmetic, each shard of ``SHARD`` slots. A slot
holds a header (doc_id, piece, length) and ``stride`` ids of ``WIDTH`` bytes, zero behind the length: slot s lies in
shard s // SHARD at s % SHARD times that size, so a reader resumes at any slot with one division and reads on
sequentially. Shards are rows of a Parquet table in the shared folder, so any store that Spark writes will do;
``export`` copies them to files.

Defined results: a null or empty text is one sequence with the end id; a very long text is as many sequences as it
fills. Rows that repeat a doc_id are sequences of their own. A null doc_id stays null. Reruns give equal slots; docs
that no file holds are numbered by part and row, which takes equal partitions. Extra columns are left alone. An empty
table gives no shards and no rows. An id that needs more than ``WIDTH`` bytes is an error.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm import _bytes, _scratch, _tokens

STRIDE = 2048
#: Slots in a shard: about 256 KB.
SHARD = 64
#: Shards in a partition: about 16 MB.
RANGE = 64
#: Bytes that a writer holds before it writes them.
ROW_GROUP = 8 << 20
#: Bytes of an id; the vocabulary has fewer than 65,536.
WIDTH = 2
KEY = "order-1"
ROUNDS = 6
#: doc_id, whether there is one, piece, length.
_HEAD = np.dtype([("doc_id", "<i8"), ("named", "<i4"), ("piece", "<i4"), ("length", "<i4")])
_SCHEMA = {"slot": pa.int64(), "shard": pa.int64(), "shard_offset": pa.int64(), "doc_id": pa.int64(), "piece": pa.int32(), "length": pa.int64()}
_SQL = "slot long, shard long, shard_offset long, doc_id long, piece int, length long"


def feistel(numbers: np.ndarray, n: int, key: str = KEY) -> np.ndarray:
    """The slots of numbers below n."""
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}/{i}".encode(), digest_size=8).digest(), "little")) for i in range(ROUNDS)]
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            f = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f = f * np.uint64(0xBF58476D1CE4E5B9) + k
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _records(names: pa.Array, ids: np.ndarray, bounds: np.ndarray, stride: int) -> pa.Array:
    """The packed sequences of texts: a header and as many ids as there are."""
    if len(ids) and int(ids.max()) >= 1 << (8 * WIDTH):
        raise ValueError(f"id {int(ids.max())} needs more than {WIDTH} bytes")
    text, number, start, end = _tokens.cut(bounds, stride)
    heads = np.zeros(len(text), _HEAD)
    heads["doc_id"], heads["named"] = names.fill_null(0).to_numpy()[text], names.is_valid().to_numpy(zero_copy_only=False)[text]
    heads["piece"], heads["length"] = number, end - start
    offsets = np.concatenate(([0], np.cumsum(_HEAD.itemsize + WIDTH * (end - start))))
    data, body = np.empty(offsets[-1], np.uint8), np.ones(offsets[-1], bool)
    at = offsets[:-1, None] + np.arange(_HEAD.itemsize)
    data[at] = heads.view(np.uint8).reshape(len(heads), _HEAD.itemsize)
    body[at] = False
    data[body] = ids.astype("<u2").view(np.uint8)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(text), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _located(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the file and row that hold them (null where no file does)."""
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    try:
        return docs.select(*own, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    except AnalysisException:
        return docs.select(*own, F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("at"))


def sequences(docs: DataFrame, path: str, stride: int = STRIDE) -> DataFrame:
    """part, run (of rows of one file, in the part), row (its place in the run) and record (packed) of every sequence; the run's first row has its file and first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, row, last = TaskContext.get().partitionId(), -1, 0, None
        for batch in batches:
            # A run ends where the file changes or its rows don't go up: files may be read in splits of any order.
            files, at = batch.column(2).dictionary_encode(), batch.column(3).fill_null(0).to_numpy()
            codes = files.indices.fill_null(-1).to_numpy()
            new = np.ones(len(at), bool)
            new[1:] = (codes[1:] != codes[:-1]) | ((at[1:] <= at[:-1]) & (codes[1:] >= 0))
            if last is not None and len(at):
                file = batch.column(2)[0].as_py()
                new[0] = file != last[0] or (file is not None and at[0] <= last[1])
            for first, ids, bounds in _tokens.flat_ids(batch.column(1), path):
                texts = len(bounds) - 1
                records = _records(batch.column(0).slice(first, texts), ids, bounds, stride)
                text, piece, _, _ = _tokens.cut(bounds, stride)
                begins = new[first : first + texts]
                runs = number + np.cumsum(begins)
                # Rows count on from the last slice, or from where their own run begins.
                leads, place = (piece == 0) & begins[text], np.arange(len(text))
                since = np.maximum.accumulate(np.where(leads, place, -1))
                rows = np.where(since < 0, row + place, place - since)
                number, row = int(runs[-1]), int(rows[-1]) + 1
                lead = pa.array(first + text, mask=~leads)
                part_column, run_column = pa.array(np.full(len(text), part, np.int32)), pa.array(runs[text].astype(np.int32))
                columns = [part_column, run_column, pa.array(rows), pc.take(batch.column(2), lead), pc.take(batch.column(3), lead), records]
                yield pa.RecordBatch.from_arrays(columns, ["part", "run", "row", "file", "first", "record"])
            if len(at):
                last = (batch.column(2)[-1].as_py(), int(at[-1]))
        _bytes.release()

    return _scratch.lean(_located(docs)).mapInArrow(run, "part int, run int, row long, file string, first long, record binary")


def slotted(cut: DataFrame, key: str = KEY) -> tuple[DataFrame, int]:
    """(slot and record of every sequence of a written table, how many there are)."""
    runs = cut.groupBy("part", "run").agg(F.count("*").alias("m"), F.max("file").alias("file"), F.max("first").alias("first")).collect()
    runs.sort(key=lambda r: (r["file"] or "", r["first"] or 0, r["part"], r["run"]))
    sizes = np.array([r["m"] for r in runs], np.int64)
    names = np.array([(r["part"] << 32) + r["run"] for r in runs], np.int64)
    order, n = np.argsort(names), int(sizes.sum())
    names, before = names[order], (np.cumsum(sizes) - sizes)[order]

    @F.pandas_udf("long")
    def slot(part: pd.Series, run: pd.Series, row: pd.Series) -> pd.Series:
        name = (part.to_numpy(np.int64) << 32) + run.to_numpy(np.int64)
        return pd.Series(feistel(before[np.searchsorted(names, name)] + row.to_numpy(np.int64), n, key))

    return cut.select(slot("part", "run", "row").alias("slot"), "record"), n


def write(docs: DataFrame, path: str | None = None, stride: int = STRIDE, key: str = KEY) -> DataFrame:
    """The shards of all docs: shard, first (slot) and payload."""
    cut = _scratch.table(sequences(docs, path or _tokens.default_path(), stride), "sequences", "zstd", ROW_GROUP)
    slots, n = slotted(cut, key)
    each = SHARD * RANGE
    dealt = slots.repartitionById(max(1, -(-n // each)), F.expr(f"cast(slot div {each} as int)"))
    size = _HEAD.itemsize + stride * WIDTH

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A range's slots are placed as they come."""
        ranges: dict[int, np.ndarray] = {}
        for batch in batches:
            records = batch.column(1).cast(pa.large_binary())
            bounds = np.frombuffer(records.buffers()[1], np.int64)[records.offset : records.offset + len(records) + 1]
            data = np.frombuffer(records.buffers()[2] or b"", np.uint8)
            for slot, a, b in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                if slot // each not in ranges:
                    ranges[slot // each] = np.zeros((min(each, n - slot // each * each), size), np.uint8)
                ranges[slot // each][slot % each, : b - a] = data[a:b]
        for k in sorted(ranges):
            slots = ranges.pop(k)
            for at in range(0, len(slots), SHARD):
                first = k * each + at
                payload = pa.array([slots[at : at + SHARD].tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([first // SHARD], pa.int64()), pa.array([first], pa.int64()), payload], ["shard", "first", "payload"])

    return _scratch.table(dealt.mapInArrow(fill, "shard long, first long, payload binary"), "shards", "zstd", ROW_GROUP)


def _unpacked(start: int, payload: pa.Scalar, first: int, stride: int) -> tuple[list[pa.Array], np.ndarray]:
    """(the columns of ``_SCHEMA``, all ids by slot) of a shard's slots from first on."""
    size = _HEAD.itemsize + stride * WIDTH
    slots = np.frombuffer(payload.as_buffer(), np.uint8).reshape(-1, size)
    at = np.arange(max(start, first) - start, len(slots))
    slots = slots[at]
    heads = np.ascontiguousarray(slots[:, : _HEAD.itemsize]).view(_HEAD)[:, 0]
    slot = start + at
    columns = [slot, slot // SHARD, at * size, pa.array(heads["doc_id"], mask=heads["named"] == 0), heads["piece"], heads["length"]]
    return [pa.array(c, t) if isinstance(c, np.ndarray) else c for c, t in zip(columns, _SCHEMA.values())], slots[:, _HEAD.itemsize :]


def read(shards: DataFrame, first: int = 0, stride: int = STRIDE) -> DataFrame:
    """slot, shard, shard_offset, doc_id, piece, length and ids (WIDTH bytes each) from slot first on; shards before it aren't read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                columns, ids = _unpacked(start, payload, first, stride)
                own = pa.array([row[: WIDTH * n].tobytes() for row, n in zip(ids, columns[-1].to_pylist())], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, own], [*_SCHEMA, "ids"])

    return shards.filter(F.col("shard") >= first // SHARD).select("first", "payload").mapInArrow(run, f"{_SQL}, ids binary")


def order(docs: DataFrame, path: str | None = None, stride: int = STRIDE, key: str = KEY) -> DataFrame:
    """doc_id, piece, length, ids_crc32 (of 4-byte ids), slot, shard and shard_offset of every sequence, read back from the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                columns, ids = _unpacked(start, payload, 0, stride)
                wide = ids.view("<u2").astype("<u4")
                crc = pa.array([zlib.crc32(row[:n]) for row, n in zip(wide, columns[-1].to_pylist())], pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, crc], [*_SCHEMA, "ids_crc32"])

    back = write(docs, path, stride, key).select("first", "payload").mapInArrow(run, f"{_SQL}, ids_crc32 long")
    return back.select("doc_id", "piece", "length", "ids_crc32", "slot", "shard", "shard_offset")


def export(shards: DataFrame, folder: str) -> None:
    """Copies shards to files of a folder that executors and driver mount alike."""

    def run(rows) -> None:
        os.makedirs(folder, exist_ok=True)
        for row in rows:
            path = os.path.join(folder, f"shard-{row['shard']:08d}.bin")
            with open(f"{path}.part", "wb") as f:
                f.write(row["payload"])
            os.replace(f"{path}.part", path)

    shards.foreachPartition(run)
