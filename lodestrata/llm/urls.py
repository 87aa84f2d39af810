"""URL filters by a sorted digest array.

A list of rules (host and path prefix) becomes an index: the 64-bit xxhash of every rule string, sorted, in a file
that executors memory-map, with the full strings beside it. A url's candidate strings are its host's suffixes at
label bounds joined with its path's prefixes of the lengths that occur in the index. All candidates of a batch are
probed by one vectorised binary search; a hit counts only if the stored string equals the candidate, so colliding
keys do no harm. The longest fitting rule wins (of equally
long ones the last by code point).

The index is built by the driver from the list, which is a parameter and at most ``MAX_RULES`` long (an error
beyond), and reaches executors as a job file. Urls are judged where they lie: no shuffle, so no host gathers rows.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``,
``#`` or the end. Defined results: a null url, or one without ``://``, has an empty host and path; no rule fits
an empty host, and its verdict is allow. Repeated rows are judged each; a rule listed twice counts once, with its
first verdict. Urls of any length are judged whole, by at most as many candidates as the index has path lengths and
host depths. Extra columns are left out of the result. An empty table gives an empty result; an empty list fits nothing.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RULES = 50_000_000

#: (verdict, rule): the rules that decide before the block list.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

#: Hosts that the registered query blocks, with their subdomains, where no rule fits: a short stand-in for a production list.
BLOCKED_HOSTS = ("ads-track.example.org", "casino-win.example.org", "cheap-pills.example.com", "free-bets.example.com", "spam-farm.example.org")

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: str | None) -> tuple[str, str]:
    """Host and path of a url."""
    found = _URL.search(url) if url else None
    return (found[1].translate(_FOLD), found[2]) if found else ("", "")


def _map(path: str) -> np.ndarray:
    """The array in a file, mapped unless it is empty."""
    return np.load(path, mmap_mode="r" if os.path.getsize(path) > 128 else None)


class DigestArray:
    """Sorted 64-bit keys of rule strings, memory-mapped, and the strings that confirm a hit."""

    def __init__(self, path: str):
        self.keys, self.ends, self.text, self.blocks = (_map(f"{path}.{x}.npy") for x in ("keys", "ends", "text", "blocks"))
        self.lengths = _map(f"{path}.lengths.npy").tolist()
        self.depth = int(_map(f"{path}.depth.npy")[0])

    @staticmethod
    def build(rules: Iterable[tuple[str, str]], path: str) -> list[str]:
        """Writes the files of an index over (verdict, host + path prefix); their names."""
        kept: dict[bytes, bool] = {}
        paths = set()
        for verdict, rule in rules:
            host, slash, rest = rule.partition("/")
            kept.setdefault(f"{host.translate(_FOLD)}{slash}{rest}".encode(), verdict == "block")
            paths.add(len(slash) + len(rest))
            if len(kept) > MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules")
        texts = sorted(kept, key=lambda t: (xxhash.xxh64_intdigest(t), t))
        lengths = sorted(paths, reverse=True)
        columns = {
            "keys": np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64),
            "ends": np.cumsum([len(t) for t in texts], dtype=np.int64),
            "text": np.frombuffer(b"".join(texts), np.uint8),
            "blocks": np.array([kept[t] for t in texts], bool),
            "lengths": np.array(lengths, np.int64),
            "depth": np.array([max([0, *(t.partition(b"/")[0].count(b".") + 1 for t in texts)])]),
        }
        for name, values in columns.items():
            np.save(f"{path}.{name}.npy", values)
        return [f"{path}.{name}.npy" for name in columns]

    def find(self, candidates: list[bytes]) -> np.ndarray:
        """The place of each candidate in the index, or -1."""
        out = np.full(len(candidates), -1, np.int64)
        if not len(self.keys) or not candidates:
            return out
        wanted = np.array([xxhash.xxh64_intdigest(c) for c in candidates], np.uint64)
        at = np.searchsorted(self.keys, wanted)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == wanted):
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == wanted[i]:
                if self.text[self.ends[k - 1] if k else 0 : self.ends[k]].tobytes() == candidates[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def longest(self, split: list[tuple[str, str]]) -> tuple[list[str | None], list[bool]]:
        """For each (host, path) the longest fitting rule, or None, and whether it blocks."""
        candidates: list[bytes] = []
        owner: list[int] = []
        for i, (host, path) in enumerate(split):
            if not host:
                continue
            labels = host.rsplit(".", self.depth)
            labels = labels[1:] if len(labels) > self.depth else labels
            suffixes = [".".join(labels[k:]) for k in range(len(labels))]
            both = {s + path[:n] for s in suffixes for n in self.lengths if n <= len(path)}
            for c in both:
                candidates.append(c.encode())
                owner.append(i)
        places = self.find(candidates)
        rules: list[str | None] = [None] * len(split)
        blocks = [False] * len(split)
        for k in np.flatnonzero(places >= 0):
            i, text = owner[k], candidates[k].decode()
            if rules[i] is None or (len(text), text) > (len(rules[i]), rules[i]):
                rules[i], blocks[i] = text, bool(self.blocks[places[k]])
        return rules, blocks


@lru_cache(maxsize=8)
def _index(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def _ship(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> str:
    """Builds an index and adds its files to the job; the name under which executors map it."""
    name, folder = f"urls-{uuid.uuid4().hex}", tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    for path in DigestArray.build(rules, os.path.join(folder, name)):
        spark.sparkContext.addFile(path)
    return name


def listed(table: DataFrame, column: str = "rule") -> Iterator[str]:
    """The entries of a block list kept as a table, partition by partition; null and empty ones are left out.

    At most ``MAX_RULES`` are read: a longer list is an error.
    """
    entries = table.select(F.trim(F.col(column).cast("string")).alias("rule")).filter("rule <> ''")
    if entries.limit(MAX_RULES + 1).count() > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    for row in entries.toLocalIterator(prefetchPartitions=True):
        yield row["rule"]


def judge(
    pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES, blocked: Iterable[str] | DataFrame = BLOCKED_HOSTS, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """key, host, path, rule and verdict of every row: the longest rule's, else block if the block list fits, else allow.

    blocked: hosts, or hosts with the path that urls must start with; any iterable, or a table with a column rule (see listed).
    """
    spark = pages.sparkSession
    blocked = listed(blocked) if isinstance(blocked, DataFrame) else blocked
    first, second = _ship(spark, rules), _ship(spark, (("block", host) for host in blocked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [parts(u) for u in batch.column(1).to_pylist()]
            rule, blocks = _index(first).longest(split)
            bad = _index(second).longest(split)[1]
            verdict = ["block" if (b if r is not None else x) else "allow" for r, b, x in zip(rule, blocks, bad)]
            columns = [batch.column(0), pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string()), pa.array(rule, pa.string()), pa.array(verdict)]
            yield pa.RecordBatch.from_arrays(columns, [key, "host", "path", "rule", "verdict"])

    chosen = pages.select(F.col(key).cast("long"), F.col(url).cast("string"))
    return chosen.mapInArrow(run, f"{key} long, host string, path string, rule string, verdict string")
