"""Words, tokens and shingles of many texts at once, on the UTF-8 bytes of an Arrow column.

Everything is numpy over slices of at most ``CHUNK`` bytes (or one text, if it is longer), so memory does not
grow with the batch. A word's hash is a polynomial over random 64-bit values of its bytes, modulo 2**64, and
then mixed; it is the same in every process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
_U = np.uint64
_P, _Q = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def release() -> None:
    """Gives memory that a worker has finished with back to the machine: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not every C library has it
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Kinds of bytes: 0 white space (space and 9 to 13), 1 in words, 2 signs.
WORDS = np.ones(256, np.uint8)
WORDS[[32, 9, 10, 11, 12, 13]] = 0
TOKENS = np.full(256, 2, np.uint8)
TOKENS[[32, 9, 10, 11, 12, 13]] = 0
for _r in (range(48, 58), range(65, 91), range(97, 123), range(128, 256), (95,)):
    TOKENS[list(_r)] = 1

_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _P) | _U(1)
_VALUES[[32, 9, 10, 11, 12, 13]] = 0
_FOLDED = _VALUES[_LOWER]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = _U(pow(int(_P), -1, 1 << 64))
    return tuple(np.concatenate(([_U(1)], np.cumprod(np.full(n - 1, p), dtype=np.uint64))) for p in (_P, inverse))


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the texts in them); null texts are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK, "right")) - 1)
        yield at, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def pieces(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = WORDS, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of one kind of byte other than white space: their hashes, the text each is in, their kinds."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none.astype(np.uint64), none, none.astype(np.uint8)
    kind = kinds[data]
    new = np.empty(len(data), bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    inner = offsets[1:-1]
    new[inner[inner < len(data)]] = True
    starts = np.flatnonzero(new & (kind > 0))
    if not len(starts):
        return none.astype(np.uint64), none, none.astype(np.uint8)
    power, inverse = _powers(max(CHUNK, 1 << int(len(data) - 1).bit_length()))
    values = (_FOLDED if fold else _VALUES)[data]
    values *= power[: len(data)]
    hashes = mix(np.add.reduceat(values, starts) * inverse[starts])
    return hashes, np.searchsorted(offsets, starts, "right") - 1, kind[starts]


def shingles(hashes: np.ndarray, text: np.ndarray, n: int, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by text) of the runs of n words of each text; a shorter text is one run, without words none."""
    counts = np.bincount(text, minlength=texts)
    runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    offsets = np.concatenate(([0], np.cumsum(runs)))
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    at = np.repeat(first - offsets[:-1], runs) + np.arange(offsets[-1])
    left = np.repeat(first + counts, runs) - at
    total = np.zeros(len(at), np.uint64)
    padded = np.concatenate((hashes, np.zeros(n, np.uint64)))
    for j in range(n):
        total += np.where(left > j, padded[at + j], _U(0)) * _U(pow(int(_Q), j, 1 << 64))
    return mix(total + np.minimum(left, n).astype(np.uint64)), offsets
