"""Token ids of many texts by the word BPE of the public tokenizer files.

That tokenizer drops white space, and its words end where letters, digits and signs meet, so a text's ids are those
of its pieces between such places. Pieces of up to 16 bytes are compared as two 64-bit numbers and a length, exactly
and many at once: each worker keeps the ids of pieces it has met (at most ``CACHE`` of them) in a table of numpy
arrays, and merges only new ones.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from lodestrata.llm import _bytes

VOCABULARY = "word_bpe_49k.json"
END = 0
CACHE = 1 << 18
#: Bytes of a piece that two numbers hold; longer ones are encoded each time.
SHORT = 16
#: Pieces looked up at once.
STEP = 1 << 16
LONG = 256
#: Bytes of a long text that are cut at once.
PART = 1 << 19
#: Letters whose lower case depends on their place, or isn't one letter.
_ODD = frozenset("İΣ")
#: How the vocabulary writes bytes: printable ones of Latin-1 as they are, the others from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_WRITTEN = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
_CHARACTERS = np.arange(256, dtype="<u2")
_CHARACTERS[list(_WRITTEN)] = list(_WRITTEN.values())
_OWN: dict[str, "PieceIds"] = {}

#: Kinds of bytes: 0 white space, 1 letters and digits, 2 signs, 3 apostrophe, 4 others (of no ASCII character).
_KINDS = np.full(256, 4, np.uint8)
_KINDS[33:127] = 2
_KINDS[39] = 3
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_KINDS[[32, 9, 10, 11, 12, 13]] = 0
_KINDS[[*range(9), *range(14, 32), 127]] = 4
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


class Cut:
    """A slice of texts in lower case (A-Z, À-Þ), cut into pieces: their first bytes, lengths, and whether they are of lower-case Latin-1 letters only."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind = _KINDS[data]
        accented = np.zeros(len(data), bool)
        # A text that may name a special token stays as written and whole between white space.
        plain = b"<|" not in data.tobytes()
        if plain and len(data):
            second = np.flatnonzero((data[1:] & 0xC0 == 0x80) & (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)) + 1
            accented[second] = True
            accented[second - 1] = True
            data = _LOWER[data]
            high = second[data[second] < 0x9F]
            data[high] += 0x20
            kind[accented] = 1
        new = np.zeros(len(data) + 1, bool)
        new[offsets] = True
        new[1:-1] |= kind[:-1] == 0
        if plain:
            new[1:-1] |= ((kind[:-1] == 1) & ((kind[1:] == 2) | (kind[1:] == 3))) | ((kind[:-1] == 2) & (kind[1:] == 1))
        new[:-1] &= kind > 0
        ends = np.zeros(len(data) + 1, bool)
        ends[1:] = kind > 0
        ends[1:-1] &= new[1:-1] | (kind[1:] == 0)
        ends[offsets[1:][offsets[1:] > 0]] |= kind[offsets[1:][offsets[1:] > 0] - 1] > 0
        ends[0] = False
        self.data = data
        self.first = np.flatnonzero(new[:-1])
        self.size = np.flatnonzero(ends) - self.first
        self.text = np.searchsorted(offsets, self.first, "right") - 1
        other = ~(_LETTER[data] | accented) & (kind > 0)
        self.letters = ~np.logical_or.reduceat(other, self.first) & plain if len(self.first) else np.zeros(0, bool)


def _distinct(*keys: np.ndarray) -> np.ndarray:
    """Where each different row of keys first stands, in the order of keys."""
    order = np.lexsort(keys)
    first = np.ones(len(order), bool)
    first[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    return order[first]


def _part_ends(data: np.ndarray) -> list[int]:
    """Where parts of about ``PART`` bytes end: behind white space, or at the end."""
    ends = [0]
    while ends[-1] < len(data):
        at = ends[-1] + PART
        space = np.flatnonzero(_KINDS[data[at : at + PART]] == 0)
        while not len(space) and at < len(data):
            at += PART
            space = np.flatnonzero(_KINDS[data[at : at + PART]] == 0)
        ends.append(at + int(space[0]) + 1 if len(space) else len(data))
    return ends[1:]


class PieceIds:
    """Ids of pieces without ASCII white space."""

    def __init__(self, path: str, most: int = CACHE):
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.most = most
        self.step = min(STEP, max(1, most // 2))
        self.slots = np.full(1 << max(4, (4 * most - 1).bit_length()), -1, np.int32)
        # One entry more than there may be, which no piece equals: empty slots (-1) point to it.
        self.low, self.high = np.zeros(most + 1, np.uint64), np.zeros(most + 1, np.uint64)
        self.length = np.zeros(most + 1, np.uint8)
        self.first, self.size = np.zeros(most + 1, np.int64), np.zeros(most + 1, np.int64)
        self.hits = np.zeros(most + 1, np.int32)
        self.flat = np.zeros(1 << 16, np.int32)
        self.count = self.used = 0

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a piece: one of letters only goes to the merges at once, as the characters that its bytes are written as."""
        if len(piece) < LONG:
            text = piece.decode("utf-8", "replace")
            if text.isalpha() and not _ODD & set(text) and unicodedata.is_normalized("NFC", text):
                return [t.id for t in self.merge(text.lower().encode().decode("latin-1").translate(_WRITTEN))]
        return self.tokenizer.encode(piece.decode("utf-8", "replace"), add_special_tokens=False).ids

    def _keys(self, cut: Cut, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each short piece's bytes as two numbers, and where its search begins."""
        padded = np.concatenate((cut.data, np.zeros(SHORT, np.uint8)))
        eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        first, size = cut.first[at], cut.size[at]
        low = eight[first] & _MASKS[np.minimum(size, 8)]
        high = eight[first + 8] if len(first) else low
        high = high & _MASKS[np.maximum(size - 8, 0)]
        begin = _bytes.mix(low ^ _bytes.mix(high + size.astype(np.uint64)))
        return low, high, (begin & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The entry of each piece, or -1."""
        out = self.slots[begin]
        todo = np.flatnonzero((out >= 0) & ((self.low[out] != low) | (self.high[out] != high) | (self.length[out] != size)))
        at = begin[todo]
        while len(todo):
            at = (at + 1) & (len(self.slots) - 1)
            entry = self.slots[at]
            out[todo] = entry
            other = (entry >= 0) & ((self.low[entry] != low[todo]) | (self.high[entry] != high[todo]) | (self.length[entry] != size[todo]))
            todo, at = todo[other], at[other]
        return out

    def _seat(self, entries: np.ndarray, begin: np.ndarray) -> None:
        """Gives new entries their slots."""
        while len(entries):
            free = np.flatnonzero(self.slots[begin] < 0)
            won = free[np.unique(begin[free], return_index=True)[1]]
            self.slots[begin[won]] = entries[won]
            left = np.ones(len(entries), bool)
            left[won] = False
            entries, begin = entries[left], (begin[left] + 1) & (len(self.slots) - 1)

    def _room(self) -> None:
        """Keeps what was met in most steps, half of the cache at most."""
        order = np.argsort(-self.hits[: self.count], kind="stable")[: self.most // 2]
        keep = order[self.hits[order] > 1]
        ids, bounds = self._gather(keep)
        for values in (self.low, self.high, self.length, self.hits, self.size):
            values[: len(keep)] = values[keep]
        self.hits[: len(keep)] //= 2
        self.first[: len(keep)] = bounds[:-1]
        self.flat[: len(ids)] = ids
        self.count, self.used = len(keep), len(ids)
        self.slots[:] = -1
        begin = _bytes.mix(self.low[: self.count] ^ _bytes.mix(self.high[: self.count] + self.length[: self.count].astype(np.uint64)))
        self._seat(np.arange(self.count, dtype=np.int32), (begin & np.uint64(len(self.slots) - 1)).astype(np.int64))

    def _append(self, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Writes ids behind those in use: where each list begins, its length."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        first = self.used + np.cumsum(sizes) - sizes
        end = self.used + int(sizes.sum())
        if end > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.used], np.zeros(2 * end - self.used, np.int32)))
        self.flat[self.used : end] = np.fromiter(chain.from_iterable(ids), np.int32, end - self.used)
        return first, sizes

    def _gather(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._runs(self.first[entries], self.size[entries])

    def _runs(self, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        return self.flat[np.repeat(first - bounds[:-1], sizes) + np.arange(bounds[-1])], bounds

    def _step(self, cut: Cut, lo: int, hi: int, written: str, whole: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds by piece) of the pieces lo to hi."""
        size = cut.size[lo:hi]
        short = np.flatnonzero(size <= SHORT)
        low, high, begin = self._keys(cut, lo + short)
        found = self._find(low, high, size[short], begin)
        if self.count + np.count_nonzero(found < 0) > self.most:
            self._room()
            found = self._find(low, high, size[short], begin)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = missing[_distinct(low[missing], high[missing], size[short][missing])]
            at = lo + short[new]
            ids = [
                [t.id for t in self.merge(written[a : a + n])] if letters else self.encode(whole[a : a + n])
                for a, n, letters in zip(cut.first[at].tolist(), cut.size[at].tolist(), cut.letters[at].tolist())
            ]
            entries = np.arange(self.count, self.count + len(new), dtype=np.int32)
            self.low[entries], self.high[entries], self.length[entries] = low[new], high[new], size[short][new]
            self.first[entries], self.size[entries] = self._append(ids)
            self.hits[entries] = 0
            self.count += len(new)
            self.used += int(self.size[entries].sum())
            self._seat(entries, begin[new])
            found[missing] = self._find(low[missing], high[missing], size[short][missing], begin[missing])
        met = np.zeros(self.count, bool)
        met[found] = True
        self.hits[: self.count] += met
        first, sizes = np.empty(hi - lo, np.int64), np.empty(hi - lo, np.int64)
        first[short], sizes[short] = self.first[found], self.size[found]
        long = np.flatnonzero(size > SHORT)
        if len(long):
            a, n = cut.first[lo + long].tolist(), size[long].tolist()
            ids = [self.encode(whole[x : x + y]) for x, y in zip(a, n)]
            first[long], sizes[long] = self._append(ids)
        return self._runs(first, sizes)

    def texts(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        ids, bounds = self.flat_texts(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
        return np.split(ids, bounds[1:-1]) if texts else []

    def flat_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds by text) of the texts. One long text is taken in parts that end at white space."""
        if len(offsets) == 2 and len(data) > 2 * PART:
            ends = _part_ends(data)
            ids = np.concatenate([self._texts(data[a:b], np.array([0, b - a]))[0] for a, b in zip([0, *ends[:-1]], ends)])
            return ids, np.array([0, len(ids)])
        return self._texts(data, offsets)

    def _texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = Cut(data, offsets)
        whole = cut.data.tobytes()
        written = _CHARACTERS[cut.data].tobytes().decode("utf-16-le")
        steps = [self._step(cut, lo, min(lo + self.step, len(cut.first)), written, whole) for lo in range(0, len(cut.first), self.step)]
        counts = np.concatenate([np.diff(b) for _, b in steps] or [np.zeros(0, np.int64)])
        bounds = np.concatenate(([0], np.cumsum(counts)))
        ids = np.concatenate([i for i, _ in steps] or [np.zeros(0, np.int32)])
        return ids, bounds[np.searchsorted(cut.text, np.arange(len(offsets)))]


def forget() -> None:
    """Drops this worker's caches: for stages that tokenise nothing."""
    _OWN.clear()


def pieces(path: str) -> PieceIds:
    """This worker's cache for a vocabulary file."""
    if path not in _OWN:
        _OWN[path] = PieceIds(path)
    return _OWN[path]


def flat_ids(column: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids of the texts with ``END`` behind each, bounds by text), slice by slice; null texts are empty."""
    cache = pieces(path)
    for first, data, offsets in _bytes.slices(column):
        ids, bounds = cache.flat_texts(data, offsets)
        yield first, np.insert(ids, bounds[1:], END), bounds + np.arange(len(bounds))


def column_ids(column: pa.Array, path: str) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, ids of each text and then ``END``), slice by slice; null texts are empty."""
    for first, ids, bounds in flat_ids(column, path):
        yield first, np.split(ids, bounds[1:-1])


def cut(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, number in it, start, end) of the texts' pieces of at most size ids."""
    counts = -(-np.diff(bounds) // size)
    text = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = bounds[text] + number * size
    return text, number, start, np.minimum(start + size, bounds[text + 1])


def default_path() -> str:
    """The vocabulary file that the queries use."""
    return public_tokenizers.path(VOCABULARY)
