"""Texts of an Arrow batch as flat numpy arrays: row blocks of bounded size, words, 64-bit hashes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once inside a task; a longer text is a block of its own.
BLOCK_BYTES = 1 << 21
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def randoms(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers of a seed."""
    step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(step + np.uint64(seed * 0xD1B54A32D192ED03 % (1 << 64))) | np.uint64(1)


def folded() -> np.ndarray:
    """Byte table that lower-cases A-Z."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


class Texts:
    """Some rows of a string column: their UTF-8 bytes one after another, and where each row begins and ends."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def text(self, lo: int, hi: int) -> str:
        return self.data[lo:hi].tobytes().decode("utf-8", "replace")


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Texts]:
    """The rows in order (null as empty), in blocks of at most limit bytes or one row."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield Texts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def give_back() -> None:
    """What a task has freed goes back to the system, since Spark keeps its worker for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


class Words:
    """Maximal runs of word bytes: start and end offset, and the row of each."""

    def __init__(self, texts: Texts, is_word: np.ndarray):
        mask = is_word[texts.data]
        before = np.zeros(len(mask), bool)
        before[1:] = mask[:-1]
        edges = texts.bounds[:-1][texts.bounds[:-1] < len(mask)]
        before[edges] = False
        after = np.zeros(len(mask), bool)
        after[:-1] = mask[1:]
        last = texts.bounds[1:] - 1
        after[last[last >= 0]] = False
        self.start = np.flatnonzero(mask & ~before)
        self.end = np.flatnonzero(mask & ~after) + 1
        self.row = np.searchsorted(texts.bounds, self.start, "right") - 1
        self.texts = texts

    def __len__(self) -> int:
        return len(self.start)

    def per_row(self, values: np.ndarray | None = None) -> np.ndarray:
        """Sum of the values (or count of words) of each row."""
        return np.bincount(self.row, values, len(self.texts)).astype(np.int64)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False, seed: int = 1) -> np.ndarray:
    """64-bit hash of each byte span; spans are in order and don't overlap. Two different spans meet by chance only (about 2^-56 a pair)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    where = np.arange(int(size.sum())) - np.repeat(at, size)
    of_byte = randoms(256, seed)
    values = (of_byte[folded()] if fold else of_byte)[data[np.repeat(start, size) + where]]
    values *= randoms(int(size.max()), seed + 1)[where]
    sums = np.add.reduceat(values, at)
    return mix(sums + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_hashes(hashes: np.ndarray, row: np.ndarray, width: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of width words inside a row, and the index of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(row[:n] == row[width - 1 :])
    total = np.zeros(len(first), np.uint64)
    for k, odd in enumerate(randoms(width, seed)):
        total += mix(hashes[first + k] + odd) * odd
    return mix(total), first


def struct_array(columns: dict[str, pa.Array | np.ndarray]) -> pa.StructArray:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.StructArray.from_arrays(arrays, names=list(columns))


def lists(values: pa.Array | np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """List column of the values, so many for each row."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def joined(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays([p.cast(kind) for p in parts]) if parts else pa.array([], kind)


def spread(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of runs one after another, from where each begins and how long it is."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(at - before, sizes) + np.arange(int(sizes.sum()))


class Memo:
    """Lists of numbers by 64-bit key, a bounded number of them: what was not asked for lately is forgotten and made anew."""

    def __init__(self, size: int, kind: type = np.int32):
        self.size, self.kind = size, kind
        self.young, self.old = self._empty(), self._empty()

    def _empty(self) -> tuple[np.ndarray, ...]:
        """Sorted keys, and of each where its values begin and how many there are; the values."""
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.kind)

    def __call__(self, keys: np.ndarray, make) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values of the distinct sorted keys: where each list begins, how long it is, and the values.

        make(indexes) gives sizes and values of the keys that are not known."""
        at, sizes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        missing = np.ones(len(keys), bool)
        offset = 0
        for place, (known, begins, lengths, values) in enumerate((self.young, self.old)):
            i = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
            hit = missing & (known[i] == keys) if len(known) else np.zeros(len(keys), bool)
            at[hit], sizes[hit] = begins[i[hit]] + offset, lengths[i[hit]]
            missing &= ~hit
            offset += len(values)
            if not place:
                fresh = hit
        new_sizes, new = make(np.flatnonzero(missing))
        sizes[missing], at[missing] = new_sizes, np.cumsum(new_sizes) - new_sizes + offset
        values = np.concatenate((self.young[3], self.old[3], new.astype(self.kind)))
        self._keep(keys[~fresh], sizes[~fresh], values[spread(at[~fresh], sizes[~fresh])])
        return at, sizes, values

    def _keep(self, keys: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> None:
        known, begins, lengths, held = self.young
        if len(known) + len(keys) > self.size // 2:
            self.old = self.young
            known, begins, lengths, held = self._empty()
        known = np.concatenate((known, keys))
        order = np.argsort(known, kind="stable")
        begins = np.concatenate((begins, len(held) + np.cumsum(sizes) - sizes))
        self.young = known[order], begins[order], np.concatenate((lengths, sizes))[order], np.concatenate((held, values))
