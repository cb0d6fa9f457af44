"""Words and shingles of many texts at once, as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D. A..Z count as a..z. Words and shingles are 64-bit
hashes of all their bytes, the same on every machine. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

# The constants of the splitmix64 generator.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

# Bytes of text worked on at a time; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, end to end, and where each text starts (and the last one ends)."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes of text together, one row at least."""
    _, offsets = utf8(column)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = max(start + 1, stop)
        yield start, min(stop, len(column))
        start = stop


def word_spans(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words before each text (and after the last).

    ``between`` says of each byte whether it is between words.
    """
    inside = ~between[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = True
    before[1:] = ~inside[:-1]
    starts = np.flatnonzero(inside & (before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = True
    after[:-1] = ~inside[1:]
    ends = np.flatnonzero(inside & (after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, taken eight at a time."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = ends - starts
    hashes = mix(length.astype(np.uint64) * GOLDEN)
    live, at, left = slice(None), starts, length
    while len(at):
        chunk = eight[at]
        short = np.minimum(left, 8).astype(np.uint64)
        chunk = np.where(short == 8, chunk, chunk & ((np.uint64(1) << (short * np.uint64(8) % np.uint64(64))) - np.uint64(1)))
        hashes[live] = mix((hashes[live] ^ chunk) + GOLDEN)
        more = left > 8
        live = np.flatnonzero(more) if isinstance(live, slice) else live[more]
        at, left = at[more] + 8, left[more] - 8
    return hashes


def words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and the number of words before each text (and after the last)."""
    data, offsets = utf8(column)
    starts, ends, counts = word_spans(data, offsets)
    return hash_spans(LOWER[data] if lower else data, starts, ends), counts


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` consecutive words, also across texts; empty if there are too few."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    joined = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        joined = mix((joined ^ hashes[k : len(hashes) - size + 1 + k]) * GOLDEN + np.uint64(k + 1))
    return joined


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingles of ``size`` words; the whole sequence as one if it is shorter."""
    hashes, counts = words(column)
    runs = windows(hashes, size)
    for start, stop in zip(counts[:-1].tolist(), counts[1:].tolist(), strict=True):
        if stop - start >= size:
            yield np.unique(runs[start : stop - size + 1])
        else:
            yield windows(hashes[start:stop], stop - start) if stop > start else np.zeros(0, np.uint64)
