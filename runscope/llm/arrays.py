"""Numpy helpers on the byte buffers of Arrow batches, shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Whitespace of the text contracts: space and the controls from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Odd multipliers of the hashes, and their inverses modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and where each row begins; null is empty."""
    binary = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(binary, pa.ChunkedArray):
        binary = binary.combine_chunks()
    _, ends, data = binary.buffers()
    offsets = np.frombuffer(ends, np.int64, len(binary) + 1, binary.offset * 8) if len(binary) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `size` bytes together; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, last
        first = last


def words(buffer: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of word bytes inside one row."""
    inside = is_word[buffer]
    joined = inside[1:] & inside[:-1]
    inner = offsets[1:-1]
    joined[inner[(inner > 0) & (inner < len(buffer))] - 1] = False
    begins, ends = inside.copy(), inside
    begins[1:] &= ~joined
    ends[:-1] &= ~joined
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    return _powers(base, 1 << max(16, (max(n, 1) - 1).bit_length()))[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the low bits over all bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def range_hashes(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of values, the same wherever the range stands; ranges are in order and apart.

    Each value is mixed with its place in its range before the sum: no polynomial, whose value modulo 2^64 is the same for some long
    sequences whatever its base.
    """
    n = len(values)
    first = np.zeros(n, np.int64)
    first[begins] = begins
    place = (np.arange(n) - np.maximum.accumulate(first)).astype(np.uint64) if n else first.view(np.uint64)
    place *= np.uint64(BASES[1])
    place += values
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(place), out=sums[1:])
    return mixed(sums[ends] - sums[begins])


def window_hashes(values: np.ndarray, width: int, kind: int = 0) -> np.ndarray:
    """The hash of each `width` consecutive values, by the first one's place."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(BASES[kind], n), out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * powers(INVERSES[kind], n - width + 1))


def sliding_min(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of each `width` consecutive values and where it stands first, by doubling."""
    have, at = 1, np.arange(len(values), dtype=np.int32)
    while have < width:
        step = min(have, width - have)
        right = values[step:] < values[:-step]
        at = np.where(right, at[step:], at[:-step])
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values, at


def runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of runs of places; breaks[i]: a new run begins at i (0 always does)."""
    if not len(breaks):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = breaks.copy()
    breaks[0] = True
    begins = np.flatnonzero(breaks)
    return begins, np.append(begins[1:], len(breaks))


def spread(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """begins[i], begins[i] + 1, ... lengths[i] of them, for each i in turn."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(begins - firsts, lengths)
