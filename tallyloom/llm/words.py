"""Words of UTF-8 text and their 64-bit hashes, computed over whole Arrow blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The separators of ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Every ASCII character that is neither a letter nor a digit.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
SAME = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, all other bytes as they are.
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit integers over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64; long ones are not kept."""
    if len(known := _powers.get(base, ())) < n:
        known = np.full(max(n, 1 << 18), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 1 << 20:
            _powers[base] = known
    return known[:n]


def prefix_sums(data: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    """Sums that give the polynomial hash of any byte range, see :func:`range_hash`."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[fold][data] * powers(_BASE, len(data)), out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges; equal bytes of equal length hash alike at any place."""
    length = (end - start).astype(np.uint64)
    raw = (sums[end] - sums[start]) * powers(_INVERSE, len(sums))[start]
    return mix(raw + length * np.uint64(0xA0761D6478BD642F))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of runs of whole rows, of about ``limit`` bytes at most.

    A longer text is a block of its own, so memory follows the longest text.
    """
    data, offsets = text_bytes(column)
    row = 0
    while row < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        last = max(last, row + 1)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (plus total)."""
    inside = ~separators[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray,
    offsets: np.ndarray,
    separators: np.ndarray = SPACE,
    fold: np.ndarray = SAME,
) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the block, and for each row the index of its first word."""
    starts, ends, first = word_bounds(data, offsets, separators)
    return range_hash(prefix_sums(data, fold), starts, ends), first


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words, which may cross rows."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += words[k : k + n] * np.uint64(pow(_BASE, k + 1, 1 << 64))
    return mix(total)
