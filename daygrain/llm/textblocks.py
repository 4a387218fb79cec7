"""Words and hashes of whole columns of text, as numpy arrays over Arrow's own buffers.

Texts are worked on in blocks of bounded size, so that a task's memory does not depend on how
many rows a batch has. A single text longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21
BLOCK_ROWS = 1024

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the SplitMix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _PRIME)
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, BLOCK_BYTES + 1)
        for_base = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            for_base.append(np.multiply.accumulate(steps))
        _powers, _inverses = for_base
    return _powers, _inverses


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its offsets into them; NULL is like an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    kind = np.dtype(np.int64 if wide else np.int32)
    if places is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, kind, len(column) + 1, column.offset * kind.itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of at most `rows` rows of about `size` bytes."""
    data, offsets = buffers(column)
    n, start = len(offsets) - 1, 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(n, start + rows, max(end, start + 1))
        yield start, end, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text the place of its first word (n + 1)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    white = _WHITE[data]
    first, last = np.empty_like(white), np.empty_like(white)
    first[0], first[1:] = True, white[:-1]
    last[-1], last[:-1] = True, white[1:]
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    dark = ~white
    starts = np.flatnonzero(dark & first)
    ends = np.flatnonzero(dark & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * powers[: len(data)], out=sums[1:])
    code = (sums[ends] - sums[starts]) * inverses[starts]
    return mix64(code + (ends - starts).astype(np.uint64) * _PRIME)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all else as it is."""
    return _LOWER[data]


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` words: n - length + 1 of them, order counts."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    code = np.zeros(n, np.uint64)
    for k in range(length):
        code *= np.uint64(_BASE)
        code += words[k : k + n]
    return mix64(code)


def stretch_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the values from `first` to `last` (included): equal for equal ones, wherever they stand."""
    powers, inverses = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix64(values) * powers[: len(values)], out=sums[1:])
    return mix64((sums[last + 1] - sums[first]) * inverses[first])


def shingle_sets(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its runs of `length` lower-cased words) for each row.

    A text with fewer words has one run, its whole sequence; one without words has none.
    """
    for start, end, data, offsets in blocks(column):
        data = lowered(data)
        starts, ends, first = word_bounds(data, offsets)
        words = span_hashes(data, starts, ends)
        runs = run_hashes(words, length)
        for k in range(end - start):
            a, b = first[k], first[k + 1]
            if b - a >= length:
                yield start + k, np.unique(runs[a : b - length + 1])
            elif b > a:
                yield start + k, run_hashes(words[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                yield start + k, np.zeros(0, np.uint64)
