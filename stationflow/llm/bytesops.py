"""Vectorised helpers over the bytes of a batch of texts, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# White space of the word pattern [^\x20\x09-\x0D]+.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(42).integers(1, 1 << 63, 256, dtype=np.uint64)
# Texts are worked on about so many bytes at a time.
SLICE = 1 << 20
# Powers up to this one are kept by a worker; those for a longer text are made for it and dropped.
KEPT = 1 << 22


def _made(size: int) -> tuple[np.ndarray, np.ndarray]:
    for_base, for_inverse = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
    for_base[0] = for_inverse[0] = 1
    return np.cumprod(for_base), np.cumprod(for_inverse)


_kept = _made(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse modulo 2^64 to the powers 0 to n."""
    global _kept
    if n > KEPT:
        return _made(n + 1)
    if len(_kept[0]) <= n:
        _kept = _made(min(max(n, 2 * len(_kept[0])), KEPT) + 1)
    return _kept


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its offsets; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of at most so many bytes together; one longer row makes a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def text_slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, bytes, offsets) of the column, about a megabyte at a time."""
    raw, offsets = text_buffer(column)
    for first, last in slices(offsets, limit):
        low, high = offsets[first], offsets[last]
        yield first, last, raw[low:high], offsets[first : last + 1] - low


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of true bytes; no run crosses rows."""
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[heads] = inside[heads]
    end[heads[1:] - 1] = inside[heads[1:] - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, "right") - 1


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words."""
    return spans(~WHITE[raw], offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Polynomial sums of the bytes before each position, modulo 2^64."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[raw] * powers(len(raw))[0][: len(raw)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    inverse = powers(len(sums))[1]
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of a list column without nulls, one pair for each length of its lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, values[offsets[rows][:, None] + np.arange(length)]
