"""Words and hashes of whole Arrow columns of text, computed on the bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
"""Texts are taken in runs of about this many bytes, so that working arrays stay small."""

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def powers(base: int, size: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i below ``size``; the table grows with the longest request."""
    if len(_powers[base]) < size:
        table = np.full(max(size, CHUNK_BYTES * 2), base, np.uint64)
        table[0] = 1
        _powers[base] = np.multiply.accumulate(table)
    return _powers[base][:size]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them; NULL is empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, end row, bytes, offsets), about ``size`` bytes or one row each."""
    data, at = text_bytes(column)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def word_spans(data: np.ndarray, at: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that aren't ``blank``, and the number of them in each row."""
    return runs(~blank[data], at)


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, cut where rows begin, and the number of them in each row."""
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    if len(inside):
        firsts = at[:-1][at[:-1] < at[1:]]
        begins[firsts] = inside[firsts]
        lasts = at[1:][at[:-1] < at[1:]] - 1
        ends[lasts] = inside[lasts]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, at))
    return starts, np.flatnonzero(ends) + 1, counts


class SpanHasher:
    """64-bit hashes of spans of bytes, equal for equal bytes: differences of a running polynomial."""

    def __init__(self, data: np.ndarray):
        self.running = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * powers(_BASE, len(data)), out=self.running[1:])
        self.scale = powers(_INVERSE, len(data) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.running[ends] - self.running[starts]) * self.scale[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHasher(data)(starts, ends)


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row with A-Z lower-cased, in order, and their number by row."""
    low = LOWER[data]
    starts, ends, counts = word_spans(low, at)
    return span_hashes(low, starts, ends), counts
