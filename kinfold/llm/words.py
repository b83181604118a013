"""Words and word hashes of many texts at once, on the UTF-8 bytes of Arrow string columns.

Word definitions here depend on single bytes only, so whole batches are split and hashed with array
operations. Every byte of a text is read; slices and segments bound the memory, not the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # texts handled together; one longer text is a slice of its own
_SEGMENT = 1 << 20  # bytes hashed together; one longer word is a segment of its own
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SPACED = np.ones(256, bool)  # [^\x20\x09-\x0D]+
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = (
    True
)


class Words(NamedTuple):
    """Words in text order: row in the slice, first byte, byte after the last, hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    code = np.arange(256, dtype=np.uint64)
    if lower:
        code[65:91] += np.uint64(32)
    return mix(code * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D))


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; far faster here than a hash-based ``unique``."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


class _Powers:
    """Powers of the base and its inverse, grown to the longest segment seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_POWERS = _Powers()


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``most`` bytes of text, of one row at least."""
    _, offsets = text_bytes(batch.column(text))
    first, n = 0, batch.num_rows
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(last, first + 1))
        yield batch.slice(first, last - first)
        first = last


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without gaps, and where each row begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split_words(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = SPACED, lower: bool = False
) -> Words:
    """All words of the rows of ``text_bytes``; ``lower`` hashes A-Z as a-z."""
    empty = np.zeros(0, np.int64)
    if not len(data):
        return Words(empty, empty, empty, empty.astype(np.uint64))
    inside = kind[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    opens[edges] = inside[edges]
    closes[edges[1:] - 1] = inside[edges[1:] - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(row, start, end, _hashes(data, start, end, _VALUES[lower]))


def _hashes(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray
) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    first = 0
    while first < len(start):
        base = start[first]
        last = max(first + 1, int(np.searchsorted(end, base + _SEGMENT, "right")))
        size = int(end[last - 1] - base)
        _POWERS.upto(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[base : base + size]] * _POWERS.up[:size], out=sums[1:])
        a, b = start[first:last] - base, end[first:last] - base
        out[first:last] = (sums[b] - sums[a]) * _POWERS.down[a]
        first = last
    return mix(out + (end - start).astype(np.uint64))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of given byte spans, in order and without overlap."""
    return _hashes(data, start, end, _VALUES[False])


def windows(word_hash: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` consecutive words, whatever rows they are in."""
    n = len(word_hash) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(length):  # Horner's rule
        total *= _BASE
        total += word_hash[i : i + n]
    return mix(total + np.uint64(length))


def row_spans(row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and word after the last of every row."""
    at = np.searchsorted(row, np.arange(rows + 1))
    return at[:-1], at[1:]


def within_row(row: np.ndarray, length: int) -> np.ndarray:
    """For every run of ``length`` words, whether all of them are in one row."""
    n = len(row) - length + 1
    return row[:n] == row[length - 1 :] if n > 0 else np.zeros(0, bool)


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in one of the given windows."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def run_hashes(word_hash: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A hash of the words from ``first`` to before ``after``, for runs of any length."""
    n = len(word_hash)
    _POWERS.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(word_hash * _POWERS.up[:n], out=sums[1:])
    return mix((sums[after] - sums[first]) * _POWERS.down[first] + (after - first).astype(np.uint64))


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` values, the place of the leftmost smallest one."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[left] <= values[right], left, right)
        size += step
    return best
