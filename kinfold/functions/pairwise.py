"""Strings of a batch compared pair by pair with array operations.

The helpers run inside tasks, on Arrow columns that Spark has dealt. Characters are code points.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa

from kinfold.functions.measure import (
    BOOST_ABOVE,
    LETTER_CLASSES,
    PREFIX_LENGTH,
    PREFIX_WEIGHT,
    needed,
)

CELLS_AT_ONCE = 400_000  # characters of the pairs that are compared together; bounds the memory
TABLE_AT_ONCE = 100_000  # pairs of different values whose levels are taken together
_LONG = 48  # from this length on, the positions of the second string are one array operation
_ROUNDING = 1e-12


class Words:
    """The characters of an Arrow column of strings; a null has none."""

    def __init__(self, texts: pa.Array) -> None:
        texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        raw = raw[at[0] : at[-1]]
        if (raw < 128).all():
            self.codes, self.first, self.length = raw, at[:-1] - at[0], np.diff(at)
        else:
            starts = np.append((raw & 0xC0) != 0x80, True)
            starts[at - at[0]] = True
            places = np.flatnonzero(starts)
            size = np.diff(places)
            code = raw[places[:-1]].astype(np.uint32)
            for k in range(1, 4):  # any numbers that tell characters apart
                more = size > k
                code[more] |= raw[places[:-1][more] + k].astype(np.uint32) << np.uint32(8 * k)
            before = np.searchsorted(places, at - at[0])
            self.codes, self.first, self.length = code, before[:-1], np.diff(before)

    def letter_bits(self) -> np.ndarray:
        """``letter_bits`` of every string."""
        letter = (self.codes >= 97) & (self.codes <= 122)
        owner = np.repeat(np.arange(len(self.length)), self.length)[letter]
        kind = (self.codes[letter].astype(np.int64) - 97) % LETTER_CLASSES
        cells = len(self.length) * LETTER_CLASSES
        seen = np.bincount(owner * LETTER_CLASSES + kind, minlength=cells)
        seen = seen.reshape(-1, LETTER_CLASSES)
        bits = np.zeros((len(self.length), 64), bool)
        for i in range(3):
            bits[:, LETTER_CLASSES * i : LETTER_CLASSES * (i + 1)] = seen > i
        return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()

    def columns(self, chosen: np.ndarray, width: int, fill: int, kind: type) -> np.ndarray:
        """Character k of the chosen strings in row k, ``fill`` behind their ends."""
        first, length = self.first[chosen], self.length[chosen]
        codes = np.append(self.codes, np.zeros(width, self.codes.dtype)).astype(kind, copy=False)
        out = np.empty((width, len(chosen)), kind)
        for k in range(width):
            out[k] = codes[first + k]
            out[k][length <= k] = fill
        return out


def _matches(
    a: np.ndarray, b: np.ndarray, longest: np.ndarray, start: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which characters of both sides match; pairs are in falling order of their longest string.

    A character takes the first free equal one inside the window, so the pairs whose window holds two
    positions always come first. The first ``start`` ones are equal in all pairs and match each other.
    """
    width, pairs = a.shape
    reach = np.maximum(longest // 2 - 1, 0)
    used, free = np.zeros((width, pairs), bool), np.ones((width, pairs), bool)
    used[:start], free[:start] = True, False
    longer = [int(np.searchsorted(-longest, -k, "left")) for k in range(width)]  # than k
    wider = [int(np.searchsorted(-reach, -k, "right")) for k in range(int(reach[0]) + 1)]
    for i in range(start, width):
        waits = np.ones(pairs, bool)
        for j in range(max(start, i - len(wider) + 1), min(width, i + len(wider))):
            n = min(longer[max(i, j)], wider[abs(i - j)])
            hit = a[i, :n] == b[j, :n]
            hit &= free[j, :n]
            hit &= waits[:n]
            free[j, :n] ^= hit
            waits[:n] ^= hit
        used[i] = ~waits
    return used, ~free


def _matches_of_long(
    a: np.ndarray, b: np.ndarray, longest: np.ndarray, start: int
) -> tuple[np.ndarray, np.ndarray]:
    """As ``_matches``, with all positions of the second string at once."""
    width, pairs = a.shape
    reach = np.maximum(longest // 2 - 1, 0)[:, None]
    used, free = np.zeros((width, pairs), bool), np.ones((pairs, width), bool)
    used[:start], free[:, :start] = True, False
    second, most = np.ascontiguousarray(b.T), int(reach.max())
    for i in range(start, width):
        low, high = max(start, i - most), min(width, i + most + 1)
        hit = (second[:, low:high] == a[i][:, None]) & free[:, low:high]
        hit &= np.abs(np.arange(low, high) - i) <= reach
        at = hit.argmax(axis=1)
        used[i] = hit[np.arange(pairs), at]
        free[used[i], low + at[used[i]]] = False
    return used, ~free.T


def _jaro_winkler(
    left: Words, right: Words, a: np.ndarray, b: np.ndarray, longest: np.ndarray
) -> np.ndarray:
    width = int(longest[0])
    top = max(int(w.codes.max(initial=0)) for w in (left, right))
    kind = np.uint8 if top < 254 else np.int64
    one, two = left.columns(a, width, top + 1, kind), right.columns(b, width, top + 2, kind)
    start = 0
    while start < width and (one[start] == two[start]).all():
        start += 1
    used, taken = (_matches if width < _LONG else _matches_of_long)(one, two, longest, start)
    found = used.sum(axis=0)
    differs = one.T[used.T] != two.T[taken.T]
    moved = np.bincount(np.repeat(np.arange(len(a)), found)[differs], minlength=len(a)) // 2
    m = np.maximum(found, 1).astype(np.float64)
    jaro = (m / left.length[a] + m / right.length[b] + (m - moved) / m) / 3.0
    prefix, same = np.zeros(len(a)), np.ones(len(a), bool)
    for k in range(min(PREFIX_LENGTH, width)):
        same &= one[k] == two[k]
        prefix += same
    boosted = jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro)
    return np.where(found > 0, np.where(jaro > BOOST_ABOVE, boosted, jaro), 0.0)


def jaro_winkler(left: Words, right: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaro-Winkler similarity of the different, non-empty strings ``left[a]`` and ``right[b]``."""
    out = np.zeros(len(a))
    longest = np.maximum(left.length[a], right.length[b])
    order = np.argsort(-longest, kind="stable")
    start = 0
    while start < len(order):
        part = order[start : start + max(1, CELLS_AT_ONCE // int(longest[order[start]]))]
        out[part] = _jaro_winkler(left, right, a[part], b[part], longest[part])
        start += len(part)
    return out


class Column:
    """A compared column of a batch: the pairs' levels as ``similarity_level`` or equality gives them.

    If the levels of all its different values are fewer than ``pairs``, they are taken once.
    """

    def __init__(self, values: pa.Array, thresholds: Sequence[float], pairs: int = 0) -> None:
        encoded = values.dictionary_encode()
        self.value = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        self.thresholds = sorted(thresholds)
        if thresholds:
            self.words = Words(encoded.dictionary.cast(pa.string()))
            self.bits = self.words.letter_bits()
            start = np.minimum(self.words.length, PREFIX_LENGTH)
            codes = np.append(self.words.codes, 0)
            end = len(self.words.codes)
            self.start = [
                np.where(start > k, codes[np.minimum(self.words.first + k, end)], -1 - k)
                for k in range(PREFIX_LENGTH)
            ]
            self.share = np.array([needed(self.thresholds[0], p) for p in range(PREFIX_LENGTH + 1)])
        self.table, kinds = None, len(encoded.dictionary) + 1  # a null is the last one, -1
        if kinds * kinds <= pairs:
            every = np.r_[np.arange(kinds - 1), -1]
            step = max(1, TABLE_AT_ONCE // kinds)
            parts = [every[k : k + step] for k in range(0, kinds, step)]
            found = [self._between(p.repeat(kinds), np.tile(every, len(p))) for p in parts]
            self.table = np.concatenate(found).astype(np.int8).reshape(kinds, kinds)

    def _may_reach(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """False only if two different strings certainly stay below the lowest threshold."""
        size_a, size_b = self.words.length[a], self.words.length[b]
        bits_a, bits_b = self.bits[a], self.bits[b]
        most = np.minimum(
            size_a - np.bitwise_count(bits_a & ~bits_b), size_b - np.bitwise_count(bits_b & ~bits_a)
        )
        prefix, same = np.zeros(len(a), np.int64), np.ones(len(a), bool)
        for first in self.start:
            same &= first[a] == first[b]
            prefix += same
        share = self.share[prefix] - _ROUNDING
        return (most * (size_a + size_b) >= share * size_a * size_b) & (size_a > 0) & (size_b > 0)

    def levels(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.value[i], self.value[j]
        return self._between(a, b) if self.table is None else self.table[a, b]

    def _between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        level = np.where(a == b, len(self.thresholds) + 1, 0)
        level[(a < 0) | (b < 0)] = -1
        if self.thresholds:
            rest = np.flatnonzero(level == 0)
            a, b = a[rest].astype(np.int64), b[rest].astype(np.int64)
            may = self._may_reach(a, b)
            rest, a, b = rest[may], a[may], b[may]
            once, back = np.unique(a * len(self.words.length) + b, return_inverse=True)
            a, b = once // len(self.words.length), once % len(self.words.length)
            similarity = jaro_winkler(self.words, self.words, a, b)
            level[rest] = sum((similarity >= t).astype(np.int64) for t in self.thresholds)[back]
        return level
