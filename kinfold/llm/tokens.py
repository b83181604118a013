"""Token ids of many texts at once.

A byte-level BPE never joins what stands before a run of white space with what follows it, so a text
can be cut there into units, and a unit's ids do not depend on its neighbours. Units repeat a lot: a
task encodes each one once with the tokenizer and fetches the ids of the others from its cache.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from kinfold.llm import words as wd

_CACHE = 600_000  # units kept by a worker; only a matter of memory
# Fixed value: how byte-level BPE cuts text before merging.
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_PROBES = ("It's 12,345 words…", "  two\n\n\tÜber straße", "語 \u00a0 x", "naïve🙂don't")
_LATIN = 0xC3  # lead byte of U+00C0 to U+00FF, none of which is white space


def _unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the units: row starts and the starts of runs of ASCII white space.

    No cut after a byte that may end another white space character (those are longer than a byte
    or control characters), as a run of white space must not be cut inside.
    """
    space = ~wd.SPACED[data]
    cut = space.copy()
    plain = (data < 0x80) & (data >= 0x21)
    before = np.zeros(len(data), np.uint8)
    before[1:] = data[:-1]
    plain |= (data >= 0x80) & (before == _LATIN)
    cut[1:] &= plain[:-1]
    cut[:1] = False
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for every byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids by the tokenizer file at ``path``, without special tokens added.

    ``plain`` takes the strings of special tokens in a text as ordinary text.
    """

    def __init__(self, path: str, plain: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = plain
        self._special = tuple(t.content for t in self._tokenizer.get_added_tokens_decoder().values())
        self._fast = self._same_ranks()
        self._clear()

    def _same_ranks(self):
        """The vocabulary as merge ranks for tiktoken, which is several times as fast on units.

        Only where the two agree on a probe; None otherwise.
        """
        import tiktoken

        byte = _byte_letters()
        ranks = {
            bytes(byte[c] for c in token): rank
            for token, rank in self._tokenizer.get_vocab(with_added_tokens=False).items()
            if token not in self._special and all(c in byte for c in token)
        }
        try:
            fast = tiktoken.Encoding(
                "units", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
            same = all(
                fast.encode_ordinary(p) == self._tokenizer.encode(p, add_special_tokens=False).ids
                for p in _PROBES
            )
        except (ValueError, KeyError):
            return None
        return fast if same else None

    def _encode_units(self, units: list[str]) -> list[list[int]]:
        if self._fast is None:
            return [e.ids for e in self._tokenizer.encode_batch(units, add_special_tokens=False)]
        plain = self._fast.encode_ordinary
        return [
            self._tokenizer.encode(u, add_special_tokens=False).ids
            if any(s in u for s in self._special)
            else plain(u)
            for u in units
        ]

    def _clear(self) -> None:
        self._known = np.zeros(0, np.uint64)  # sorted hashes of units
        self._place = np.zeros(0, np.int64)  # where their ids begin in the pool
        self._size = np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        ids = self._encode_units(units)
        size = np.array([len(i) for i in ids], np.int64)
        place = len(self._pool) + np.cumsum(size) - size
        flat = np.fromiter((x for i in ids for x in i), np.uint32, int(size.sum()))
        known = np.concatenate([self._known, hashes])
        order = np.argsort(known)
        self._known = known[order]
        self._place = np.concatenate([self._place, place])[order]
        self._size = np.concatenate([self._size, size])[order]
        self._pool = np.concatenate([self._pool, flat])

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self._known, hashes)
        at[at == len(self._known)] = 0
        hit = self._known[at] == hashes if len(self._known) else np.zeros(len(hashes), bool)
        return at, hit

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id; what is no byte-level entry stands for its own UTF-8."""
        byte = _byte_letters()
        vocabulary = self._tokenizer.get_vocab()
        out = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            level = all(c in byte for c in token)
            out[at] = bytes(byte[c] for c in token) if level else token.encode()
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of every text; null is empty."""
        data, offsets = wd.text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        start = _unit_starts(data, offsets)
        end = np.r_[start[1:], len(data)]
        hashes = wd.span_hashes(data, start, end)
        order = np.argsort(hashes)
        new = np.r_[True, hashes[order[1:]] != hashes[order[:-1]]]
        unique, example = hashes[order[new]], order[new]
        _, hit = self._find(unique)
        if not hit.all():
            if len(self._known) + len(unique) > _CACHE:
                self._clear()
                hit[:] = False
            raw = data.tobytes()
            missing = example[~hit]
            self._learn(
                unique[~hit], [raw[start[i] : end[i]].decode() for i in missing]
            )
        at, _ = self._find(unique)
        which = np.empty(len(hashes), np.int64)
        which[order] = at[np.cumsum(new) - 1]
        size, place = self._size[which], self._place[which]
        first = np.cumsum(size) - size
        ids = self._pool[np.arange(int(size.sum())) + np.repeat(place - first, size)]
        row = np.searchsorted(offsets, start, "right") - 1
        counts = np.bincount(row, size, len(texts)).astype(np.int64)
        return ids, counts


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """The encoder of this worker for a tokenizer file."""
    if (path, plain) not in _ENCODERS:
        _ENCODERS[path, plain] = Encoder(path, plain)
    return _ENCODERS[path, plain]
