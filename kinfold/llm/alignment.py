"""Alignment of the tokens of two tokenizers, and how often their ids are linked in the corpus.

A text is tokenised whole by both: A is a byte-level BPE, B a sentencepiece model. Every token is a
range of the bytes of a space and the text. Where tokens of both begin at the same byte, and both are
marked with a space, the ends before them are shared: such anchors split a document into windows of
token ids. How a window's tokens are grouped depends on its ids alone, so a task aligns each window
once and keeps the result by its two tuples of ids. In a batch, windows are found by hashes, and every
window is compared with the one that stands for it. A group ends where tokens of both end, and all its
A tokens are linked with all its B tokens.

The corpus-wide count of a pair of ids is the number of documents in which they are linked. Tasks number
the pairs of about ``CHUNK`` bytes of text; a document has a packed list of such numbers, and a
chunk one list of pairs with how many of its documents have them. Only the chunks' lists are summed and
joined: a pair that occurs in every document is one row per chunk. The sums go back to the documents by
chunk.

Defined results: null and empty texts, and texts that the tokens of A or B do not spell, have no
tokens. Every row is a document, repeated ones too. Extra columns stay, unless named like a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm import words as wd
from kinfold.llm.tokens import encoder
from kinfold.session import materialize

SLICE = 1 << 20  # bytes of text aligned together
CHUNK = 32 << 20  # bytes of text whose pairs are numbered together
_KEPT = 200_000  # window alignments kept by a worker; only a matter of memory
_LONG = 256  # tokens of a window that is aligned by itself and not kept
_B_BITS = 32
MARK = "▁"


class Vocabulary:
    """Bytes of every token id, one after another."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.size = np.array([len(t) for t in tokens], np.int64)
        self._place = np.cumsum(self.size) - self.size
        self._pool = np.frombuffer(b"".join(tokens), np.uint8)
        self.marked = np.array([t.startswith(b" ") for t in tokens])

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        first = np.cumsum(size) - size
        return self._pool[np.arange(int(size.sum())) + np.repeat(self._place[ids] - first, size)]


class Tokens(NamedTuple):
    """Ids of several texts in order, and how many each text has."""

    ids: np.ndarray
    counts: np.ndarray


class Tokenizers:
    """The two tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece

        self._a = encoder(path_a, plain=True)
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a = Vocabulary(self._a.token_bytes())
        self.b = Vocabulary([self._piece(i) for i in range(self._b.get_piece_size())])
        self.windows = Aligner(self.a, self.b)

    def _piece(self, at: int) -> bytes:
        piece = self._b.id_to_piece(at)
        if self._b.is_byte(at):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(MARK, " ").encode()

    def encode(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        a, counts = self._a.encode(pa.array([" " + t for t in texts], pa.large_string()))
        b = self._b.encode(texts, num_threads=1)
        sizes = np.array([len(x) for x in b], np.int64)
        flat = np.fromiter(chain.from_iterable(b), np.int64, int(sizes.sum()))
        return Tokens(a.astype(np.int64), counts), Tokens(flat, sizes)


_TOKENIZERS: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    if (path_a, path_b) not in _TOKENIZERS:
        _TOKENIZERS[path_a, path_b] = Tokenizers(path_a, path_b)
    return _TOKENIZERS[path_a, path_b]


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[k], first[k] + 1, …`` for every run, one after another."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(first - before, size)


def _unequal(ids: np.ndarray, first: np.ndarray, size: np.ndarray, stand: np.ndarray) -> np.ndarray:
    """Runs that differ from the run that stands for them (of the same size)."""
    same = ids[_runs(first[stand], size)] == ids[_runs(first, size)]
    sums = np.r_[0, np.cumsum(~same)]
    ends = np.cumsum(size)
    return sums[ends] > sums[ends - size]


class Windows(NamedTuple):
    """Alignments of windows: groups as text, their number and links, and the linked pairs.

    The pairs of window w are ``many[w]`` of ``pairs``, each ``times`` often (a pair may come again).
    """

    groups: list[str]
    n_groups: np.ndarray
    n_links: np.ndarray
    many: np.ndarray
    pairs: np.ndarray
    times: np.ndarray

    def take(self, at: np.ndarray) -> Windows:
        links = _runs((np.cumsum(self.many) - self.many)[at], self.many[at])
        return Windows(
            [self.groups[k] for k in at.tolist()],
            *(x[at] for x in (self.n_groups, self.n_links, self.many)),
            self.pairs[links],
            self.times[links],
        )

    def and_then(self, other: Windows) -> Windows:
        arrays = (np.concatenate(x) for x in zip(self[1:], other[1:], strict=True))
        return Windows(self.groups + other.groups, *arrays)


def _no_windows() -> Windows:
    return Windows([], *(np.zeros(0, np.int64) for _ in range(5)))


def _align_one(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> Windows:
    """One window whose groups have too many links to list them one by one."""
    ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    cuts = np.intersect1d(ends_a, ends_b)
    at_a = np.r_[0, np.searchsorted(ends_a, cuts) + 1]
    at_b = np.r_[0, np.searchsorted(ends_b, cuts) + 1]
    names, pairs, times, links = [], [], [], 0
    for k in range(len(cuts)):
        left, right = a[at_a[k] : at_a[k + 1]], b[at_b[k] : at_b[k + 1]]
        names.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
        (x, n), (y, m) = (np.unique(i, return_counts=True) for i in (left, right))
        pairs.append((x[:, None] << _B_BITS | y).ravel())
        times.append((n[:, None] * m).ravel())
        links += len(left) * len(right)
    flat = np.concatenate(pairs)
    counts = (np.array([n], np.int64) for n in (len(cuts), links, len(flat)))
    return Windows([";".join(names)], *counts, flat, np.concatenate(times))


class Aligner:
    """Aligns windows, and keeps the alignments by the ids of both sides."""

    def __init__(self, a: Vocabulary, b: Vocabulary) -> None:
        self.a, self.b = a, b
        self._names = [f"{i}{mark}" for i in range(len(a.size)) for mark in ",|"]
        self._names += [f"{i}{mark}" for i in range(len(b.size)) for mark in ",;"]
        self._clear()

    def _clear(self) -> None:
        self._hash, self._place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted by hash
        self._ids = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self._len = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self._kept = _no_windows()

    def _align(self, a: np.ndarray, len_a: np.ndarray, b: np.ndarray, len_b: np.ndarray) -> Windows:
        """All windows at once: as both sides of a window have the same bytes, ends can be compared
        over all of them."""
        size_a, size_b = self.a.size[a], self.b.size[b]
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        many_a, many_b = np.bincount(group_a), np.bincount(group_b)
        links = many_a * many_b
        first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        window = np.repeat(np.arange(len(len_a)), len_a)[first_a]  # of a group
        n_groups = np.bincount(window, minlength=len(len_a))

        of = np.repeat(np.arange(len(cuts)), links)
        k = _runs(np.zeros(len(cuts), np.int64), links)
        i, j = first_a[of] + k // many_b[of], first_b[of] + k % many_b[of]
        pairs = a[i] << _B_BITS | b[j]
        n_links = np.bincount(window, links, len(len_a)).astype(np.int64)

        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[first_a + many_a - 1] = last_b[first_b + many_b - 1] = 1
        names = np.empty(len(a) + len(b), np.int64)
        names[np.arange(len(a)) + first_b[group_a]] = 2 * a + last_a
        names[np.arange(len(b)) + (first_a + many_a)[group_b]] = 2 * (len(self.a.size) + b) + last_b
        table = self._names
        parts = [table[x] for x in names.tolist()]
        at = np.r_[0, np.cumsum(len_a + len_b)].tolist()
        groups = ["".join(parts[x:y])[:-1] for x, y in zip(at[:-1], at[1:], strict=True)]
        return Windows(groups, n_groups, n_links, n_links, pairs, np.ones(len(pairs), np.int64))

    def _align_all(self, a: np.ndarray, len_a: np.ndarray, b: np.ndarray, len_b: np.ndarray) -> Windows:
        """Windows of many tokens by themselves, as they may have groups of any size."""
        long = np.maximum(len_a, len_b) > _LONG
        if not long.any():
            return self._align(a, len_a, b, len_b) if len(len_a) else _no_windows()
        of_a, of_b = np.repeat(long, len_a), np.repeat(long, len_b)
        out = self._align_all(a[~of_a], len_a[~long], b[~of_b], len_b[~long])
        ends_a, ends_b = np.cumsum(len_a), np.cumsum(len_b)
        for k in np.flatnonzero(long):
            left = a[ends_a[k] - len_a[k] : ends_a[k]]
            right = b[ends_b[k] - len_b[k] : ends_b[k]]
            out = out.and_then(_align_one(left, right, self.a.size, self.b.size))
        return out.take(np.argsort(np.argsort(long, kind="stable"), kind="stable"))

    def align(
        self, hashes: np.ndarray, a: np.ndarray, len_a: np.ndarray, b: np.ndarray, len_b: np.ndarray
    ) -> Windows:
        """Alignments of windows given one after another; known ones are recognised by hash, then ids."""
        at = np.searchsorted(self._hash, hashes)
        at[at == len(self._hash)] = 0
        known = self._hash[at] == hashes if len(self._hash) else np.zeros(len(hashes), bool)
        place = self._place[at] if len(self._hash) else at
        for ids, size, own, kept in ((a, len_a, 0, self._len[0]), (b, len_b, 1, self._len[1])):
            if not known.any():
                break
            known[known] = size[known] == kept[place[known]]
            first, here = np.cumsum(kept) - kept, np.cumsum(size) - size
            n = size[known]
            same = self._ids[own][_runs(first[place[known]], n)] == ids[_runs(here[known], n)]
            sums = np.r_[0, np.cumsum(~same)]
            ends = np.cumsum(n)
            known[known] = sums[ends] == sums[ends - n]
        old = self._kept.take(place[known])
        new_a, new_b = a[np.repeat(~known, len_a)], b[np.repeat(~known, len_b)]
        new = self._align_all(new_a, len_a[~known], new_b, len_b[~known])
        if not known.all():
            self._keep(hashes[~known], new, new_a, len_a[~known], new_b, len_b[~known])
        order = np.empty(len(hashes), np.int64)
        order[known] = np.arange(int(known.sum()))
        order[~known] = int(known.sum()) + np.arange(int((~known).sum()))
        return old.and_then(new).take(order)

    def _keep(self, hashes, new: Windows, a, len_a, b, len_b) -> None:
        short = np.maximum(len_a, len_b) <= _LONG
        if len(self._hash) + int(short.sum()) > _KEPT:
            self._clear()
        at = np.flatnonzero(short)[:_KEPT]
        short = np.zeros(len(short), bool)
        short[at] = True
        known = np.r_[self._hash, hashes[short]]
        place = np.r_[self._place, len(self._len[0]) + np.arange(len(at))]
        order = np.argsort(known, kind="stable")
        self._hash, self._place = known[order], place[order]
        for own, (ids, size) in enumerate(((a, len_a), (b, len_b))):
            self._ids[own] = np.r_[self._ids[own], ids[np.repeat(short, size)]]
            self._len[own] = np.r_[self._len[own], size[short]]
        self._kept = self._kept.and_then(new if len(at) == len(len_a) else new.take(at))


class Aligned(NamedTuple):
    """Per text: numbers of tokens, groups and links, groups as text; and all its (text, pair, times)."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    text: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def _spelt(tokens: Tokens, words: Vocabulary, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which texts the tokens spell exactly."""
    ends = np.r_[0, np.cumsum(words.size[tokens.ids])]
    at = np.r_[0, np.cumsum(tokens.counts)]
    fits = ends[at[1:]] - ends[at[:-1]] == sizes
    ids = tokens.ids[np.repeat(fits, tokens.counts)]
    own = np.repeat(np.flatnonzero(fits), sizes[fits])
    wrong = words.spell(ids) != data[np.repeat(fits, sizes)]
    fits[own[wrong]] = False
    return fits


def align_texts(texts: list[str | None], both: Tokenizers) -> Aligned:
    """Align every text; the windows of all of them are found together."""
    n = len(texts)
    plain = [t or "" for t in texts]
    a, b = both.encode(plain)
    data, offsets = wd.text_bytes(pa.array([" " + t for t in plain], pa.large_string()))
    sizes = np.diff(offsets)
    good = _spelt(a, both.a, data, sizes) & _spelt(b, both.b, data, sizes) & (sizes > 1)
    a = Tokens(a.ids[np.repeat(good, a.counts)], np.where(good, a.counts, 0))
    b = Tokens(b.ids[np.repeat(good, b.counts)], np.where(good, b.counts, 0))

    size_a, size_b = both.a.size[a.ids], both.b.size[b.ids]
    start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    anchors = np.intersect1d(
        start_a[both.a.marked[a.ids]], start_b[both.b.marked[b.ids]], assume_unique=True
    )
    begins = (np.cumsum(np.where(good, sizes, 0)) - np.where(good, sizes, 0))[good]
    anchors = np.union1d(anchors, begins)
    of = np.flatnonzero(good)[np.searchsorted(begins, anchors, "right") - 1]
    first_a, first_b = np.searchsorted(start_a, anchors), np.searchsorted(start_b, anchors)
    len_a = np.diff(np.r_[first_a, len(a.ids)])
    len_b = np.diff(np.r_[first_b, len(b.ids)])

    keys = wd.mix(
        wd.run_hashes(wd.mix(a.ids + 1), first_a, first_a + len_a) * np.uint64(3)
        + wd.run_hashes(wd.mix(b.ids + 1), first_b, first_b + len_b)
    )
    _, example, which = np.unique(keys, return_index=True, return_inverse=True)
    stand = example[which]
    other = (len_a != len_a[stand]) | (len_b != len_b[stand])
    stand = np.where(other, np.arange(len(stand)), stand)
    other |= _unequal(a.ids, first_a, len_a, stand) | _unequal(b.ids, first_b, len_b, stand)
    if other.any():  # one hash for two windows: those are looked up by themselves
        which[other] = len(example) + np.arange(int(other.sum()))
        example = np.r_[example, np.flatnonzero(other)]

    found = both.windows.align(
        keys[example],
        a.ids[_runs(first_a[example], len_a[example])],
        len_a[example],
        b.ids[_runs(first_b[example], len_b[example])],
        len_b[example],
    )

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(of, values[which], n).astype(np.int64)

    n_groups, n_links = per_text(found.n_groups), per_text(found.n_links)
    names, chosen = found.groups, which.tolist()
    at = np.searchsorted(of, np.arange(n + 1)).tolist()
    groups = [
        ";".join([names[k] for k in chosen[lo:hi]]) for lo, hi in zip(at[:-1], at[1:], strict=True)
    ]

    many, often = found.many, found.times
    codes, number = np.unique(found.pairs, return_inverse=True)
    take = _runs((np.cumsum(many) - many)[which], many[which])
    text = np.repeat(of, many[which])
    key = text * max(len(codes), 1) + number[take]
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    times = np.add.reduceat(often[take][order], starts) if len(key) else np.zeros(0, np.int64)
    text, pair = np.divmod(key[starts], max(len(codes), 1))
    pair = codes[pair] if len(codes) else pair
    return Aligned(a.counts, b.counts, n_groups, n_links, groups, text, pair, times)


class _Chunk:
    """Numbers for the pairs of a chunk, in the order in which they were first seen."""

    def __init__(self, number: int) -> None:
        self.number, self.bytes = number, 0
        self._known, self._place = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.docs = np.zeros(0, np.int64)

    def number_of(self, pair: np.ndarray) -> np.ndarray:
        """Numbers of pairs (one of each per document), which are counted."""
        unique, inverse, docs = np.unique(pair, return_inverse=True, return_counts=True)
        at = np.searchsorted(self._known, unique)
        hit = np.zeros(len(unique), bool)
        inside = at < len(self._known)
        hit[inside] = self._known[at[inside]] == unique[inside]
        new = unique[~hit]
        fresh = len(self._known) + np.arange(len(new))
        place = np.empty(len(unique), np.int64)
        place[hit] = self._place[at[hit]]
        place[~hit] = fresh
        known = np.r_[self._known, new]
        order = np.argsort(known, kind="stable")
        self._known, self._place = known[order], np.r_[self._place, fresh][order]
        self.docs = np.r_[self.docs, np.zeros(len(new), np.int64)]
        self.docs[place] += docs
        return place[inverse]

    def pairs(self) -> np.ndarray:
        out = np.empty(len(self._known), np.int64)
        out[self._place] = self._known
        return out


def pack(numbers: np.ndarray, times: np.ndarray) -> bytes:
    """Numbers (in any order) with how often each occurs, as compressed bytes."""
    import zstandard

    order = np.argsort(numbers)
    steps = np.diff(numbers[order], prepend=0).astype("<u4")
    data = steps.tobytes() + times[order].astype("<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4").astype(np.int64)
    half = len(raw) // 2
    return np.cumsum(raw[:half]), raw[half:]


_COUNTED = "n_a long, n_b long, n_groups long, n_links long, groups string"
_CHUNKED = "_chunk long, _links binary, _pairs array<long>, _docs array<long>"
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``docs`` with ``n_a, n_b, n_groups, n_links`` and ``groups`` (``a1,a2|b1;a3|b2,b3``), without text.

    Also the columns that ``with_pair_counts`` needs, among them a row without document per chunk:
    where those are not wanted, use ``alignments``.
    """
    dropped = {"text", *RESULTS, "_chunk", "_links", "_pairs", "_docs"}
    own = [c for c in docs.columns if c not in dropped]
    rows = docs.select(*[f"`{c}`" for c in own], F.col("text").cast("string").alias("text"))
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema if f.name != "text"]
    added = T._parse_datatype_string(f"{_COUNTED}, {_CHUNKED}")
    schema = T.StructType([*fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both = tokenizers(path_a, path_b)
        base = TaskContext.get().partitionId() << 32
        chunk, kinds = _Chunk(base), []

        def close() -> pa.RecordBatch:
            none = [pa.nulls(1, k) for k in kinds]
            numbers = [pa.nulls(1, pa.int64()) for _ in range(4)]
            return pa.RecordBatch.from_arrays(
                [
                    *none,
                    *numbers,
                    pa.nulls(1, pa.string()),
                    pa.array([chunk.number], pa.int64()),
                    pa.nulls(1, pa.binary()),
                    pa.array([chunk.pairs()], pa.list_(pa.int64())),
                    pa.array([chunk.docs], pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

        for whole in batches:
            kinds = [whole.schema.field(c).type for c in own]
            for batch in wd.slices(whole, "text", SLICE):
                found = align_texts(batch.column("text").to_pylist(), both)
                number = chunk.number_of(found.pair)
                at = np.searchsorted(found.text, np.arange(batch.num_rows + 1))
                links = [
                    pack(number[lo:hi], found.times[lo:hi])
                    for lo, hi in zip(at[:-1], at[1:], strict=True)
                ]
                counts = (found.n_a, found.n_b, found.n_groups, found.n_links)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in own),
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array(found.groups, pa.string()),
                        pa.array(np.full(batch.num_rows, chunk.number)),
                        pa.array(links, pa.binary()),
                        pa.nulls(batch.num_rows, pa.list_(pa.int64())),
                        pa.nulls(batch.num_rows, pa.list_(pa.int64())),
                    ],
                    names=schema.names,
                )
                chunk.bytes += int(wd.text_bytes(batch.column("text"))[1][-1])
                if chunk.bytes >= CHUNK:
                    yield close()
                    chunk = _Chunk(chunk.number + 1)
        if chunk.bytes:
            yield close()

    return rows.mapInArrow(run, schema)


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``docs`` with its alignments, one row per document."""
    aligned = align(docs, path_a, path_b)
    return aligned.where("_links IS NOT NULL").drop("_chunk", "_links", "_pairs", "_docs")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, a, b, count, best``: documents per linked pair of ids, and whether no other pair of
    the same A id has more."""
    rows = aligned.where("_pairs IS NOT NULL").select(
        F.explode(F.arrays_zip("_pairs", "_docs")).alias("x")
    )
    counts = rows.groupBy(F.col("x._pairs").alias("pair")).agg(F.sum("x._docs").alias("count"))
    counts = materialize(counts.withColumn("a", F.shiftright("pair", _B_BITS)), "pair_counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select(
        "pair",
        "a",
        F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1)).alias("b"),
        "count",
        (F.col("count") == F.col("most")).alias("best"),
    )


def with_pair_counts(aligned: DataFrame) -> DataFrame:
    """Rows of ``align`` with ``n_best`` and ``count_sum``: links whose count is the highest of their A
    id, and the sum of all links' counts.

    Drop large columns that are not wanted before; the rows are written once and moved by chunk.
    """
    aligned = materialize(aligned, "aligned")
    pairs = aligned.where("_pairs IS NOT NULL").select(
        "_chunk", F.posexplode("_pairs").alias("_number", "pair")
    )
    counts = pair_counts(aligned).select("pair", "count", "best")
    known = pairs.join(counts, "pair").groupBy(F.col("_chunk").alias("_of")).agg(
        F.collect_list("_number").alias("numbers"),
        F.collect_list("count").alias("counts"),
        F.collect_list("best").alias("best"),
    )
    docs = aligned.where("_links IS NOT NULL").drop("_pairs", "_docs")
    own = [c for c in docs.columns if c not in ("_chunk", "_links")]
    fields = [f for f in docs.schema.fields if f.name in own]
    more = [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]

    def run(rows: pa.Table, chunk: pa.Table) -> pa.Table:
        count = best = np.zeros(0, np.int64)
        if chunk.num_rows:  # else no document of the chunk has a token
            numbers, counts, flags = (
                chunk.column(c).chunk(0).values.to_numpy(zero_copy_only=False)
                for c in ("numbers", "counts", "best")
            )
            count, best = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
            count[numbers], best[numbers] = counts, flags
        n_best, total = [], []
        for data in rows.column("_links").to_pylist():
            at, times = unpack(data)
            n_best.append(int((times * best[at]).sum()))
            total.append(int((times * count[at]).sum()))
        results = [pa.array(n_best, pa.int64()), pa.array(total, pa.int64())]
        return pa.Table.from_arrays(
            [*(rows.column(c) for c in own), *results], names=[*own, "n_best", "count_sum"]
        )

    pairs = docs.groupBy("_chunk").cogroup(known.groupBy("_of"))
    return pairs.applyInArrow(run, T.StructType([*fields, *more]))
