"""N-gram Jaccard join with PartEnum signatures: near copies among texts, no link lost.

Sets whose Jaccard similarity reaches ``PERCENT`` differ in at most k elements, where k follows from
their sizes. Sizes are cut into bands; a set signs for its own band and, if a larger partner may be
there, for the next one. For a band, the feature domain is hashed into first-level partitions and each
of those into two sub-partitions. With ``k // 2 + 1`` partitions, two similar sets differ in at most
one element in one of them, so they agree in one of its two sub-partitions: the enumerated subsets.
Each sub-partition of a set, hashed, is one signature (Arasu et al. 2006, with n2 = 2 and k2 = 1).

Sub-partitions without elements would be one huge bucket. With t partitions more, t + 1 partitions
have that property, and a set with at most t incomplete partitions agrees in one that has elements.
So a set signs with some t and leaves empty ones out; in the rare case that it has more than t
incomplete partitions it signs with a larger t as well, and if that fails, once with the empty ones.

Similar sets share more signatures than one: as many as complete partitions are left to agree. So each
set leaves one bucket less than that number, the largest first; sets that are alike in a few common
places only are in no bucket after that.

Equal sets are one vertex from the start. A bucket links its members to its smallest one first, and
the most promising of these pairs are verified. Then members of one bucket in different
components are compared by sketches that bound the difference of two sets from below, in waves: every
member names its nearest partners in other components, these pairs are verified, components grow, and the
next wave looks only at members that had further partners, for sixteen times as many. Whole sets are made
and moved only for pairs that sketches do not rule out. The last wave is the one in which no member had further partners to name, so every pair was verified or is
inside a component. A wave's pairs grow with the members, not with the pairs of a bucket; comparing
sketches is quadratic, in block pairs, in members that are alike in a sub-partition and not connected.

Defined results: null and empty texts have no shingle, link with nothing and are their own component;
rows with one ``doc_id`` and different texts are rows of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm import words as wd
from kinfold.llm.blocks import block_cells, dealt_cells, whole_units
from kinfold.llm.tables import bucketed, documents
from kinfold.operators.clusters import connected_components
from kinfold.session import materialize

SHINGLE = 4
PERCENT = 85
BINS = 256  # counters of a sketch; their differences never exceed those of the sets
COARSE_BINS = 32  # of a folded sketch
PAIRS_AT_ONCE = 20_000  # compared with array operations; bounds the memory, not the result
HELD_PAIRS = 200_000  # of a task, before those that are not among the nearest go
BLOCK_ROWS = 1000  # of a large bucket, compared with another block
SLICE_BYTES = 1 << 20  # of texts handled together; bounds the memory, not the result
LARGE = 10_000  # members of a bucket that are counted
SKETCH_ROWS = 2000  # counted with array operations; bounds the memory, not the result
CELLS = 1 << 16  # of 64 bits each, that tell which texts may be looked at as whole sets
MORE = 16  # times as many partners in each wave as in the one before
_NO_ID = -(1 << 63)  # stands for a null doc_id
_RATIO = 1.6  # of the largest to the smallest size of a band, at least


class _Bands:
    """Size bands for a similarity of ``percent`` in a hundred."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.ratio = max(_RATIO, 100 / percent)  # similar sets are in one band or in neighbours

    def low(self, band: np.ndarray) -> np.ndarray:
        return np.ceil(self.ratio**band - 1e-9).astype(np.int64)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        band = np.floor(np.log(np.maximum(sizes, 1)) / math.log(self.ratio)).astype(np.int64)
        band -= self.low(band) > sizes
        return band + (self.low(band + 1) <= sizes)

    def differences(self, band: np.ndarray) -> np.ndarray:
        """Elements in which two similar sets of a band can differ at most."""
        largest = self.low(band + 1) - 1
        return 2 * largest * (100 - self.percent) // (100 + self.percent)

    def reaches_next(self, sizes: np.ndarray, band: np.ndarray) -> np.ndarray:
        return 100 * sizes >= self.percent * self.low(band + 1)


def shingles(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle hash) of the texts of a batch, distinct, sorted by row and hash.

    A text with fewer words than a shingle, but some, has them all as its only shingle.
    """
    data, offsets = wd.text_bytes(batch.column("text"))
    found = wd.split_words(data, offsets, wd.SPACED, lower=True)
    whole = wd.within_row(found.row, length)
    row, value = found.row[: len(whole)][whole], wd.windows(found.hash, length)[whole]
    first, after = wd.row_spans(found.row, batch.num_rows)
    short = np.flatnonzero((after > first) & (after - first < length))
    if len(short):
        row = np.r_[row, short]
        value = np.r_[value, wd.run_hashes(found.hash, first[short], after[short])]
    order = np.lexsort((value, row)) if len(short) else _sort_rows(row, value)
    row, value = row[order], value[order]
    if len(row):
        new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])]
        row, value = row[new], value[new]
    return row, value


def _sort_rows(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Order by row and value when rows are in order already."""
    if not len(row):
        return np.zeros(0, np.int64)
    bounds = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    order = np.empty(len(row), np.int64)
    for a, b in zip(bounds, [*bounds[1:], len(row)], strict=True):
        order[a:b] = a + np.argsort(value[a:b])
    return order


def _set_ids(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and fingerprint of every set."""
    first, after = wd.row_spans(row, rows)
    sums = np.r_[np.uint64(0), np.cumsum(wd.mix(value), dtype=np.uint64)]
    size = after - first
    return size, wd.mix(sums[after] - sums[first] + size.astype(np.uint64)).view(np.int64)


def _sketches(row: np.ndarray, value: np.ndarray, rows: int) -> pa.Array:
    """Counters of the elements' hashes, ``BINS`` bytes a row."""
    bins = (wd.mix(value + np.uint64(5)) % np.uint64(BINS)).astype(np.int64)
    sketch = np.empty((rows, BINS), np.uint8)
    for a in range(0, rows, SKETCH_ROWS):
        n = min(SKETCH_ROWS, rows - a)
        first, after = np.searchsorted(row, [a, a + n])
        at = (row[first:after] - a) * BINS + bins[first:after]
        counts = np.bincount(at, minlength=n * BINS).reshape(n, BINS)
        sketch[a : a + n] = np.minimum(counts, 255)
    every = pa.py_buffer((np.arange(rows + 1) * BINS).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), rows, [None, every, pa.py_buffer(sketch)])


def _sets(length: int, with_shingles: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in wd.slices(whole, "text", SLICE_BYTES):
                row, value = shingles(batch, length)
                size, ids = _set_ids(row, value, batch.num_rows)
                arrays = {"n": pa.array(size, pa.int64()), "sid": pa.array(ids)}
                if with_shingles:
                    at = (np.r_[0, np.cumsum(size)] * 8).astype(np.int32)
                    buffers = [None, pa.py_buffer(at), pa.py_buffer(value)]
                    arrays["shingles"] = pa.Array.from_buffers(pa.binary(), len(size), buffers)
                else:
                    arrays |= {c: batch.column(c) for c in ("doc_id", "row")}
                    arrays["sketch"] = _sketches(row, value, batch.num_rows)
                yield pa.RecordBatch.from_pydict(arrays)

    return run


def _sign(
    row: np.ndarray, value: np.ndarray, rows: int, band: np.ndarray, parts: np.ndarray, salt: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature, whether empty) of all sub-partitions of the given rows; parts = 0: none."""
    cells = 2 * parts
    start = np.cumsum(cells) - cells
    chosen = parts[row] > 0
    row, value = row[chosen], value[chosen]
    key = wd.mix((band.astype(np.uint64) << np.uint64(8)) + np.uint64(salt))
    spread = wd.mix(value ^ key[row])
    at = start[row] + (spread % cells[row].astype(np.uint64)).astype(np.int64)
    sums = np.zeros(int(cells.sum()), np.uint64)
    np.add.at(sums, at, wd.mix(value))
    count = np.bincount(at, minlength=len(sums))
    owner = np.repeat(np.arange(rows), cells)
    place = (np.arange(len(sums)) - start[owner]).astype(np.uint64)
    return owner, wd.mix(sums + wd.mix(key[owner] + place)), count == 0


def signatures(
    row: np.ndarray, value: np.ndarray, rows: int, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of sets given as sorted distinct (row, element)."""
    return _signed(row, value, rows, percent)[:2]


def _signed(
    row: np.ndarray, value: np.ndarray, rows: int, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature, least number of signatures shared with a similar set; negative in the next band).

    Of the partitions, 1 + slack differ in one element at most, and so agree in a sub-partition each. That
    one has elements unless the partition is incomplete. Sets that sign with several slacks share one at least.
    """
    bands = _Bands(percent)
    first, after = wd.row_spans(row, rows)
    size = after - first
    own = bands.of(size)
    out_row, out, out_need = [], [], []
    reaching = bands.reaches_next(size, own) & (size > 0)
    for side, band, signs in ((1, own, size > 0), (-1, own + 1, reaching)):
        k = bands.differences(band)
        base = np.where(signs & (k > 0), k // 2 + 1, 0)  # k = 0: only equal sets are similar
        more = 2 + base // 4
        need = np.ones(rows, np.int64)
        for salt, slack in ((1, more), (2, 4 * more), (3, None)):
            parts = base if slack is None else base + slack
            parts = np.where(base > 0, parts, 0)
            owner, sign, empty = _sign(row, value, rows, band, parts, salt)
            keep = np.ones(len(sign), bool) if slack is None else ~empty
            if slack is not None:
                incomplete = empty.reshape(-1, 2).any(axis=1)
                lacking = np.bincount(owner[::2], incomplete, rows).astype(np.int64)
                if salt == 1:
                    need = np.maximum(1 + slack - lacking, 1)
            out_row.append(owner[keep])
            out.append(sign[keep])
            out_need.append(side * need[owner[keep]])
            if slack is None:
                break
            base = np.where(lacking > slack, base, 0)
            if not base.any():
                break
    return np.concatenate(out_row), np.concatenate(out), np.concatenate(out_need)


def _signatures(length: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed: set[int] = set()  # a task signs equal sets once; bounded by its rows
        for whole in batches:
            for batch in wd.slices(whole, "text", SLICE_BYTES):
                row, value = shingles(batch, length)
                _, ids = _set_ids(row, value, batch.num_rows)
                fresh = np.zeros(batch.num_rows, bool)
                for r, sid in enumerate(ids.tolist()):
                    if sid not in signed:
                        signed.add(sid)
                        fresh[r] = True
                chosen = fresh[row]
                row, sign, need = _signed(row[chosen], value[chosen], batch.num_rows, percent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sign.view(np.int64)), pa.array(ids[row]), pa.array(need, pa.int32())],
                    names=["sig", "sid", "need"],
                )

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct members of buckets of two and more, streamed in order, with the bucket's size.

    Sizes are counted up to ``LARGE``; no more rows than that wait for the end of their bucket.
    """
    held = np.zeros((3, 0), np.int64)  # of the bucket that is open
    gone = False  # whether what is held has been passed on and is only there to be compared

    def passed(rows: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        keep = size > 1
        arrays = [pa.array(c[keep]) for c in (*rows, size)]
        return pa.RecordBatch.from_arrays(arrays, names=["sig", "sid", "need", "size"])

    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        rows = np.concatenate([held, np.stack(new)], axis=1)
        if not rows.shape[1]:
            continue
        differs = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
        rows = rows[:, np.r_[True, differs]]
        starts = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])
        count = np.diff(np.r_[starts, rows.shape[1]])
        size = np.minimum(count, LARGE)
        size[0] = LARGE if gone else size[0]
        size, last = np.repeat(size, count), int(starts[-1])
        skip = int(gone)
        if size[-1] >= LARGE:
            yield passed(rows[:, skip:], size[skip:])
            held, gone = rows[:, -1:], True
        else:
            if last:
                yield passed(rows[:, skip:last], size[skip:last])
            held, gone = rows[:, last:], False
    if not gone and held.shape[1] > 1:
        yield passed(held, np.full(held.shape[1], held.shape[1]))


def _telling(members: DataFrame) -> DataFrame:
    """``sig, sid`` without the signatures that no link needs.

    Similar sets share ``need`` signatures at least. So of each set, ``need - 1`` may go, if those of the
    largest buckets go first, in the same order for all sets: the first one that two sets share stays.
    A set with fewer signatures in buckets than it needs is in none any more.
    """
    by_size = Window.partitionBy("sid", "need").orderBy(F.desc("size"), "sig")
    ranked = members.withColumn("place", F.row_number().over(by_size))
    return ranked.where("place >= abs(need)").select("sig", "sid")


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (left, right) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                a = np.frombuffer(left.as_buffer(), np.uint64)
                b = np.frombuffer(right.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([a, b]))
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= percent * (len(both) - shared):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return run


def _possible(percent: int):
    """Pairs whose sketches do not rule them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS)
                for c in (4, 5)
            )
            apart = (np.maximum(left, right) - np.minimum(left, right)).sum(axis=1, dtype=np.int64)
            total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            may = apart * (100 + percent) <= total * (100 - percent)
            yield batch.select([0, 1]).filter(pa.array(may))

    return run


def _sides(pairs: DataFrame, sets: DataFrame, column: str, percent: int) -> DataFrame:
    """Pairs (``a, b``) with sizes that allow a link, and a column of both their sets."""
    sides = [
        sets.select(F.col("sid").alias(c), F.col("n").alias(f"n_{c}"), F.col(column).alias(f"s_{c}"))
        for c in "ab"
    ]
    possible = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    joined = pairs.join(sides[1], "b").join(sides[0], "a").where(possible)
    return joined.select("a", "b", "n_a", "n_b", "s_a", "s_b")


def _whole_sets(texts: DataFrame, sets: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """``n, sid, shingles`` of the sets in ``pairs``, each from one of its texts.

    A table of bits, of bounded size, tells which texts are surely not among them, so that these are
    not moved; the others are joined.
    """
    one = F.coalesce("doc_id", F.lit(_NO_ID)).alias("one")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    least = F.min(F.struct("row", one)).alias("least")
    chosen = sets.select("sid", "row", "doc_id").join(wanted, "sid").groupBy("sid").agg(least)
    chosen = materialize(chosen.select("least.*"), "wanted")
    cell, bit = F.pmod("row", F.lit(CELLS)).alias("_cell"), F.expr("pmod(shiftright(row, 32), 64)")
    ones = F.expr("bit_or(shiftleft(1L, cast(pmod(shiftright(row, 32), 64) AS int)))").alias("_bits")
    cells = chosen.groupBy(cell).agg(ones)
    named = texts.where("text IS NOT NULL").select("text", "row", one, cell, bit.cast("int").alias("_bit"))
    near = named.join(F.broadcast(cells), "_cell").where("getbit(_bits, _bit) = 1")
    found = near.select("text", "row", "one").join(chosen, ["row", "one"]).select("text")
    schema = "n long, sid long, shingles binary"
    return materialize(found.mapInArrow(_sets(shingle, True), schema), "full")


def _links(
    pairs: DataFrame, texts: DataFrame, sets: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """The pairs (``a, b``) that are similar enough, by their whole sets.

    Repeated rows give a set twice, which changes no link.
    """
    full = _whole_sets(texts, sets, pairs, shingle)
    joined = _sides(pairs, full, "shingles", percent).select("a", "b", "s_a", "s_b")
    return materialize(joined.mapInArrow(_verify(percent), "a long, b long"), "links")


def _labels(links: DataFrame) -> DataFrame:
    return materialize(connected_components(links, "a", "b"), "labels")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``sig, sid, component, size`` of the buckets whose members are not in one component yet.

    One of the buckets that have the same members: they bring the same pairs together.
    """
    labelled = members.select("sig", "sid").join(
        labels.withColumnRenamed("vertex", "sid"), "sid", "left"
    )
    labelled = labelled.select("sig", "sid", F.coalesce("component", "sid").alias("component"))
    labelled = materialize(labelled, "members")
    shape = [
        *(F.bit_xor(F.xxhash64("sid", F.lit(i))).alias(f"x{i}") for i in (0, 1)),
        F.count("*").alias("size"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    ]
    shapes = labelled.groupBy("sig").agg(*shape).where("low != high")
    kept = shapes.groupBy("x0", "x1", "size").agg(F.min("sig").alias("sig")).select("sig", "size")
    return materialize(labelled.join(materialize(kept, "mixed"), "sig"), "members")


class _Nearest:
    """The ``most`` nearest partners of every row, of pairs that come in parts of bounded size."""

    def __init__(self, rows: int, most: int) -> None:
        self.most = most
        self.more = np.zeros(rows, bool)  # rows that have further partners
        self.row, self.other, self.far = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, i: np.ndarray, j: np.ndarray, far: np.ndarray) -> None:
        self.row = np.concatenate([self.row, i, j])
        self.other = np.concatenate([self.other, j, i])
        self.far = np.concatenate([self.far, far, far])

    def prune(self) -> None:
        order = np.lexsort((self.other, self.far, self.row))
        row = self.row[order]
        begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][: len(row)])
        rank = np.arange(len(row)) - np.repeat(begins, np.diff(np.r_[begins, len(row)]))
        near = rank < self.most
        self.more[row[~near]] = True
        self.row, self.other, self.far = row[near], self.other[order][near], self.far[order][near]

    def take(self, before: int) -> tuple[np.ndarray, ...]:
        """Remove and return the pairs (row, partner) of the rows below ``before``."""
        done = self.row < before
        taken = self.row[done], self.other[done]
        self.row, self.other, self.far = (c[~done] for c in (self.row, self.other, self.far))
        return taken


def _near_pairs(percent: int, most: int):
    """For every member of a bucket the ``most`` nearest members of other components.

    Nearest by sketches, and only those that sketches do not rule out. ``more_a`` and ``more_b`` mark
    members that have further ones. Sketches are compared with their bins folded first: folding never
    enlarges a difference.
    """

    def possible(far: np.ndarray, total: np.ndarray) -> np.ndarray:
        return far.astype(np.int64) * (100 + percent) <= total * (100 - percent)

    def batch_of(sid: np.ndarray, nearest: _Nearest, before: int) -> pa.RecordBatch:
        row, other = nearest.take(before)
        swap = sid[row] > sid[other]
        low, high = np.where(swap, other, row), np.where(swap, row, other)
        columns = sid[low], sid[high], nearest.more[low], nearest.more[high]
        new = np.unique(np.stack([low, high]), axis=1, return_index=True)[1] if len(row) else []
        return pa.RecordBatch.from_arrays(
            [pa.array(c[np.asarray(new, np.int64)]) for c in columns],
            names=["a", "b", "more_a", "more_b"],
        )

    def compare(table: pa.Table, end: np.ndarray) -> Iterator[pa.RecordBatch]:
        sid, n, part, own, i_block, j_block = (
            table.column(c).to_numpy() for c in ("sid", "n", "component", "_own", "_i", "_j")
        )
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8)
        sketch = sketch.reshape(-1, BINS)
        coarse = sketch.reshape(len(sid), COARSE_BINS, -1).sum(axis=2, dtype=np.int16)
        partners = end - np.arange(len(sid)) - 1
        before = np.r_[0, np.cumsum(partners)]
        nearest, first = _Nearest(len(sid), most), 0
        while first < len(sid):
            last = int(np.searchsorted(before, before[first] + PAIRS_AT_ONCE, "right")) - 1
            last = max(first + 1, last)
            i = np.repeat(np.arange(first, last), partners[first:last])
            j = np.arange(len(i)) - (before[i] - before[first]) + i + 1
            near = (part[i] != part[j]) & ((own[i] != own[j]) | (i_block[i] == j_block[i]))
            near &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            i, j = i[near], j[near]
            may = possible(np.abs(coarse[i] - coarse[j]).sum(axis=1), n[i] + n[j])
            i, j = i[may], j[may]
            apart = np.maximum(sketch[i], sketch[j]) - np.minimum(sketch[i], sketch[j])
            apart, total = apart.sum(axis=1, dtype=np.int64), n[i] + n[j]
            may = possible(apart, total)
            nearest.add(i[may], j[may], (apart / np.maximum(total, 1))[may])
            first = last
            if len(nearest.row) > HELD_PAIRS:
                nearest.prune()
                if len(nearest.row) > HELD_PAIRS // 2:  # rows of units that are done
                    yield batch_of(sid, nearest, int(np.searchsorted(end, first, "right")))
        nearest.prune()
        yield batch_of(sid, nearest, len(sid))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, end in whole_units(batches, "sig"):
            yield from compare(table, end)

    return run


def _mixed_pairs(mixed: DataFrame, sketches: DataFrame, percent: int, most: int) -> DataFrame:
    """``a, b, more_a, more_b``: the nearest pairs of the members of a bucket, each once.

    A pair that is left out is left out by both members, so both are marked by ``more``.
    """
    blocks = F.ceil(F.col("size") / BLOCK_ROWS).cast("int")
    cells = block_cells(mixed.withColumn("_blocks", blocks).drop("size"), "sid")
    dealt = dealt_cells(cells.join(sketches, "sid"), "sig")
    near = dealt.mapInArrow(
        _near_pairs(percent, most), "a long, b long, more_a boolean, more_b boolean"
    )
    more = [F.max(c).alias(c) for c in ("more_a", "more_b")]
    return materialize(near.groupBy("a", "b").agg(*more), "pairs")


def similar_documents(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, row, n_shingles, component_id, component`` of every row of ``docs``.

    Texts are sets of distinct ``shingle``-word sequences, A-Z lower-cased, words being runs of
    characters that are not ASCII white space. Two texts link if their intersection is at least
    ``percent`` hundredths of their union; ``component_id`` is the smallest ``doc_id`` reachable. ``component`` tells
    components apart where ids do not, and is null for texts without words.
    """
    texts = documents(docs)
    schema = "n long, sid long, doc_id long, row long, sketch binary"
    sets = materialize(texts.mapInArrow(_sets(shingle, False), schema), "sets")
    signs = texts.where("text IS NOT NULL").select("text").mapInArrow(
        _signatures(shingle, percent), "sig long, sid long, need int"
    )
    ordered = signs.repartition("sig").sortWithinPartitions("sig", "sid")
    members = ordered.mapInArrow(_buckets, "sig long, sid long, need long, size long")
    members = materialize(_telling(materialize(members, "buckets")), "members")

    centers = members.groupBy("sig").agg(F.min("sid").alias("a"), F.max("sid").alias("high"))
    centers = materialize(centers.where("a != high").select("sig", "a"), "centers")
    members = materialize(members.join(centers, "sig"), "members")
    wanted = members.select("sid").distinct()
    one = [F.first(c).alias(c) for c in ("n", "sketch")]
    sketches = bucketed(sets.join(wanted, "sid").groupBy("sid").agg(*one), "sid")

    others = members.where("sid != a").groupBy(F.col("sid").alias("b"))
    first = others.agg(F.mode("a", True).alias("a"))  # the center it meets in most buckets
    first = _sides(first, sketches, "sketch", percent).mapInArrow(_possible(percent), "a long, b long")
    first = materialize(first, "pairs")
    labels = _labels(_links(first, texts, sets, shingle, percent))
    mixed, tried, most = members, first, 1
    while True:
        mixed = _mixed(mixed, labels)
        near = _mixed_pairs(mixed, sketches, percent, most)
        fresh = materialize(near.join(tried, ["a", "b"], "left_anti").select("a", "b"), "pairs")
        if fresh.head(1):
            links = _links(fresh, texts, sets, shingle, percent)
            if links.head(1):
                grown = labels.select(F.col("component").alias("a"), F.col("vertex").alias("b"))
                labels = _labels(grown.unionByName(links))
        marked = [near.where(f"more_{c}").select(F.col(c).alias("sid")) for c in "ab"]
        waiting = materialize(marked[0].unionByName(marked[1]).distinct(), "waiting")
        if not waiting.head(1):
            break
        mixed = mixed.join(waiting, "sid", "left_semi")
        tried, most = tried.unionByName(fresh), most * MORE

    labels = labels.withColumnRenamed("vertex", "sid")
    labelled = materialize(
        sets.drop("sketch")
        .where("n > 0")
        .join(labels, "sid", "left")
        .withColumn("component", F.coalesce("component", "sid")),
        "labelled",
    )
    names = materialize(
        labelled.groupBy("component").agg(F.min("doc_id").alias("component_id")), "names"
    )
    columns = ["doc_id", "row", F.col("n").alias("n_shingles"), "component_id", "component"]
    alone = sets.where("n = 0").withColumns(
        {"component_id": F.col("doc_id"), "component": F.lit(None).cast("long")}
    )
    return labelled.join(names, "component").select(*columns).unionByName(alone.select(*columns))
