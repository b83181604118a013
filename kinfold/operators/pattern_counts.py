"""Level patterns of all pairs inside blocks, counted without a row per pair.

Blocks are cut into cells as in ``blocking``, but a cell of two different parts comes up once. A task takes
its cells one after another from the sorted rows and compares them with array operations, so only counts per
pattern leave it. It holds a cell and a bounded number of pairs at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.pairwise import Column
from kinfold.operators.blocking import Rule, block_tasks, hot_blocks
from kinfold.operators.comparison import Comparison

PAIRS_AT_ONCE = 100_000  # compared with array operations; bounds the memory, not the result
TASK_PAIRS = 8_000_000  # of a task, about
_PART = (1 << 20) - 1  # sums of so many bits of 100,000 numbers are exact in a double


def cells_of(tuples: DataFrame, rule: Rule, cell_rows: int, task_pairs: int | None = None) -> DataFrame:
    """``tuples`` once per cell they are in, with the cell (``_row`` <= ``_col``) and their part, in order.

    A pair of one part is in the cell of that part alone, a pair of two parts in the cell of both.
    """
    hot = hot_blocks(tuples, rule, cell_rows)
    keys = list(rule)
    if hot is None:
        zero = F.lit(0)
        cells = tuples.select("*", *[zero.alias(c) for c in ("_part", "_row", "_col")])
    else:
        parts = F.coalesce("_parts", F.lit(1))
        dealt = tuples.join(hot, keys, "left").withColumn("_parts", parts)
        dealt = dealt.withColumn(
            "_part", F.pmod(F.xxhash64("profile_id"), F.col("_parts")).cast("int")
        )
        others = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_other")
        cells = dealt.select(*tuples.columns, "_part", others).select(
            *tuples.columns,
            "_part",
            F.least("_part", "_other").alias("_row"),
            F.greatest("_part", "_other").alias("_col"),
        )
    unit = [*keys, "_row", "_col"]
    if tasks := block_tasks(tuples, rule, task_pairs or TASK_PAIRS):
        cells = cells.repartition(tasks, *unit)
    else:
        cells = cells.repartition(*unit)
    return cells.sortWithinPartitions(*unit, "_part", "profile_id")


def _begins(table: pa.Table, columns: Sequence[str]) -> np.ndarray:
    """Rows in which one of the columns, none of them null, is not as in the row before."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in columns:
        values = table.column(c)
        new[1:] |= pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy()
    return np.flatnonzero(new)


def _whole_cells(batches: Iterator[pa.RecordBatch], unit: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of whole cells; the last cell of a batch may go on in the next one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        last = int(_begins(table, unit)[-1])
        if last:
            yield table.slice(0, last).combine_chunks()
        held = table.slice(last).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class _Sources:
    """How many records a row has of each source."""

    def __init__(self, table: pa.Table) -> None:
        lists, counts = (table.column(c).combine_chunks() for c in ("_sources", "_counts"))
        self.size = pc.list_value_length(lists).to_numpy().astype(np.int64)
        self.first = np.cumsum(self.size) - self.size
        names = pc.list_flatten(lists).dictionary_encode()
        self.name = names.indices.to_numpy().astype(np.int64)
        self.kinds = max(len(names.dictionary), 1)
        self.n = pc.list_flatten(counts).to_numpy()
        key = np.repeat(np.arange(len(self.size)), self.size) * self.kinds + self.name
        self.order = np.argsort(key)
        self.key = key[self.order]

    def within(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Record pairs of the rows i and j that are of one source."""
        total = np.zeros(len(i), np.int64)
        one = (self.size[i] == 1) & (self.size[j] == 1)
        a, b = self.first[i[one]], self.first[j[one]]
        total[one] = np.where(self.name[a] == self.name[b], self.n[a] * self.n[b], 0)
        rest = np.flatnonzero(~one)
        if len(rest):
            size = self.size[i[rest]]
            pair = np.repeat(np.arange(len(rest)), size)
            at = np.repeat(self.first[i[rest]], size)
            at += np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
            key = j[rest][pair] * self.kinds + self.name[at]
            found = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            same = self.key[found] == key
            np.add.at(
                total,
                rest[pair[same]],
                self.n[at[same]] * self.n[self.order[found[same]]],
            )
        return total


def _partners(table: pa.Table, unit: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) row that a row is compared with, itself in a cell of one part."""
    begins = _begins(table, unit)
    rows = np.arange(table.num_rows)
    cell = np.searchsorted(begins, rows, "right") - 1
    end = np.r_[begins[1:], table.num_rows][cell]
    part, low, high = (table.column(c).to_numpy() for c in ("_part", "_row", "_col"))
    second = np.add.reduceat((part != low).astype(np.int64), begins)  # rows of the other part
    start = np.where(low == high, rows, end - second[cell])
    return np.where((low != high) & (part != low), end, start), end


def _count(rule: Rule, comparisons: Sequence[Comparison], pairs_at_once: int):
    names = [c.gamma for c in comparisons]
    unit = [*rule, "_row", "_col"]

    def add(found: Counter, columns: list[Column], n: np.ndarray, sources: _Sources, i, j) -> None:
        pairs = n[i] * n[j] - sources.within(i, j)
        pairs = np.where(i == j, pairs >> 1, pairs)
        some = pairs > 0
        i, j, pairs = i[some], j[some], pairs[some]
        if not len(i):
            return
        pattern = np.zeros(len(i), np.int64)
        for c, column in zip(comparisons, columns, strict=True):
            pattern = pattern * (c.top + 2) + column.levels(i, j) + 1
        kinds, at = np.unique(pattern, return_inverse=True)
        total = [0] * len(kinds)
        for shift in (0, 20, 40, 60):
            piece = (pairs >> shift) & _PART
            if piece.any():
                sums = np.bincount(at, piece.astype(np.float64), len(kinds))
                total = [t + (int(s) << shift) for t, s in zip(total, sums, strict=True)]
        found.update(dict(zip(kinds.tolist(), total, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for table in _whole_cells(batches, unit):
            sources, n = _Sources(table), table.column("_n").to_numpy()
            rank = np.argsort(pc.sort_indices(table.column("profile_id")).to_numpy())
            start, end = _partners(table, unit)
            partners = end - start
            columns = [
                Column(table.column(c.column).combine_chunks(), c.thresholds, int(partners.sum()))
                for c in comparisons
            ]
            before = np.r_[0, np.cumsum(partners * np.maximum(sources.size, 1))]
            first = 0
            while first < table.num_rows:
                limit = before[first] + pairs_at_once
                last = max(first + 1, int(np.searchsorted(before, limit, "right")) - 1)
                i = np.repeat(np.arange(first, last), partners[first:last])
                done = np.cumsum(partners[first:last]) - partners[first:last]
                j = np.arange(len(i)) - np.repeat(done - start[first:last], partners[first:last])
                ahead = rank[i] <= rank[j]
                add(found, columns, n, sources, np.where(ahead, i, j), np.where(ahead, j, i))
                first = last
        levels = {name: [] for name in names}
        for pattern in found:
            for c, name in reversed(list(zip(comparisons, names, strict=True))):
                pattern, level = divmod(pattern, c.top + 2)
                levels[name].append(level - 1)
        arrays = [pa.array(levels[name], pa.int32()) for name in names]
        arrays.append(pa.array([*found.values()], pa.int64()))
        yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_pairs"])

    return run


def pattern_counts(
    tuples: DataFrame, rule: Rule, comparisons: Sequence[Comparison], cell_rows: int
) -> DataFrame:
    """Record pairs across sources (``n_pairs``) per combination of levels and task."""
    schema = ", ".join([*(f"`{c.gamma}` int" for c in comparisons), "n_pairs long"])
    return cells_of(tuples, rule, cell_rows).mapInArrow(_count(rule, comparisons, PAIRS_AT_ONCE), schema)
