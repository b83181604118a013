"""Pairs inside blocks with the levels of their comparisons, for operators that need every pair as a row.

Blocks are cut into cells as for ``pattern_counts``. A task compares its cells with array operations and
gives, for some hundred thousand pairs at a time, the rows they are made of once and a number per pair: where
its two rows are and its levels. Spark unpacks these numbers in compiled code, so no text travels per pair.
A task holds a cell and a bounded number of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from kinfold.functions import pairwise
from kinfold.operators.blocking import CELL_ROWS, Rule, join_block
from kinfold.operators.comparison import Comparison
from kinfold.operators.pattern_counts import _partners, _whole_cells, cells_of

PAIRS_AT_ONCE = 100_000  # compared and given together; bounds the memory, not the result
TASK_PAIRS = 4_000_000  # looked at by a task, about
_ROW_BITS = 20  # of each row's place, as a piece has at most two rows a pair
_LEVEL_BITS = 63 - 2 * _ROW_BITS


def _widths(comparisons: Sequence[Comparison]) -> list[int]:
    return [(c.top + 1).bit_length() for c in comparisons]


def _plain(kind: DataType) -> bool:
    """Whether array operations find equal what Spark finds equal, in the same order."""
    text = isinstance(kind, StringType) and kind == StringType()
    return text or isinstance(kind, (IntegralType, BooleanType, DateType))


def can_pack(rows: DataFrame, rule: Rule, once: str, comparisons: Sequence[Comparison]) -> bool:
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return (
        sum(_widths(comparisons)) <= _LEVEL_BITS
        and all(_plain(kinds[c]) for c in (*rule, once, "profile_id"))
        and all(
            kinds[c.column] == StringType() if c.thresholds else _plain(kinds[c.column])
            for c in comparisons
        )
    )


def _list_of(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _ranks(values: pa.Array) -> np.ndarray:
    """Numbers in the order of the values."""
    encoded = values.dictionary_encode()
    order = pc.sort_indices(encoded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[encoded.indices.to_numpy()]


def _compared(
    rule: Rule, once: str, names: Sequence[str], comparisons: Sequence[Comparison], pairs_at_once: int
):
    unit = [*rule, "_row", "_col"]
    widths = _widths(comparisons)

    def piece(table: pa.Table, i: np.ndarray, j: np.ndarray, levels: np.ndarray) -> pa.RecordBatch:
        used = np.zeros(table.num_rows, bool)
        used[i], used[j] = True, True
        place = np.cumsum(used) - 1
        rows = table.take(np.flatnonzero(used)).combine_chunks()
        columns = [rows.column(c).combine_chunks() for c in names]
        fields = [pa.field(c, a.type) for c, a in zip(names, columns, strict=True)]
        packed = place[i] | place[j] << _ROW_BITS | levels << 2 * _ROW_BITS
        return pa.RecordBatch.from_arrays(
            [_list_of(pa.StructArray.from_arrays(columns, fields=fields)), _list_of(pa.array(packed))],
            names=["_rows", "_pairs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches, unit):
            start, end = _partners(table, unit)
            partners = end - start
            before = np.r_[0, np.cumsum(partners)]
            if before[-1] == 0:
                continue
            source = _ranks(table.column(once).combine_chunks())
            columns = [
                pairwise.Column(table.column(c.column).combine_chunks(), c.thresholds, int(before[-1]))
                for c in comparisons
            ]
            first = 0
            while first < table.num_rows:
                limit = before[first] + pairs_at_once
                last = max(first + 1, int(np.searchsorted(before, limit, "right")) - 1)
                some = partners[first:last]
                i = np.repeat(np.arange(first, last), some)
                j = np.arange(len(i)) - np.repeat(before[first:last] - before[first] - start[first:last], some)
                first = last
                ahead = source[i] - source[j]
                keep = ahead != 0
                i, j, ahead = i[keep], j[keep], ahead[keep] < 0
                if not len(i):
                    continue
                i, j = np.where(ahead, i, j), np.where(ahead, j, i)
                levels = np.zeros(len(i), np.int64)
                for column, width in zip(columns, widths, strict=True):
                    levels <<= width
                    levels |= column.levels(i, j) + 1
                yield piece(table, i, j, levels)

    return run


def compared_block(
    rows: DataFrame,
    rule: Rule,
    once: str,
    cell_rows: int = CELL_ROWS,
    comparisons: Sequence[Comparison] = (),
) -> DataFrame:
    """The pairs of ``join_block`` with the levels of ``comparisons``, for ``compare`` to find.

    If there are more levels than a number holds, or values that array operations see otherwise than Spark
    does, the pairs are joined and ``compare`` takes their levels.
    """
    if not can_pack(rows, rule, once, comparisons):
        return join_block(rows, rule, once, cell_rows)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*rule, once)])
    cells = cells_of(rows.where(known), rule, cell_rows, TASK_PAIRS)
    row = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields])
    schema = StructType([StructField("_rows", ArrayType(row)), StructField("_pairs", ArrayType(LongType()))])
    run = _compared(rule, once, rows.columns, comparisons, PAIRS_AT_ONCE)
    packed = cells.mapInArrow(run, schema).select("_rows", F.explode("_pairs").alias("_pair"))

    def bits(first: int, width: int) -> Column:
        return F.shiftright("_pair", first).bitwiseAND(F.lit((1 << width) - 1).cast("long")).cast("int")

    found = []
    for k, side in enumerate(("l", "r")):
        of = F.get("_rows", bits(k * _ROW_BITS, _ROW_BITS))
        found += [of.getField(c).alias(f"{c}_{side}") for c in rows.columns]
    at = 2 * _ROW_BITS
    for c, width in reversed(list(zip(comparisons, _widths(comparisons), strict=True))):
        found.append((bits(at, width) - 1).alias(c.known))
        at += width
    return packed.select(*found)
