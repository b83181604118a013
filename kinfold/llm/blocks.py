"""All pairs inside large groups, cut into block pairs of bounded size.

A group of n rows is dealt to n / ``BLOCK_ROWS`` blocks by the hash of a row's id, and each pair of
blocks is a unit of work of its own. So no task holds a whole group, and no pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.session import materialize

BLOCK_ROWS = 2000


def block_pairs(rows: DataFrame, group: str, row_id: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` of groups with two members or more, once per block pair, sorted for ``units``."""
    sizes = rows.groupBy(group).agg(F.count("*").alias("_n")).where("_n > 1")
    sizes = sizes.select(group, F.ceil(F.col("_n") / block_rows).cast("int").alias("_blocks"))
    sized = rows.join(materialize(sizes, "sizes"), group)
    return dealt_cells(block_cells(sized, row_id), group)


def block_cells(sized: DataFrame, row_id: str) -> DataFrame:
    """Rows whose group has ``_blocks`` blocks, once per block pair ``_i, _j`` of their block ``_own``."""
    columns = [c for c in sized.columns if c != "_blocks"]
    own = sized.withColumn("_own", F.pmod(F.xxhash64(row_id, F.lit(7)), "_blocks").cast("int"))
    other = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return other.select(
        *columns,
        "_own",
        F.least("_own", "_other").alias("_i"),
        F.greatest("_own", "_other").alias("_j"),
    )


def dealt_cells(cells: DataFrame, group: str) -> DataFrame:
    """Block pairs dealt to tasks, sorted for ``units``."""
    keys = [group, "_i", "_j"]
    return cells.repartition(*keys).sortWithinPartitions(*keys)


def whole_units(
    batches: Iterator[pa.RecordBatch], group: str
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Many whole block pairs at a time, and for every row the row after its unit's last one."""
    held: list[pa.RecordBatch] = []  # of one unit, between batches

    def bounds(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows - 1, bool)
        for values in (table.column(c).to_numpy() for c in (group, "_i", "_j")):
            change |= values[1:] != values[:-1]
        return np.r_[0, np.flatnonzero(change) + 1, table.num_rows]

    def unit_ends(starts: np.ndarray) -> np.ndarray:
        return np.repeat(starts[1:], np.diff(starts))

    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([*held, batch])
            starts = bounds(table)
            if len(starts) > 2:
                yield table.slice(0, starts[-2]), unit_ends(starts[:-1])
            held = table.slice(starts[-2]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, unit_ends(bounds(table))


def units(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[tuple[pa.Table, pa.Table]]:
    """The two sides of each block pair (the same table twice for a block with itself)."""
    held: list[pa.RecordBatch] = []
    key = None

    def sides() -> tuple[pa.Table, pa.Table] | None:
        table = pa.Table.from_batches(held).combine_chunks()
        if key[1] == key[2]:
            return (table, table) if table.num_rows > 1 else None
        left = np.asarray(table.column("_own")) == key[1]
        return table.filter(pa.array(left)), table.filter(pa.array(~left))

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in (group, "_i", "_j")]
        change = np.zeros(batch.num_rows - 1, bool)
        for values in keys:
            change |= values[1:] != values[:-1]
        starts = np.r_[0, np.flatnonzero(change) + 1]
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            own = tuple(int(values[a]) for values in keys)
            if own != key:
                if held and (unit := sides()):
                    yield unit
                held, key = [], own
            held.append(batch.slice(a, b - a))
    if held and (unit := sides()):
        yield unit
