"""Record ids and exact-size sampling.

``row_number()`` over one window would pull a whole dataset into one task. Here the rows are range
sorted, numbered inside their own partition, and shifted by the row counts of the partitions
before; the table of those counts has one row per partition and group. Rows that still stand in the
order of their files are not sorted at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinfold.session import materialize

_PARTITION_BITS = 33  # monotonically_increasing_id(): row in partition in the lower 33 bits
MAX_SPLITS = 200_000  # rows of a table of file splits that is broadcast; a larger one is joined


def number_in_order(
    df: DataFrame, order: Sequence[str], name: str = "n", within: Sequence[str] = ()
) -> DataFrame:
    """Add 1, 2, 3, … in the given order, starting anew in every ``within`` group.

    ``within`` + ``order`` must be unique per row for a repeatable result.
    """
    within = list(within)
    placed = materialize(
        df.orderBy(*within, *order).withColumn("_pos", F.monotonically_increasing_id()), "numbered"
    )
    part = F.shiftright("_pos", _PARTITION_BITS)
    row = F.col("_pos").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    runs = placed.groupBy(part.alias("_part"), *within).agg(
        F.min(row).alias("_first"), F.count("*").alias("_rows")
    )
    earlier = W.partitionBy(*within).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shifts = runs.select(
        "_part",
        *[F.col(c).alias(f"_in_{c}") for c in within],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same: Column = F.shiftright(placed["_pos"], _PARTITION_BITS) == shifts["_part"]
    for c in within:
        same = same & placed[c].eqNullSafe(shifts[f"_in_{c}"])
    if not within:
        shifts = F.broadcast(shifts)  # one row per sort partition, whatever the data size
    return placed.join(shifts, same).select(*df.columns, (row + F.col("_shift")).alias(name))


def number_in_file_order(
    df: DataFrame,
    position: Sequence[str],
    name: str = "n",
    within: Sequence[str] = (),
    before: DataFrame | None = None,
) -> DataFrame:
    """Add 1, 2, 3, … to rows that still stand in the order of their files; nothing is sorted.

    ``position`` names the file and the start of the split that a row was read from. Rows of a split
    are neighbours in a partition, so a row's number is its place in the split plus the rows of
    the splits before. ``within`` starts anew and must be constant in a file. ``before``
    (``within`` and ``_before``) gives numbers that are used up already.
    """
    file, block = position[:2]
    keys = [file, block]
    within = list(within)
    placed = materialize(df.withColumn("_pos", F.monotonically_increasing_id()), "placed")
    splits = placed.groupBy(*keys, *within).agg(F.min("_pos").alias("_first"), F.count("*").alias("_rows"))
    earlier = W.partitionBy(*within).orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    shifts = splits.withColumn("_shift", offset - F.col("_first") + 1)
    if before is not None:
        used = before.select(*[F.col(c).alias(f"_in_{c}") for c in within], "_before")
        same = F.lit(True)
        for c in within:
            same = same & shifts[c].eqNullSafe(used[f"_in_{c}"])
        shifts = shifts.join(used, same, "left").withColumn(
            "_shift", F.col("_shift") + F.coalesce("_before", F.lit(0))
        )
    shifts = materialize(
        shifts.select(F.col(file).alias("_in_file"), F.col(block).alias("_in_block"), "_shift"), "shifts"
    )
    if shifts.count() <= MAX_SPLITS:
        shifts = F.broadcast(shifts)
    here = (placed[file] == shifts["_in_file"]) & (placed[block] == shifts["_in_block"])
    return placed.join(shifts, here).select(*df.columns, (F.col("_pos") + F.col("_shift")).alias(name))


def with_ids(numbered: DataFrame, dataset: str, n: str = "_n", id_col: str = "unique_id") -> DataFrame:
    """``"{dataset}_{n}"`` as first column, without the number."""
    ids = F.concat_ws("_", F.col(dataset), F.col(n).cast("string"))
    return numbered.select(ids.alias(id_col), *[c for c in numbered.columns if c != n])


def add_sequential_ids(
    df: DataFrame, dataset: str, order: Sequence[str], id_col: str = "unique_id"
) -> DataFrame:
    """``"{dataset}_{i}"`` as first column, with i from 1 in ``order`` inside each dataset."""
    return with_ids(number_in_order(df, order, "_n", within=[dataset]), dataset, "_n", id_col)


def add_file_ids(
    df: DataFrame, dataset: str, position: Sequence[str], id_col: str = "unique_id"
) -> DataFrame:
    """As ``add_sequential_ids``, for rows just read from files of which each is of one dataset."""
    return with_ids(number_in_file_order(df, position, "_n", [dataset]), dataset, "_n", id_col)


def add_uuid_ids(df: DataFrame, id_col: str = "unique_id") -> DataFrame:
    """A random UUID as first column. Write the result once; recomputing it draws new ids."""
    return df.select(F.uuid().alias(id_col), *df.columns)


def add_hash_ids(
    df: DataFrame, columns: Sequence[str] | None = None, id_col: str = "unique_id"
) -> DataFrame:
    """SHA-256 over the given columns (default all) as first column: stateless and repeatable.

    Each value is preceded by its length, so shifting text between columns changes the id.
    """
    parts = []
    for c in columns or df.columns:
        value = F.col(f"`{c}`").cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))
        )
    return df.select(F.sha2(F.concat_ws("|", *parts), 256).alias(id_col), *df.columns)


def keep_first_rows(
    df: DataFrame, limit: int, order: Sequence[str], within: Sequence[str]
) -> DataFrame:
    """At most ``limit`` rows of each group, the first in ``order`` (an opt-in row cap).

    Spark trims every group to the limit inside each task before it shuffles.
    """
    window = W.partitionBy(*within).orderBy(*order)
    return (
        df.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= limit).drop("_n")
    )


def sample_exactly(
    df: DataFrame, size: int, seed: int = 42, id_col: str = "unique_id"
) -> DataFrame:
    """``size`` rows chosen by hashed id, or all rows if there are no more than that.

    The rows with the smallest hashes win. A count per hash prefix finds the prefix in which the
    sample ends, so only the rows up to there are sorted instead of the whole table.
    """
    hashed = df.withColumn(
        "_hash", F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")).cast("binary"))
    ).withColumn("_head", F.substring("_hash", 1, 4))
    heads = hashed.groupBy("_head").agg(F.count("*").alias("_rows"))  # at most 65,536 rows
    before = F.coalesce(
        F.sum("_rows").over(W.orderBy("_head").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    needed = heads.select("_head", before.alias("_before")).where(F.col("_before") < size)
    near = hashed.join(F.broadcast(needed), "_head")
    whole = number_in_order(near, ["_hash", id_col], "_rank")
    return whole.where(F.col("_rank") <= size).select(*df.columns)
