"""Best-fit packing of token sequences, in bulk-synchronous rounds.

Items (pieces of documents) longer than half a sequence open one each. Then every round range-sorts
the open items and the gaps together by size. A sweep upwards gives each gap the largest item below
it that no smaller gap has taken, which is what placing items one by one into the smallest gap that
fits comes to, as long as no gap takes two. Tasks sweep their own range with a stack; what they leave
over is matched across ranges by rank, from one pair of counts per range. Then the gaps shrink, items
larger than every gap open new sequences (as many as their tokens fill), and the next round begins.
A gap that finds no item is smaller than all items that find no gap, so it is closed for good.

The number of rounds is that of the most items in one sequence, or a few more. A round moves sizes
and ids, never tokens.

Defined results: null and empty texts are one token (the end mark); rows with a null or repeated
``doc_id`` are packed like others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm import words as wd
from kinfold.llm.tokens import encoder
from kinfold.session import materialize, scratch_path

CAPACITY = 1024
END_ID = 2
_PIECE = "doc_id long, piece int, start long, length long, ids binary"
_LIVE = "id long, size int, gap boolean"
_SWEPT = "id long, size int, gap boolean, rank long, mate long, mate_size int, last boolean"


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for whole in batches:
            for batch in wd.slices(whole, "text"):
                ids, counts = encode(batch.column("text"))
                lengths = counts + 1
                ends = np.cumsum(lengths)
                all_ids = np.full(int(lengths.sum()), end_id, "<u4")
                inner = np.ones(len(all_ids), bool)
                inner[ends - 1] = False
                all_ids[inner] = ids
                n = -(-lengths // capacity)
                row = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                head = lengths - (n - 1) * capacity  # only the first piece may be shorter
                start = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[row])
                at = np.r_[0, np.cumsum(length)]  # pieces follow each other without gaps
                buffers = [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(all_ids)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.Array.from_buffers(pa.binary(), len(row), buffers),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return run


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every document, ``end_id`` after its last token.

    ``ids`` are little-endian unsigned 32-bit numbers. Only documents longer than ``capacity`` are
    cut; their first piece may be shorter than the others. ``tokenizer`` is a file every executor has.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.mapInArrow(_pieces(tokenizer, capacity, end_id), _PIECE)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Match a sorted range with a stack.

    Rows out: gaps with an item (``size`` before it, ``last`` for the last item of this round), gaps
    without and items without; ``rank`` counts the last two kinds.
    """
    stack: list[tuple[int, int]] = []
    gaps_left = 0

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
        columns = zip(*rows, strict=True) if rows else [()] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["id", "size", "gap", "rank", "mate", "mate_size", "last"],
        )

    for batch in batches:
        rows = []
        for number, size, gap in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not gap:
                stack.append((number, size))
            elif not stack:
                rows.append((number, size, True, gaps_left, None, None, None))
                gaps_left += 1
            else:
                left = size
                while stack and stack[-1][1] <= left:  # the rest is a smaller gap: fits better
                    item, item_size = stack.pop()
                    fills = not stack or stack[-1][1] > left - item_size
                    rows.append((number, left, True, None, item, item_size, fills))
                    left -= item_size
        yield table(rows)
    for first in range(0, len(stack), 1 << 16):
        part = stack[first : first + (1 << 16)]
        yield table([(n, s, False, first + i, None, None, None) for i, (n, s) in enumerate(part)])


def _match_ranges(
    counts: dict[int, tuple[int, int]],
) -> tuple[list[tuple], dict[int, int]]:
    """Match left-over gaps with left-over items of earlier ranges, last in first out.

    ``counts``: gaps and items per range. Returns (range, gap, first rank, rank after, ``base``,
    ``sign``), where a row's match number is ``base + sign * rank``, and the items left per range.
    """
    spans, open_items, number = [], [], 0
    for part in sorted(counts):
        gaps, items = counts[part]
        at = 0
        while at < gaps and open_items:
            other, left = open_items[-1]
            n = min(left, gaps - at)
            spans.append((part, True, at, at + n, number - at, 1))
            spans.append((other, False, left - n, left, number + left - 1, -1))
            at, number = at + n, number + n
            open_items[-1] = (other, left - n)
            if left == n:
                open_items.pop()
        if items:
            open_items.append((part, items))
    return spans, dict(open_items)


def _within(df: DataFrame, spans: DataFrame) -> Column:
    return (
        (df["part"] == spans["_part"])
        & (df["gap"] == spans["_gap"])
        & (df["rank"] >= spans["_from"])
        & (df["rank"] < spans["_to"])
    )


def _round(live: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame | None]:
    """One round: pairs (``item, item_size, id, size``) and what is live in the next one."""
    spark = live.sparkSession
    order = ["size", "gap", F.xxhash64("id"), "id"]  # an item fits a gap of its size
    swept = materialize(
        live.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_sweep, _SWEPT)
        .withColumn("part", F.spark_partition_id()),
        "sweep",
    )
    alone = swept.where("mate IS NULL")
    counts: dict[int, tuple[int, int]] = {
        part: (gaps, items)
        for part, gaps, items in alone.groupBy("part")
        .agg(F.count_if("gap"), F.count_if(~F.col("gap")))
        .collect()  # a row per range
    }
    spans, left = _match_ranges(counts)
    table = F.broadcast(
        spark.createDataFrame(
            spans, "_part int, _gap boolean, _from long, _to long, _base long, _sign long"
        )
    )
    numbered = alone.join(table, _within(alone, table)).select(
        "id", "size", "gap", (F.col("_base") + F.col("_sign") * F.col("rank")).alias("_match")
    )
    items = numbered.where(~F.col("gap")).select(
        "_match", F.col("id").alias("item"), F.col("size").alias("item_size")
    )
    across = numbered.where("gap").join(items, "_match").withColumn("last", F.lit(True))
    columns = ["item", "item_size", "id", "size", "last"]
    local = swept.where("mate IS NOT NULL").withColumnsRenamed(
        {"mate": "item", "mate_size": "item_size"}
    )
    pairs = materialize(local.select(columns).unionByName(across.select(columns)), "pairs")
    shrunk = pairs.where("last AND size > item_size").select(
        "id", (F.col("size") - F.col("item_size")).alias("size"), F.lit(True).alias("gap")
    )
    if not left:
        return pairs, None
    limits = spark.createDataFrame(list(left.items()), "_part int, _left long")
    waiting = (
        alone.join(
            F.broadcast(limits), (alone["part"] == limits["_part"]) & (alone["rank"] < limits["_left"])
        )
        .where(~F.col("gap"))
        .select("id", "size", "gap", "part", "rank")
    )
    largest = shrunk.agg(F.max("size")).first()[0] or 0
    tokens = waiting.where(F.col("size") > largest).agg(F.sum("size")).first()[0] or 0
    need = -(-tokens // capacity)  # the largest items open that many sequences
    opening: list[tuple[int, int]] = []
    for part in sorted(left, reverse=True):
        n = min(need, left[part])
        opening.append((part, left[part] - n))
        need -= n
    heads = F.broadcast(spark.createDataFrame(opening, "_part int, _first long"))
    marked = waiting.join(heads, waiting["part"] == heads["_part"])
    opens = F.col("rank") >= F.col("_first")
    rest = marked.select(
        "id",
        F.when(opens, capacity - F.col("size")).otherwise(F.col("size")).cast("int").alias("size"),
        opens.alias("gap"),
    )
    return pairs, rest.unionByName(shrunk)


def best_fit(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``id, sequence_id, offset`` for items ``id`` (unique long) and ``length`` (1 to capacity).

    Sequences are named by the item that opens them, at offset 0.
    """
    sized = items.select("id", F.col("length").cast("int").alias("size"))
    large = F.col("size") * 2 > capacity
    live = sized.select(
        "id",
        F.when(large, capacity - F.col("size")).otherwise(F.col("size")).cast("int").alias("size"),
        large.alias("gap"),
    ).where("size > 0")
    placed = []
    current: DataFrame | None = live
    while current is not None:
        pairs, current = _round(current, capacity)
        placed.append(
            pairs.select(
                F.col("item").alias("id"),
                F.col("id").alias("sequence_id"),
                (F.lit(capacity) - F.col("size")).cast("long").alias("offset"),
            )
        )
    joined = reduce(DataFrame.unionByName, placed)
    return sized.join(joined, "id", "left").select(
        "id",
        F.coalesce("sequence_id", "id").alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"),
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns with ``length``) with ``sequence_id`` and ``offset``, which are replaced.

    Places are found for numbers and lengths alone; the pieces travel once, when they get theirs.
    """
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    numbered = pieces.select(
        F.struct(*[f"`{c}`" for c in own]).alias("inputs"), F.monotonically_increasing_id().alias("id")
    )
    path = scratch_path(pieces.sparkSession, "pieces")
    numbered.write.option("compression", "zstd").parquet(path)
    named = pieces.sparkSession.read.schema(numbered.schema).parquet(path)
    places = best_fit(named.select("id", F.col("inputs.length").alias("length")), capacity)
    return named.join(places, "id").select(
        *[F.col("inputs").getField(c).alias(c) for c in own], "sequence_id", "offset"
    )
