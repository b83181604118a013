"""Benchmark decontamination: find test n-grams in training text and remove what they touch.

The windows of the benchmark become a sorted array of hashes, which is broadcast; tasks hash the
windows of their documents with array operations, look them up, verify each hit word by word, and
mark the words inside. The benchmark is cut into blocks of bounded size, so that the broadcast does
not grow with it: a larger benchmark means more passes over the documents, not a larger set.

Defined results: null and empty texts have no words; an item with a null ``item_id`` marks words
but is not listed; an item with fewer words than a window is one window; equal items are all listed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm import words as wd

WINDOW = 10
BLOCK_BYTES = 8 << 20  # text of benchmark items whose windows are broadcast together
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_STATE = ("_starts", "_sizes", "_items")
_ADDED = ("n_words", "n_hit", "items", "clean")


def _item_windows(texts: list[tuple[int | None, str | None]], window: int):
    """Window (a tuple of words) -> its items, and the window lengths that occur."""
    grams: dict[tuple[bytes, ...], set[int | None]] = {}
    for item, text in texts:
        found = _WORD.findall((text or "").encode().lower())
        size = min(window, len(found))
        for i in range(len(found) - size + 1 if size else 0):
            grams.setdefault(tuple(found[i : i + size]), set()).add(item)
    return grams


def _index(grams: dict) -> dict[int, np.ndarray]:
    """Sorted window hashes by window length, made as the scan makes them."""
    by_length: dict[int, list[bytes]] = {}
    for gram in grams:
        by_length.setdefault(len(gram), []).append(b" ".join(gram))
    index = {}
    for size, joined in by_length.items():
        data, offsets = wd.text_bytes(pa.array([j.decode() for j in joined]))
        found = wd.split_words(data, offsets, wd.ALPHANUMERIC, lower=True)
        index[size] = wd.distinct(wd.windows(found.hash, size)[::size])
    return index


def _hits(found: wd.Words, data: np.ndarray, index: dict, grams: dict):
    """First word, length and items of every window that occurs; hash hits are verified."""
    for size, known in index.items():
        hashes = wd.windows(found.hash, size)
        if not len(hashes):
            continue
        at = np.searchsorted(known, hashes)
        at[at == len(known)] = 0
        for i in np.flatnonzero((known[at] == hashes) & wd.within_row(found.row, size)):
            spans = zip(found.start[i : i + size], found.end[i : i + size], strict=True)
            gram = tuple(data[a:b].tobytes().lower() for a, b in spans)
            if (items := grams.get(gram)) is not None:
                yield int(i), size, items


def _without(raw: bytes, found: wd.Words, hit: np.ndarray, first: int, base: int) -> str:
    """A text without its hit words and what stands between them."""
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8))) + first
    at, kept = 0, []
    for a, b in edges.reshape(-1, 2):
        kept.append(raw[at : found.start[a] - base])
        at = int(found.end[b - 1]) - base
    return b"".join([*kept, raw[at:]]).decode()


def _scan(shared, last: bool):
    """Add the hits of one block of items to ``_starts, _sizes, _items``; the last pass marks words."""

    def spans_of(batch: pa.RecordBatch, found: wd.Words, first: np.ndarray, data: np.ndarray):
        starts, sizes, items = (batch.column(c).to_pylist() for c in _STATE)
        grams, index = shared.value
        for i, size, hit_items in _hits(found, data, index, grams):
            row = int(found.row[i])
            starts[row] = [*(starts[row] or ()), i - int(first[row])]
            sizes[row] = [*(sizes[row] or ()), size]
            items[row] = sorted({*(items[row] or ()), *(x for x in hit_items if x is not None)})
        return starts, sizes, items

    def marked(batch: pa.RecordBatch, found: wd.Words, data: np.ndarray, offsets, spans, bounds):
        (first, after), (starts, sizes, items) = bounds, spans
        n_hit, clean = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
        for row in (r for r, s in enumerate(starts) if s):
            n = int(after[row] - first[row])
            hit = wd.covered(np.asarray(starts[row]), np.asarray(sizes[row]), n)
            n_hit[row] = hit.sum()
            raw = data[offsets[row] : offsets[row + 1]].tobytes()
            clean[row] = _without(raw, found, hit, int(first[row]), int(offsets[row]))
        return [
            pa.array(after - first, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array([i or [] for i in items], pa.list_(pa.int64())),
            pa.array(clean, pa.string()),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in wd.slices(whole, "text"):
                data, offsets = wd.text_bytes(batch.column("text"))
                found = wd.split_words(data, offsets, wd.ALPHANUMERIC, lower=True)
                bounds = wd.row_spans(found.row, batch.num_rows)
                spans = spans_of(batch, found, bounds[0], data)
                own = [c for c in batch.schema.names if c not in _STATE]
                if last:
                    names = _ADDED
                    columns = marked(batch, found, data, offsets, spans, bounds)
                else:
                    names = _STATE
                    kinds = (pa.int32(), pa.int32(), pa.int64())
                    columns = [pa.array(v, pa.list_(k)) for v, k in zip(spans, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in own] + columns, names=[*own, *names]
                )

    return run


def _blocks(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Items with a block number, so that a block holds about ``block_bytes`` of text at most."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 if total <= block_bytes else 2 * -(-total // block_bytes)
    return items.withColumn("block", F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks))), blocks


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Every row of ``docs`` with ``n_words, n_hit, items, clean``; no row is moved.

    ``items`` are the distinct items found, ``clean`` is the text without hit words (the text itself
    if there are none). Filter on ``n_hit`` to remove documents instead of spans. Input columns with
    one of these names are replaced.
    """
    items, blocks = _blocks(benchmark, block_bytes)
    own = [c for c in docs.columns if c not in (*_ADDED, *_STATE)]
    current = docs.select(*[F.col(f"`{c}`") for c in own]).withColumn(
        "text", F.col("text").cast("string")
    )
    fields = [(f.name, f.dataType) for f in current.schema]
    base = T.StructType([T.StructField(n, t) for n, t in fields])
    lists = [T.ArrayType(T.IntegerType())] * 2 + [T.ArrayType(T.LongType())]
    state = T.StructType([*base, *map(T.StructField, _STATE, lists)])
    kinds = [T.LongType(), T.LongType(), lists[2], T.StringType()]
    added = T.StructType([*base, *map(T.StructField, _ADDED, kinds)])
    for name, kind in zip(_STATE, lists, strict=True):
        current = current.withColumn(name, F.lit(None).cast(kind))
    for block in range(blocks):
        texts = items.where(F.col("block") == block).select("item_id", "text").collect()
        grams = _item_windows([tuple(r) for r in texts], window)
        shared = docs.sparkSession.sparkContext.broadcast((grams, _index(grams)))
        last = block == blocks - 1
        current = current.mapInArrow(_scan(shared, last), added if last else state)
    return current.withColumn("clean", F.coalesce("clean", "text"))
