"""Substring dedup: remove words inside windows that occur more than once.

Level-wise doubling over window lengths of a quarter, a half and the whole:

* A window's *anchor* at a length is its leftmost sub-window of that length with the smallest hash.
  It depends on the window's words only, so equal windows have equal anchors, and neighbouring
  windows mostly share one: far fewer anchors than words are shuffled.
* Quarter: anchors of all documents are counted. Only windows whose anchor occurs again go on.
* Half: their anchors of twice that length are counted, together with their *surroundings*, the words
  of all windows that can have this anchor. Surroundings that occur again settle all those windows
  at once; an anchor that does not occur again ends them.
* Whole: what is left, at the borders of repeated passages, is counted window by window, against one
  occurrence of every surroundings that holds the same anchor.

Counts are grouped sums, pre-aggregated in the map tasks, and then joined from a written table, which
adaptive execution can split for a passage in a large share of all documents. Only documents with
a repeated anchor are kept as text, bucketed by document, so later levels move no text.

Defined results: null and empty texts have no words; repeated rows are documents of their own, whose
windows repeat each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm import words as wd
from kinfold.llm.tables import bucketed
from kinfold.session import materialize

WINDOW = 35
NO_ID = -(1 << 63)  # stands for a null doc_id; equal texts get equal results in any case
_KEY = ("id", "row")
_ANCHOR = "h long, id long, row long, pos int"
_HALF = "h long, around long, id long, row long, pos int"
_WHOLE = "h long, id long, row long, pos int, n int, sure boolean"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.col("text").cast("string").alias("text"),
    ).withColumn("row", F.xxhash64("text"))


def _levels(window: int) -> tuple[int, int]:
    half = -(-window // 2)
    return -(-half // 2), half


class _Slice:
    """Word hashes of a slice of documents and the anchors of its windows."""

    def __init__(self, batch: pa.RecordBatch, window: int) -> None:
        data, offsets = wd.text_bytes(batch.column("text"))
        found = wd.split_words(data, offsets)
        self.batch, self.window, self.hash, self.row = batch, window, found.hash, found.row
        self.first, self.after = wd.row_spans(found.row, batch.num_rows)
        self.whole = wd.within_row(found.row, window)  # by first word

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``length`` words, and every window's anchor by first word."""
        runs = wd.windows(self.hash, length)
        return runs, wd.lowest(runs, self.window - length + 1)[: len(self.whole)]

    def marked(self, column: str) -> np.ndarray:
        """Which words a list column of word positions names."""
        lists = self.batch.column(column)
        flags = np.zeros(len(self.hash), bool)
        sizes = np.diff(lists.offsets.to_numpy())
        places = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = np.where(np.asarray(lists.is_valid()), sizes, 0)
        flags[np.repeat(self.first, sizes) + places] = True
        return flags

    def rows(self, places: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
        """One row per place: given columns, document key, position in the document."""
        row = self.row[places]
        take = pa.array(row)
        arrays = {k: pa.array(v.view(np.int64)) for k, v in columns.items()}
        arrays |= {k: self.batch.column(k).take(take) for k in _KEY}
        arrays["pos"] = pa.array(places - self.first[row], pa.int32())
        return pa.RecordBatch.from_pydict(arrays)


def _slices(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[_Slice]:
    for whole in batches:
        for batch in wd.slices(whole, "text"):
            yield _Slice(batch, window)


def _quarter_anchors(window: int):
    quarter, _ = _levels(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, window):
            runs, anchor = part.anchors(quarter)
            places = wd.distinct(anchor[part.whole])
            yield part.rows(places, h=runs[places])

    return run


def _half_anchors(window: int):
    quarter, half = _levels(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, window):
            _, anchor = part.anchors(quarter)
            open_windows = part.whole & part.marked("marks")[anchor]
            runs, anchor = part.anchors(half)
            places = wd.distinct(anchor[open_windows])
            row = part.row[places]
            first = np.maximum(places - (window - half), part.first[row])
            after = np.minimum(places + window, part.after[row])
            around = wd.run_hashes(part.hash, first, after)
            around = wd.mix(around + wd.mix((places - first).astype(np.uint64)))
            yield part.rows(places, h=runs[places], around=around)

    return run


def _whole_windows(window: int):
    """Windows of settled anchors (``sure``) and windows to count."""
    _, half = _levels(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, window):
            _, anchor = part.anchors(half)
            sure = np.flatnonzero(part.whole & part.marked("settled")[anchor])
            open_ = np.flatnonzero(part.whole & part.marked("unsettled")[anchor])
            first, n = _runs(sure, part.row[sure])
            settled = part.rows(first, h=np.zeros(len(first), np.uint64))
            counted = part.rows(open_, h=wd.run_hashes(part.hash, open_, open_ + window))
            for rows, size, is_sure in ((settled, n, True), (counted, np.ones(len(open_)), False)):
                sized = rows.append_column("n", pa.array(size.astype(np.int32)))
                yield sized.append_column("sure", pa.array(np.full(len(size), is_sure)))

    return run


def _runs(places: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and size of every run of consecutive places in one row."""
    if not len(places):
        return places, places
    breaks = np.flatnonzero((np.diff(places) > 1) | (np.diff(row) > 0)) + 1
    first = np.r_[0, breaks]
    return places[first], np.diff(np.r_[first, len(places)])


def _again(rows: DataFrame, column: str) -> DataFrame:
    """The values of ``column`` that occur more than once, as a written table."""
    counted = rows.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    return materialize(counted.select(column), "again")


def _by_document(rows: DataFrame, **lists: str) -> DataFrame:
    """Positions per document, bounded by its words: one list column per condition."""
    chosen = [F.collect_set(F.when(F.expr(c), F.col("pos"))).alias(n) for n, c in lists.items()]
    return rows.groupBy(*_KEY).agg(*chosen)


def _clean(window: int):
    def cleaned(text: str, spans: list[dict]) -> tuple[int, bytes]:
        words = text.encode().split()
        starts = np.array([s["pos"] for s in spans])
        sizes = np.array([s["n"] for s in spans]) - 1 + window
        gone = wd.covered(starts, sizes, len(words))
        return int(gone.sum()), b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in wd.slices(whole, "text"):  # one text at a time is held as words
                texts, spans = batch.column("text"), batch.column("spans")
                rows = [cleaned(texts[i].as_py(), spans[i].as_py()) for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in _KEY), pa.array([n for n, _ in rows], pa.int64())]
                    + [pa.array([k for _, k in rows], pa.binary()).cast(pa.string())],
                    names=[*_KEY, "n_removed", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, row, n_removed, kept`` of the documents that lose words, one row each.

    A word is a run of characters that are not ASCII white space. Words go if a window of ``window``
    words covers them that also starts elsewhere, in the same document included. ``kept`` has the
    other words, joined by one space. ``id`` is ``doc_id`` (``NO_ID`` for null), ``row`` a hash of the
    text.
    """
    texts = _texts(docs).where("text IS NOT NULL")
    quarter = materialize(texts.mapInArrow(_quarter_anchors(window), _ANCHOR), "anchors")
    marks = _by_document(quarter.join(_again(quarter, "h"), "h"), marks="true")
    candidates = bucketed(texts.join(marks, [*_KEY]), *_KEY)

    half = materialize(candidates.mapInArrow(_half_anchors(window), _HALF), "anchors")
    twice = _again(half, "around").withColumn("settled", F.lit(True))
    live = materialize(
        half.join(_again(half, "h"), "h")
        .join(twice, "around", "left")
        .withColumn("settled", F.col("settled").isNotNull()),
        "anchors",
    )
    border = materialize(live.where("NOT settled").select("h").distinct(), "again")
    examples = live.where("settled").join(border, "h").dropDuplicates(["around"])
    places = _by_document(
        live.select(*_KEY, "pos", "settled", F.lit(False).alias("example")).unionByName(
            examples.select(*_KEY, "pos", F.lit(False).alias("settled"), F.lit(True).alias("example"))
        ),
        settled="settled",
        unsettled="NOT settled",
    )
    whole = materialize(
        candidates.join(places, [*_KEY]).mapInArrow(_whole_windows(window), _WHOLE), "windows"
    )
    counted = whole.where("NOT sure")
    span = F.struct("pos", "n")
    found = counted.join(_again(counted, "h"), "h").select(*_KEY, span.alias("span"))
    settled = whole.where("sure").select(*_KEY, span.alias("span"))
    spans = settled.unionByName(found).groupBy(*_KEY).agg(F.collect_set("span").alias("spans"))
    return (
        candidates.select(*_KEY, "text")
        .join(spans, [*_KEY])
        .mapInArrow(_clean(window), "id long, row long, n_removed long, kept string")
        .dropDuplicates([*_KEY])
    )


def plain_words(docs: DataFrame) -> DataFrame:
    """``doc_id, row, n_words, plain`` of every row: its words joined by one space."""
    text = F.col("text").cast("string")
    plain = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " "), F.lit(" "))
    spaces = F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit("")))
    n_words = F.when(F.col("plain") == "", 0).otherwise(spaces + 1).cast("long")
    rows = docs.select("doc_id", F.xxhash64(text).alias("row"), plain.alias("plain"))
    return rows.select("doc_id", "row", n_words.alias("n_words"), "plain")
