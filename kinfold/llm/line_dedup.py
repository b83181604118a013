"""Line dedup: lines that many documents share stay in one document only.

Hashes of long lines are range partitioned with a secondary sort by document (largest first) and
position, so the occurrences of one hash follow each other and the first is the one that keeps its
line. A task streams its range with a buffer of a few documents. Only the first and the last hash
of a range can go on in a neighbour range; they are settled by a table of two rows per range. A hash
that a third of all documents share is thus spread over many tasks.

The result holds no text: per document the number of lines and, if any line goes, a compressed
bitmap of the lines to keep.

Defined results: a null or empty text is one empty line; a null ``doc_id`` keeps all its lines and
counts for no hash; rows that agree in id and text are one document.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm.tables import documents, with_text
from kinfold.session import materialize

MIN_CHARS = 40
MIN_DOCUMENTS = 5
_SPACE = b" \t\n\x0b\x0c\r"
_LINE = "doc_id long, row long, n_lines int, h1 long, h2 long, pos int"
_SWEPT = f"{_LINE}, kind string, docs int, last_doc long"


def _long_lines(min_chars: int):
    """One row for every line whose key (stripped, A-Z lower-cased) is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[int]] = [[] for _ in range(6)]
            for doc_id, text, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines = text.encode().split(b"\n")
                for pos, line in enumerate(lines):
                    key = line.strip(_SPACE).lower()  # ASCII only, as bytes
                    if len(key) < min_chars or len(key.decode()) < min_chars:
                        continue
                    digest = hashlib.blake2b(key, digest_size=16).digest()
                    heads = (int.from_bytes(d, "little", signed=True) for d in (digest[:8], digest[8:]))
                    for column, value in zip(found, (doc_id, row, len(lines), *heads, pos), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(found, kinds, strict=True)],
                names=["doc_id", "row", "n_lines", "h1", "h2", "pos"],
            )

    return run


def _sweep(min_documents: int):
    """Stream one sorted range.

    Rows out are lines of three kinds: ``drop``; ``open``, undecided lines of the first or last hash
    of the range; and ``edge``, one row per such hash with its largest (``doc_id``) and smallest
    document and the number of its documents in this range.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, edge_row = None, None
        leads = True  # whether the current hash is the first of the range
        held: list[pd.DataFrame] = []  # its lines while it has too few documents
        docs_seen, last_doc, keeper = 0, None, None

        def edge() -> pd.DataFrame:
            return edge_row.assign(kind="edge", docs=docs_seen, last_doc=last_doc, pos=-1)

        for batch in batches:
            if batch.empty:
                continue
            h1, h2 = batch["h1"].to_numpy(), batch["h2"].to_numpy()
            new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            starts = np.flatnonzero(new)
            done = []
            for a, b in zip(starts, np.r_[starts[1:], len(batch)], strict=True):
                part = batch.iloc[a:b]
                if (h1[a], h2[a]) != current:
                    if current is not None and leads:
                        done.append(edge())
                        leads = False
                    current, edge_row, keeper = (h1[a], h2[a]), part.iloc[:1], part["doc_id"].iat[0]
                    held, docs_seen, last_doc = [], 0, None
                docs = part["doc_id"].to_numpy()
                docs_seen += int((docs[1:] != docs[:-1]).sum()) + int(docs[0] != last_doc)
                last_doc = docs[-1]
                if leads:
                    done.append(part.assign(kind="open", docs=0, last_doc=0))
                elif docs_seen < min_documents:
                    held.append(part)
                else:
                    rows = pd.concat([*held, part]) if held else part
                    rows, held = rows[rows["doc_id"] != keeper], []
                    if len(rows):
                        done.append(rows.assign(kind="drop", docs=0, last_doc=0))
            if done:
                yield pd.concat(done)
        if current is not None:
            yield pd.concat([*(p.assign(kind="open", docs=0, last_doc=0) for p in held), edge()])

    return run


def shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``doc_id, row, n_lines, pos`` of every line to drop (``row``: see ``tables.documents``)."""
    source = documents(docs).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    order = ["h1", "h2", F.desc("doc_id"), "row", "pos"]
    ranges = source.mapInArrow(_long_lines(min_chars), _LINE).repartitionByRange(*order)
    swept = materialize(
        ranges.sortWithinPartitions(*order)
        .mapInPandas(_sweep(min_documents), _SWEPT)
        .withColumn("part", F.spark_partition_id()),
        "lines",
    )
    # A document on both sides of a border is counted once.
    hashes = W.partitionBy("h1", "h2").orderBy("part")
    again = F.coalesce((F.lag("last_doc").over(hashes) == F.col("doc_id")).cast("int"), F.lit(0))
    edges = (
        swept.where("kind = 'edge'")
        .withColumn("docs", F.col("docs") - again)
        .groupBy("h1", "h2")
        .agg(F.sum("docs").alias("all_docs"), F.max("doc_id").alias("keeper"))
    )
    settled = (
        swept.where("kind = 'open'")
        .join(F.broadcast(edges), ["h1", "h2"])  # two rows per range at most
        .where((F.col("all_docs") >= min_documents) & (F.col("doc_id") != F.col("keeper")))
    )
    columns = ["doc_id", "row", "n_lines", "pos"]
    return swept.where("kind = 'drop'").select(columns).unionByName(settled.select(columns))


@F.pandas_udf(T.BinaryType())
def _bitmap(drops: pd.Series, n_lines: pd.Series) -> pd.Series:
    def one(places: np.ndarray, n: int) -> bytes:
        keep = np.ones(n, np.uint8)
        keep[places] = 0
        return zlib.compress(np.packbits(keep).tobytes(), 1)

    return pd.Series([one(p, n) for p, n in zip(drops, n_lines, strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def _kept(texts: pd.Series, bitmaps: pd.Series) -> pd.Series:
    def one(text: str | None, bitmap: bytes | None) -> str | None:
        if text is None or bitmap is None:
            return None
        lines = text.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
        return "\n".join(line for line, k in zip(lines, keep, strict=True) if k)

    return pd.Series([one(t, b) for t, b in zip(texts, bitmaps, strict=True)], dtype=object)


def kept_text(text: Column, bitmap: Column) -> Column:
    """The lines a bitmap keeps, joined. Texts without a bitmap never leave the JVM."""
    return F.coalesce(_kept(F.when(bitmap.isNotNull(), text), bitmap), text)


def line_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``doc_id, row, n_dropped, keep_bitmap`` of the documents that lose lines.

    A key (the line without ASCII white space at both ends, A-Z lower-cased) of at least
    ``min_chars`` code points in at least ``min_documents`` documents stays in the one with the
    largest ``doc_id`` only, there as often as it occurs.
    """
    lines = shared_lines(docs, min_chars, min_documents)
    return (
        lines.groupBy("doc_id", "row", "n_lines")
        .agg(F.collect_set("pos").alias("_pos"))  # bounded by the lines of one document
        .select(
            "doc_id",
            "row",
            F.size("_pos").cast("long").alias("n_dropped"),
            _bitmap("_pos", "n_lines").alias("keep_bitmap"),
        )
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """Every row of ``docs`` as ``doc_id, text, n_lines, n_dropped, keep_bitmap`` (null: keep all).

    ``kept_text`` applies the bitmap.
    """
    text = F.coalesce("text", F.lit(""))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return with_text(docs, line_bitmaps(docs, min_chars, min_documents)).select(
        "doc_id",
        "text",
        (breaks + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        "keep_bitmap",
    )
