"""Messy delimited text: preamble, delimiter and encoding are found per file.

A few lines of each file decide its layout. Tasks read them and find the layouts, many files in one job;
one more job passes over all lines and finds encodings and open quotes. Files of one layout are then
read together by one scan. Columns are strings, missing and empty fields are null, rows with too many
fields are dropped and short rows are padded. A quoted field with a line break is an error, unless
``multi_line`` reads it. ``read_delimited_with_rejects`` gives the lines that were not read as a table.
"""

from __future__ import annotations

import csv
import json
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from typing import IO, NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinfold.operators.identity import keep_first_rows
from kinfold.operators.mapping import union_all_by_name
from kinfold.sources.files import SourceFile, file_stem, open_uri, resolve, within_reach

# Delimiters and encodings in the order they are tried, and the preamble rule.
DELIMITERS = ("\t", "|", ",")
ENCODINGS = ("UTF-8", "ISO-8859-1")
HEAD_LINES = 50
DENSE = 5
SHOWN = 200  # characters of a rejected line

_BAD = "_bad"
_OPEN = "a quoted field goes on in the next line (multi_line reads such files)"
_END = "\x02end"  # appended field that shows where a line really ends
POSITION = ("_file", "_block", "_row")


class Layout(NamedTuple):
    delimiter: str
    header_line: int
    columns: tuple[str, ...]
    encoding: str


def _unique(names: Sequence[str]) -> tuple[str, ...]:
    """Header names made usable: blanks get a name, repeats a number."""
    out: list[str] = []
    for i, raw in enumerate(names):
        base = raw or f"Unnamed: {i}"
        name, n = base, 0
        while name in out:
            n += 1
            name = f"{base}.{n}"
        out.append(name)
    return tuple(out)


def find_layout(head: Sequence[str], encoding: str = ENCODINGS[0]) -> Layout:
    """Layout from the first lines of a file.

    The header is the first line with many tabs or pipes, else the first line; the delimiter is
    the first that splits the header.
    """
    start = next(
        (i for i, s in enumerate(head) if s.count("\t") > DENSE or s.count("|") > DENSE), 0
    )
    if start < len(head):
        header = head[start].lstrip("﻿")
        for delimiter in DELIMITERS:
            names = next(csv.reader([header], delimiter=delimiter), [])
            if len(names) > 1:
                return Layout(delimiter, start, _unique(names), encoding)
    raise ValueError(f"no delimiter of {DELIMITERS} gives more than one column")


class Sniffed(NamedTuple):
    """What the lines of a file say: whether all are UTF-8, and per delimiter how many end inside a
    quoted field."""

    utf8: bool
    open_quotes: tuple[int, ...]


def sniff_lines(spark: SparkSession, files: Sequence[SourceFile]) -> dict[str, Sniffed]:
    """One pass over the lines of all files, summed up before the shuffle."""
    lines = spark.read.text([f.path for f in files])
    line = F.col("value")
    ends = [
        F.sum(open_quote(line, Layout(d, 0, (), "")).cast("long")).alias(f"open_{i}")
        for i, d in enumerate(DELIMITERS)
    ]
    found = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(F.is_valid_utf8(line)).alias("utf8"), *ends
    )
    return {
        r["file"]: Sniffed(r["utf8"], tuple(r[f"open_{i}"] for i in range(len(DELIMITERS))))
        for r in found.collect()  # a row per file
    }


_LAYOUTS = "file string, code string, layout string, error string"


def _layout_rows(file: str, head: Sequence[bytes], codes: Sequence[str]) -> list[tuple]:
    rows = []
    for code in codes:
        try:
            layout = find_layout([line.decode(code, "replace") for line in head], code)
            rows.append((file, code, json.dumps(layout), None))
        except ValueError as wrong:
            rows.append((file, code, None, str(wrong)))
    return rows


def head_lines(stream: IO[bytes], most: int = HEAD_LINES) -> list[bytes]:
    """The first lines of a stream; no more is read than they need."""
    held = b""
    while part := stream.read(1 << 16):
        held += part
        if max(held.count(b"\n"), held.count(b"\r")) > most:
            break
    lines = re.split(b"\r\n|\r|\n", held)[: most + 1]
    return lines[:most] if lines[-1:] != [b""] or len(lines) > most else lines[:-1]


def find_heads(spark: SparkSession, files: Sequence[SourceFile], codes: Sequence[str]) -> DataFrame:
    """``file, code, layout, error`` per file and encoding, found by tasks from the first lines.

    Tasks open the files themselves and read their beginnings. Where only Spark can open them, they are
    taken from a scan that trims every file to its first lines inside the task.
    """
    if within_reach(files[0].file_path):

        def from_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for file in batch["file"]:
                    with open_uri(file) as stream:
                        rows += _layout_rows(file, head_lines(stream), codes)
                yield pd.DataFrame(rows, columns=["file", "code", "layout", "error"])

        names = spark.createDataFrame([(f.file_path,) for f in files], "file string")
        tasks = min(len(files), spark.sparkContext.defaultParallelism * 4)
        return names.repartition(tasks, "file").mapInPandas(from_files, _LAYOUTS)

    def from_lines(group: pd.DataFrame) -> pd.DataFrame:
        head = [bytes(x) for x in group.sort_values("_row")["raw"]]
        rows = _layout_rows(group["_file"].iloc[0], head, codes)
        return pd.DataFrame(rows, columns=["file", "code", "layout", "error"])

    lines = spark.read.text([f.path for f in files]).select(
        F.col("value").cast("binary").alias("raw"), *_positions()
    )
    first = keep_first_rows(lines.where("_block = 0"), HEAD_LINES, ["_row"], ["_file"])
    return first.groupBy("_file").applyInPandas(from_lines, _LAYOUTS)


def find_layouts(
    spark: SparkSession,
    files: Sequence[SourceFile],
    encoding: str | None = None,
    multi_line: bool = True,
) -> dict[Layout, list[str]]:
    """Files by layout, by two jobs however many files there are.

    Without ``multi_line``, a file of which a line ends inside a quoted field is an error here if its
    header is in the first line (else it is one when that line is read).
    """
    codes = [encoding] if encoding else list(ENCODINGS)
    need = encoding is None or not multi_line
    sniffed = sniff_lines(spark, files) if need else {}
    found = {(r["file"], r["code"]): r for r in find_heads(spark, files, codes).collect()}
    groups: dict[Layout, list[str]] = defaultdict(list)
    for file in files:
        about = sniffed.get(file.file_path, Sniffed(True, (0,) * len(DELIMITERS)))
        code = encoding or ENCODINGS[0 if about.utf8 else 1]
        row = found[file.file_path, code]
        if row["layout"] is None:
            raise ValueError(f"cannot parse {file.path}: {row['error']}")
        delimiter, start, names, _ = json.loads(row["layout"])
        lines = about.open_quotes[DELIMITERS.index(delimiter)]
        if lines and not multi_line and not start:
            raise ValueError(f"{_OPEN}: {lines} lines of {file.path}")
        groups[Layout(delimiter, start, tuple(names), code)].append(file.path)
    return groups


def _options(layout: Layout) -> dict[str, str]:
    return {"sep": layout.delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def open_quote(line: Column, layout: Layout) -> Column:
    """Whether a quoted field of the line is not closed in it."""
    starts = f"(^|{re.escape(layout.delimiter)})\""
    closed = starts + '[^"]*+(?:""[^"]*+)*+"'
    return line.contains('"') & F.regexp_replace(line, closed, "$1").rlike(starts)


def parse_lines(line: Column, layout: Layout, strict: bool = True) -> Column:
    """Fields of decoded lines as an array, null for a line with too many fields.

    A line that ends inside a quoted field is an error, or null if not ``strict``.

    A mark is appended as one more field: it sits right behind the last column of a full line,
    earlier in a short line, and is not seen at all in a line that is too long.
    """
    n = len(layout.columns)
    schema = ", ".join(f"f{i} string" for i in range(n + 1))
    marked = F.from_csv(
        F.concat(line, F.lit(layout.delimiter + _END)), schema, _options(layout)
    )
    fields = F.array(*[marked[f"f{i}"] for i in range(n + 1)])

    def tidy(found: Column) -> Column:
        clean = F.transform(found, lambda v: F.nullif(F.nullif(v, F.lit(_END)), F.lit("")))
        return F.when(F.array_contains(found, F.lit(_END)), F.slice(clean, 1, n))

    parsed = F.get(F.transform(F.array(fields), tidy), F.lit(0))
    if not strict:
        return F.when(~open_quote(line, layout), parsed)
    text = F.concat(F.lit(f"{_OPEN}: "), F.substring(line, 1, 100))
    return F.when(open_quote(line, layout), F.raise_error(text)).otherwise(parsed)


def count_open_quotes(spark: SparkSession, paths: Sequence[str], layout: Layout) -> DataFrame:
    """``file, lines``: the lines that end inside a quoted field, of the files that have any."""
    lines = spark.read.text(list(paths)).where(open_quote(F.col("value"), layout))
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("lines")
    )


def _positions() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    ]


def _refuse_open_quotes(spark: SparkSession, paths: list[str], layout: Layout) -> None:
    """Spark's reader would end the row there, and begin another one."""
    broken = count_open_quotes(spark, paths, layout).orderBy("file").limit(1).collect()
    if broken:
        raise ValueError(f"{_OPEN}: {broken[0].lines} lines of {broken[0].file}")


def _read_plain(spark: SparkSession, paths: list[str], layout: Layout) -> DataFrame:
    """Header in the first line: Spark's own reader, which also drops the header."""
    names = [f"f{i}" for i in range(len(layout.columns))]
    table = (
        spark.read.schema(", ".join(f"{c} string" for c in [*names, _BAD]))
        .options(**_options(layout))
        .option("header", True)
        .option("encoding", layout.encoding)
        .option("columnNameOfCorruptRecord", _BAD)
        .option("columnPruning", False)  # else the width of a line goes unchecked
        .csv(paths)
    )
    # Only lines of unusual width arrive with their text in _BAD; parse those again to tell short
    # from long. The test on f0 is always true: Spark refuses a scan of nothing but _BAD.
    fits = F.col(_BAD).isNull() | parse_lines(F.col(_BAD), layout).isNotNull()
    some = F.col("f0").isNull() | (F.length("f0") >= 0)
    return table.where(some & fits).select(
        *[F.nullif(c, F.lit("")).alias(c) for c in names], *_positions()
    )


def _text(layout: Layout) -> Column:
    return F.decode(F.col("value").cast("binary"), layout.encoding)


def _read_behind_preamble(
    spark: SparkSession, paths: list[str], layout: Layout, strict: bool = True
) -> DataFrame:
    """Header further down: lines are counted in the first block of each file, the rest is taken."""
    lines = spark.read.text(paths).select("value", *_positions())
    counted = (
        lines.where("_block = 0")
        .withColumn("_line", F.row_number().over(W.partitionBy("_file").orderBy("_row")))
        .where(F.col("_line") > layout.header_line + 1)
        .drop("_line")
    )
    lines = counted.unionByName(lines.where("_block > 0"))
    text = _text(layout)
    only_blanks = F.trim(text) == ""
    fields = lines.where(~only_blanks).select(
        parse_lines(text, layout, strict).alias("_fields"), *POSITION
    )
    return fields.where(F.col("_fields").isNotNull()).select(
        *[F.col("_fields")[i].alias(f"f{i}") for i in range(len(layout.columns))], *POSITION
    )


def _read_multi_line(spark: SparkSession, paths: list[str], layout: Layout) -> DataFrame:
    """Records of Spark's multi-line reader; a file is one task.

    The schema has one column too many, so every record that fits comes with its text in _BAD.
    """
    n = len(layout.columns)
    table = (
        spark.read.schema(", ".join(f"{c} string" for c in [*(f"f{i}" for i in range(n + 1)), _BAD]))
        .options(**_options(layout))
        .option("multiLine", True)
        .option("header", not layout.header_line)
        .option("encoding", layout.encoding)
        .option("columnNameOfCorruptRecord", _BAD)
        .option("columnPruning", False)
        .csv(paths)
    )
    some = F.col("f0").isNull() | (F.length("f0") >= 0)  # see _read_plain
    records = table.where(some).select(F.regexp_replace(_BAD, r"^[\r\n]+|[\r\n]+$", "").alias("_text"),
                                       *[f"f{i}" for i in range(n)], *_positions())
    if layout.header_line:
        same = F.lit(True)
        for i, name in enumerate(layout.columns):
            own = F.coalesce(f"f{i}", F.lit(f"Unnamed: {i}"))
            same &= (own == name) | F.lit(name).startswith(F.concat(own, F.lit(".")))
        header = F.min(F.when(same, F.col("_row"))).over(W.partitionBy("_file"))
        lost = F.raise_error(F.concat(F.lit("no header record in "), F.col("_file")))
        records = records.withColumn("_header", F.coalesce(header, lost.cast("long")))
        records = records.where("_row > _header")
    fields = records.select(parse_lines(F.col("_text"), layout).alias("_fields"), *POSITION)
    return fields.where(F.col("_fields").isNotNull()).select(
        *[F.col("_fields")[i].alias(f"f{i}") for i in range(n)], *POSITION
    )


def _named(part: DataFrame, layout: Layout, position: bool) -> DataFrame:
    named = [F.col(f"f{i}").alias(c) for i, c in enumerate(layout.columns)]
    extra = [file_stem(F.col("_file")).alias("dataset"), *POSITION] if position else []
    return part.select(*named, *extra)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    max_rows: int | None = None,
    infer: bool = False,
    encoding: str | None = None,
    layout: Layout | None = None,
    position: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Read files that may differ in preamble, delimiter, encoding and columns.

    ``encoding`` is taken as it is; a ``layout`` known for all files saves all looking.
    ``max_rows`` caps the rows per file. ``infer`` turns columns of numbers and booleans into such.
    ``position`` adds ``dataset`` (the file name without suffix) and ``_file``, ``_block``,
    ``_row``, which together give the order of the rows in their file. ``multi_line`` takes line
    breaks in quoted fields as text; each file is then one task. Without it they are an error.
    """
    if layout is not None:
        groups = {layout: [paths] if isinstance(paths, str) else list(paths)}
        if not multi_line and not layout.header_line:
            _refuse_open_quotes(spark, groups[layout], layout)
    else:
        groups = find_layouts(spark, resolve(spark, paths), encoding, multi_line)
    parts = []
    for found, files in groups.items():
        read = _read_behind_preamble if found.header_line else _read_plain
        if multi_line:
            read = _read_multi_line
        part = read(spark, files, found)
        if max_rows is not None:
            part = keep_first_rows(part, max_rows, ["_block", "_row"], ["_file"])
        parts.append(_named(part, found, position))
    table = union_all_by_name(parts)
    return infer_types(table) if infer else table


def _rejected(spark: SparkSession, paths: list[str], layout: Layout) -> DataFrame:
    """``file, line, reason, text`` of the lines behind the header that give no row.

    One pass: a split's rejected lines are collected with the number of its lines, and the lines of the
    splits before are added to their numbers. Lines are counted from 1, the preamble included.
    """
    text = _text(layout)
    reason = F.when(open_quote(text, layout), "open quote").when(
        (F.trim(text) != "") & parse_lines(text, layout, strict=False).isNull(), "too long"
    )
    lines = spark.read.text(paths).select("value", *_positions())
    lines = lines.select(
        *POSITION, F.struct(F.col("_row"), reason.alias("reason"), F.substring(text, 1, SHOWN).alias("text")).alias("_x")
    )
    splits = lines.groupBy("_file", "_block").agg(
        F.min("_row").alias("_first"),
        F.count("*").alias("_lines"),
        F.collect_list(F.when(F.col("_x.reason").isNotNull(), F.col("_x"))).alias("_bad"),
    )
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_lines").over(earlier), F.lit(0))
    placed = splits.withColumn("_before", before - F.col("_first") + 1)
    bad = placed.select("_file", "_before", F.explode("_bad").alias("_x"))
    return bad.select(
        F.col("_file").alias("file"),
        (F.col("_x._row") + F.col("_before")).alias("line"),
        "_x.reason",
        "_x.text",
    ).where(F.col("line") > layout.header_line + 1)


def read_delimited_with_rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    encoding: str | None = None,
    position: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """As ``read_delimited``, and what it leaves out: ``file, line, reason, text``.

    Lines with too many fields are ``too long``; a line that ends inside a quoted field is ``open
    quote``, and no error here. Every line behind the header that is not blank is in one of the two.
    ``text`` is the beginning of the line.
    """
    rows, rejects = [], []
    for found, files in find_layouts(spark, resolve(spark, paths), encoding).items():
        rows.append(_named(_read_behind_preamble(spark, files, found, strict=False), found, position))
        rejects.append(_rejected(spark, files, found))
    return union_all_by_name(rows), union_all_by_name(rejects)


def infer_types(df: DataFrame) -> DataFrame:
    """Cast columns whose values are all integers, numbers or booleans; one pass finds them."""
    tests = {"bigint": r"^[+-]?\d{1,18}$", "double": r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$",
             "boolean": r"^(?i:true|false)$"}
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not text:
        return df
    flags = df.agg(
        *[
            F.min(F.col(f"`{c}`").rlike(test)).alias(f"{i}_{kind}")
            for i, c in enumerate(text)
            for kind, test in tests.items()
        ]
    ).first()
    casts = {}
    for i, c in enumerate(text):
        kind = next((k for k in tests if flags[f"{i}_{k}"]), None)
        if kind:
            casts[c] = F.col(f"`{c}`").cast(kind).alias(c)
    return df.select(*[casts.get(c, F.col(f"`{c}`")) for c in df.columns])
