"""JSON files: arrays of records, single objects, and one record per line."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from io import TextIOWrapper
from itertools import chain, islice
from typing import IO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.operators.mapping import union_all_by_name
from kinfold.session import scratch_path
from kinfold.sources.files import SourceFile, open_uri, resolve, within_reach

ARRAY, OBJECT, LINES = "array", "object", "lines"
SPLIT_OVER = 64 << 20  # bytes of an array that is still read as one value


def json_kind(first: str, more: bool) -> str:
    """Kind of a file by its first line that is not blank, and whether another one follows.

    One complete object alone is a single object, not a table of one line.
    """
    start = first.strip().lstrip("﻿")
    if start.startswith("["):
        return ARRAY
    if start.startswith("{"):
        try:
            json.loads(start)
        except json.JSONDecodeError:
            return OBJECT  # the object goes on in the next lines
        return LINES if more else OBJECT
    raise ValueError(f"not a JSON array, object or lines of objects: {start[:40]!r}")


def array_records(parts: Iterable[str]) -> Iterator[str]:
    """The texts of the records of one top-level array, given in parts; one record is held at a time."""
    decode = json.JSONDecoder().raw_decode
    source, blank = iter(parts), re.compile(r"[\ufeff\s]*")
    text, at, ended = "", 0, False

    def more() -> bool:
        """Read on: at least as much as is held, so that a long record is not parsed too often."""
        nonlocal text, at, ended
        held = [text[at:]]
        want, got = max(len(held[0]), 1), 0
        while got < want and not ended:
            part = next(source, None)
            ended = part is None
            held.append(part or "")
            got += len(part or "")
        text, at = "".join(held), 0
        return got > 0

    def token() -> str:
        """The next character that is not white space."""
        nonlocal at
        at = blank.match(text, at).end()
        while at == len(text) and more():
            at = blank.match(text, at).end()
        return text[at : at + 1]

    if token() != "[":
        raise ValueError("not a JSON array")
    at += 1
    if token() == "]":
        return
    while True:
        token()
        while True:
            try:
                _, end = decode(text, at)
                if end < len(text) or ended:  # a number may go on
                    break
            except json.JSONDecodeError:
                if ended:
                    raise
            more()
        yield text[at:end]
        at = end
        mark = token()
        if mark not in (",", "]"):
            raise ValueError(f"no comma or end after a record: {text[at:at + 40]!r}")
        at += 1
        if mark == "]":
            return


def stream_kind(stream: IO[bytes]) -> str:
    """Kind of the JSON in a stream. Of an array one character is looked at, else two lines."""
    start = b""
    while not start:
        part = stream.read(1 << 12)
        if not part:
            raise ValueError("empty JSON file")
        start = part.removeprefix(b"\xef\xbb\xbf").lstrip()
    if start.startswith(b"["):
        return ARRAY
    held = b""
    for part in chain([start], iter(lambda: stream.read(1 << 16), b"")):
        held += part
        lines = [x for x in held.splitlines(keepends=True) if x.strip()]
        if len(lines) > 1:  # the first line is whole, and another one follows
            break
    return json_kind(lines[0].decode("utf-8"), len(lines) > 1)


_KINDS = "file string, kind string, error string"


def find_kinds(spark: SparkSession, files: Sequence[SourceFile]) -> dict[str, str]:
    """Kind per file, found by tasks in one job; no line reaches the driver.

    Tasks open the files themselves. Where only Spark can open them, its lines tell the same.
    """
    if within_reach(files[0].file_path):

        def kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for file in batch["file"]:
                    try:
                        with open_uri(file) as stream:
                            rows.append((file, stream_kind(stream), None))
                    except ValueError as wrong:
                        rows.append((file, None, str(wrong)))
                yield pd.DataFrame(rows, columns=["file", "kind", "error"])

        names = spark.createDataFrame([(f.file_path,) for f in files], "file string")
        tasks = min(len(files), spark.sparkContext.defaultParallelism * 4)
        found = names.repartition(tasks, "file").mapInPandas(kinds, _KINDS)
    else:
        found = _kinds_of_lines(spark, files)
    by_file = {r["file"]: r for r in found.collect()}  # a row per file
    for file in files:
        row = by_file.get(file.file_path)
        if row is None or row["kind"] is None:
            raise ValueError(f"{file.path}: {row['error'] if row else 'empty JSON file'}")
    return {f.path: by_file[f.file_path]["kind"] for f in files}


def _kinds_of_lines(spark: SparkSession, files: Sequence[SourceFile]) -> DataFrame:
    text = F.trim(F.regexp_replace("value", "^\\ufeff", ""))
    lines = spark.read.text([f.path for f in files]).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
        F.substring(text, 1, 1).alias("start"),
        F.get_json_object(text, "$").isNotNull().alias("whole"),
    )
    found = lines.where("start <> ''").groupBy("file").agg(
        F.min_by(F.struct("start", "whole"), "at").alias("first"), F.count("*").alias("lines")
    )
    kind = F.when(F.col("first.start") == "[", ARRAY).when(
        F.col("first.start") == "{",
        F.when(F.col("first.whole") & (F.col("lines") > 1), LINES).otherwise(OBJECT),
    )
    return found.select("file", kind.alias("kind"), F.lit("not a JSON array or object").alias("error"))


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested structs become columns with dotted names; arrays stay."""

    def leaves(kind: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in kind.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(".".join(here)))
        return out

    return df.select(*leaves(df.schema, ()))


def split_arrays(spark: SparkSession, files: Sequence[SourceFile]) -> str:
    """The records of large arrays as lines of text files; the path of those.

    A file is streamed by one task that holds one record at a time. What follows is split like any
    other file of lines.
    """

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch["file"]:
                with open_uri(file) as stream:
                    text = TextIOWrapper(stream, "utf-8", newline="")
                    records = array_records(iter(lambda: text.read(1 << 20), ""))  # noqa: B023
                    lines = (r.replace("\n", " ").replace("\r", " ") for r in records)
                    while held := list(islice(lines, 4096)):
                        yield pd.DataFrame({"value": held})

    names = spark.createDataFrame([(f.file_path,) for f in files], "file string")
    path = scratch_path(spark, "records")
    names.repartition(len(files), "file").mapInPandas(split, "value string").write.text(path)
    return path


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    split_over: int = SPLIT_OVER,
) -> DataFrame:
    """All records of all files; a single object is one row with flattened names.

    Lines of records split across tasks. An array of more than ``split_over`` bytes is first split into
    such lines; a smaller one, and an object, is one JSON value of one task. A ``schema`` saves the
    pass that infers it.
    """
    files = resolve(spark, paths)
    kinds = find_kinds(spark, files)
    groups: dict[str, list[str]] = defaultdict(list)
    large: list[SourceFile] = []
    for file in files:
        kind = kinds[file.path]
        if kind == ARRAY and file.length > split_over and within_reach(file.file_path):
            large.append(file)
        else:
            groups[kind].append(file.path)
    reads = [(kind, groups[kind]) for kind in (ARRAY, OBJECT, LINES) if kind in groups]
    if large:
        reads.insert(0, (LINES, [split_arrays(spark, large)]))
    parts = []
    for kind, group in reads:
        reader = spark.read.option("multiLine", kind != LINES).option("mode", "FAILFAST")
        if schema is not None:
            reader = reader.schema(schema)
        part = reader.json(group)
        parts.append(flatten_structs(part) if kind == OBJECT else part)
    return union_all_by_name(parts)
