"""ZIP archives: every member is a task that unpacks it line by line, and Spark parses the lines.

A data source reads the directories of the archives, which say where each member begins, and plans
one partition per supported member, the largest first; members of one archive are read side by side and
no archive is ever a single value. A member is streamed: lines of delimited text, the records of
a JSON array one after another, the batches of a Parquet file. Only a JSON object is held whole.
Stores that only Spark can read give their archives as binary values instead, of 2 GB at most, one
task each.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kinfold.operators.mapping import union_all_by_name
from kinfold.session import materialize, scratch_path
from kinfold.sources.delimited import ENCODINGS, HEAD_LINES, Layout, find_layout, parse_lines
from kinfold.sources.files import TYPE_BY_SUFFIX, TYPE_PRIORITY, open_uri, resolve, within_reach
from kinfold.sources.json_records import ARRAY, OBJECT, array_records, json_kind

MEMBER_LINES = (
    "archive string, member string, file_type string, layout string, line_no bigint, text string"
)
BATCH_LINES = 10_000
BATCH_CHARS = 8 << 20
_MARK = -1  # line number of the row that stands for the member itself


def member_type(name: str) -> str | None:
    """Type of a member that is to be read; None for what is skipped.

    Skipped are folders, paths that climb up, hidden and system names, nested archives and
    unsupported types.
    """
    parts = name.split("/")
    base = parts[-1]
    if not base or ".." in parts or base.startswith((".", "__")):
        return None
    dot = base.rfind(".")
    kind = TYPE_BY_SUFFIX.get(base[dot:].lower()) if dot > 0 else None
    return kind if kind in TYPE_PRIORITY else None


def _raw_lines(archive: zipfile.ZipFile, name: str) -> Iterator[bytes]:
    with archive.open(name) as stream:
        for line in stream:
            yield line.rstrip(b"\r\n")


def _is_utf8(lines: Iterator[bytes]) -> bool:
    try:
        for line in lines:
            line.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def _csv_rows(archive: zipfile.ZipFile, name: str) -> tuple[str, Iterator[str]]:
    code = ENCODINGS[0] if _is_utf8(_raw_lines(archive, name)) else ENCODINGS[1]
    head = [x.decode(code) for x in islice(_raw_lines(archive, name), HEAD_LINES)]
    layout = find_layout(head, code)
    lines = islice(_raw_lines(archive, name), layout.header_line + 1, None)
    return json.dumps(layout), (t for t in (x.decode(code) for x in lines) if t.strip(" "))


def _flat(value: dict[str, Any], path: str = "") -> dict[str, Any]:
    out: dict[str, Any] = {}
    for k, v in value.items():
        out.update(_flat(v, f"{path}{k}.") if isinstance(v, dict) else {f"{path}{k}": v})
    return out


def _json_rows(archive: zipfile.ZipFile, name: str) -> tuple[str, Iterator[str]]:
    kind = _json_member_kind(archive, name)
    if kind == OBJECT:
        return "", iter([json.dumps(_flat(json.loads(archive.read(name))))])
    if kind == ARRAY:
        records = array_records(_text_parts(archive, name))
        return "", (r.replace("\n", " ").replace("\r", " ") for r in records)  # line breaks are never in strings
    return "", (x.decode("utf-8") for x in _raw_lines(archive, name) if x.strip())


def _json_member_kind(archive: zipfile.ZipFile, name: str) -> str:
    """An array is known by its first character, so that its first line need not be read."""
    for part in _text_parts(archive, name):
        if start := part.lstrip("\ufeff \t\r\n"):
            if start[0] == "[":
                return ARRAY
            break
    lines = (x.decode("utf-8") for x in _raw_lines(archive, name) if x.strip())
    head = list(islice(lines, 2))
    return json_kind(head[0] if head else "", len(head) > 1)


def _text_parts(archive: zipfile.ZipFile, name: str) -> Iterator[str]:
    with archive.open(name) as stream:
        text = io.TextIOWrapper(stream, "utf-8", newline="")
        while part := text.read(1 << 20):
            yield part


def _parquet_rows(archive: zipfile.ZipFile, name: str) -> tuple[str, Iterator[str]]:
    """Read through the member's stream: going back to the first row group unpacks it again."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    file = pq.ParquetFile(pa.PythonFile(archive.open(name), mode="r"), pre_buffer=False)
    rows = (
        json.dumps(row, default=str)
        for batch in file.iter_batches(BATCH_LINES)
        for row in batch.to_pylist()
    )
    return from_arrow_schema(file.schema_arrow).json(), rows


_READERS = {"csv": _csv_rows, "json": _json_rows, "parquet": _parquet_rows}
_COLUMNS = [part.split()[0] for part in MEMBER_LINES.split(", ")]


def supported_members(archive: zipfile.ZipFile, path: str) -> list[tuple[str, str, int]]:
    """Name, type and packed size of the members to read; an error if there are none or some cannot
    be read."""
    kinds = [(i, member_type(i.filename)) for i in archive.infolist() if not i.is_dir()]
    members = [(i.filename, kind, i.compress_size) for i, kind in kinds if kind]
    if not members:
        raise ValueError(f"no supported file in archive {path}")
    for name, kind, _ in members:
        if kind not in _READERS:
            raise ValueError(f"{kind} member {name} of {path} cannot be read")
    return members


def _member_batches(
    archive: zipfile.ZipFile, path: str, name: str, kind: str
) -> Iterator[pd.DataFrame]:
    """The mark of a member, then its lines with their numbers."""
    layout, rows = _READERS[kind](archive, name)
    held: list[tuple] = [(path, name, kind, layout, _MARK, None)]
    chars = 0
    for i, text in enumerate(rows):
        held.append((path, name, kind, layout, i, text))
        chars += len(text)
        if len(held) >= BATCH_LINES or chars >= BATCH_CHARS:
            yield pd.DataFrame(held, columns=_COLUMNS)
            held, chars = [], 0
    if held:
        yield pd.DataFrame(held, columns=_COLUMNS)


def _unpack(path: str, content: bytes) -> Iterator[pd.DataFrame]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for name, kind, _ in supported_members(archive, path):
            yield from _member_batches(archive, path, name, kind)


class Member(InputPartition):
    def __init__(self, uri: str, path: str, name: str, kind: str) -> None:
        self.uri, self.path, self.name, self.kind = uri, path, name, kind


class MemberReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, str]]) -> None:
        self._files = files

    def partitions(self) -> Sequence[InputPartition]:
        """A partition per member; only the directories at the ends of the archives are read."""

        def members(file: tuple[str, str]) -> list[tuple[int, Member]]:
            uri, path = file
            with open_uri(uri) as raw, zipfile.ZipFile(raw) as archive:
                found = supported_members(archive, path)
            return [(size, Member(uri, path, name, kind)) for name, kind, size in found]

        with ThreadPoolExecutor(max_workers=16) as pool:
            found = [m for own in pool.map(members, self._files) for m in own]
        return [m for _, m in sorted(found, key=lambda x: (-x[0], x[1].path, x[1].name))]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(c, pa.int64() if c == "line_no" else pa.string()) for c in _COLUMNS]
        )
        with open_uri(partition.uri) as raw, zipfile.ZipFile(raw) as archive:
            for rows in _member_batches(archive, partition.path, partition.name, partition.kind):
                yield pa.RecordBatch.from_pandas(rows, schema, preserve_index=False)


class MemberSource(DataSource):
    """``spark.read.format("zip_members")``; option ``files`` has pairs of URI and shown path."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return MEMBER_LINES

    def reader(self, schema) -> MemberReader:  # noqa: ARG002
        return MemberReader([tuple(f) for f in json.loads(self.options["files"])])


def explode_archives(files: DataFrame) -> DataFrame:
    """Members of archives as numbered lines; ``files`` has ``path`` and ``content``."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                yield from _unpack(path, content)

    return files.select("path", "content").mapInPandas(unpack, MEMBER_LINES)


def parse_members(lines: DataFrame, position: bool = False) -> DataFrame:
    """Records of unpacked members, concatenated by column name.

    ``lines`` should be materialized, since it is scanned once per layout. With ``position`` each
    record keeps ``archive``, ``member`` and ``line_no``.
    """
    spark = lines.sparkSession
    extra = ["archive", "member", "line_no"] if position else []
    rows = lines.where(F.col("line_no") > _MARK)
    found = lines.select("file_type", "layout").distinct().collect()  # one row per layout
    parts = []
    for kind, layout in sorted(found, key=lambda r: (TYPE_PRIORITY[r[0]], r[1])):
        mine = rows.where((F.col("file_type") == kind) & (F.col("layout") == layout))
        if kind == "csv":
            delimiter, start, names, code = json.loads(layout)
            known = Layout(delimiter, start, tuple(names), code)
            part = mine.select(*extra, parse_lines(F.col("text"), known).alias("_fields"))
            part = part.where(F.col("_fields").isNotNull()).select(
                *extra, *[F.col("_fields")[i].alias(c) for i, c in enumerate(names)]
            )
        else:
            schema = (
                T.StructType.fromJson(json.loads(layout)) if layout else _infer(spark, mine)
            )
            part = mine.select(*extra, F.from_json("text", schema).alias("_record")).select(
                *extra, *[F.col(f"_record.`{f.name}`").alias(f.name) for f in schema.fields]
            )
        parts.append(part)
    return union_all_by_name(parts)


def _infer(spark: SparkSession, rows: DataFrame) -> T.StructType:
    path = scratch_path(spark, "members")
    rows.select("text").write.text(path)
    return spark.read.json(path).schema


def read_members(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The lines of all supported members of archives, see ``MEMBER_LINES``."""
    files = [(f.file_path, f.path) for f in resolve(spark, paths)]
    if not files:
        raise ValueError(f"no archive at {paths}")
    if within_reach(files[0][0]):
        spark.dataSource.register(MemberSource)
        return spark.read.format("zip_members").option("files", json.dumps(files)).load()
    return explode_archives(spark.read.format("binaryFile").load([path for _, path in files]))


def read_archives(
    spark: SparkSession, paths: str | Sequence[str], position: bool = False
) -> DataFrame:
    """All supported members of all archives as one table."""
    return parse_members(materialize(read_members(spark, paths), "members"), position)
