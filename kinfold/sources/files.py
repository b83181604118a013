"""Files as tables: listing, type by suffix, audit."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from typing import IO, NamedTuple

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CHUNK_BYTES = 8 << 20  # of a file that is hashed
PART_BYTES = 128 << 20  # of small files that one task hashes

# File types by suffix.
TYPE_BY_SUFFIX = {
    ".zip": "zip",
    ".csv": "csv",
    ".txt": "csv",
    ".tsv": "csv",
    ".json": "json",
    ".xlsx": "excel",
    ".xls": "excel",
    ".parquet": "parquet",
}
# Reading order of the types when files are concatenated.
TYPE_PRIORITY = {"csv": 1, "json": 2, "excel": 3, "parquet": 4}


class SourceFile(NamedTuple):
    path: str  # as a reader takes it
    file_path: str  # as ``_metadata.file_path`` shows it
    length: int = 0


def list_files(
    spark: SparkSession, paths: str | Sequence[str], patterns: Sequence[str] | None = None
) -> DataFrame:
    """``path``, ``length`` and ``modificationTime`` of all files; contents are not read."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format("binaryFile")
    if patterns:
        reader = reader.option("pathGlobFilter", "{" + ",".join(patterns) + "}")
    return reader.load(roots).select("path", "length", "modificationTime")


def files_exist(
    spark: SparkSession,
    paths: str | Sequence[str],
    patterns: Sequence[str] | None = None,
    min_files: int = 1,
) -> bool:
    """Whether at least ``min_files`` files with content are there; a missing path has none."""
    try:
        return list_files(spark, paths, patterns).limit(min_files).count() >= min_files
    except AnalysisException:
        return False


def resolve(spark: SparkSession, paths: str | Sequence[str]) -> list[SourceFile]:
    """The files below ``paths``; the driver lists them to plan any scan anyway."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    found = spark.read.format("binaryFile").load(roots).select("path", "_metadata.file_path", "length")
    return sorted(SourceFile(*r) for r in found.collect())


def open_uri(uri: str) -> IO[bytes]:
    """A file as a seekable stream, for tasks that need a part of it."""
    fs, path = pa.fs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


def within_reach(uri: str) -> bool:
    """Whether tasks can open the file themselves; some stores only Spark can read."""
    try:
        open_uri(uri).close()
    except (pa.ArrowException, OSError):
        return False
    return True


def suffix_of(path: Column) -> Column:
    """Lower-cased suffix with its dot; empty if there is none."""
    return F.lower(F.regexp_extract(path, r"[^/]([.][^./]+)$", 1))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)[.][^.]*$", "")


def file_type(path: Column, unsupported: str = "error") -> Column:
    """csv, json, excel, parquet or zip; anything else is an error, or null on request."""
    suffix = suffix_of(path)
    kind = None
    for end, name in TYPE_BY_SUFFIX.items():
        kind = F.when(suffix == end, name) if kind is None else kind.when(suffix == end, name)
    if unsupported == "error":
        return kind.otherwise(
            F.raise_error(F.concat(F.lit("unsupported file type: "), path)).cast("string")
        )
    return kind


def classify_files(files: DataFrame, path: str = "path", unsupported: str = "error") -> DataFrame:
    return files.withColumn("file_type", file_type(F.col(path), unsupported))


def type_priority(kind: Column) -> Column:
    """Sort key of a file type: csv, json, excel, parquet, then the rest."""
    order = None
    for name, rank in TYPE_PRIORITY.items():
        order = F.when(kind == name, rank) if order is None else order.when(kind == name, rank)
    return order.otherwise(99)


def sort_by_priority(files: DataFrame, path: str = "path") -> DataFrame:
    """Classified files in reading order."""
    return files.orderBy(type_priority(F.col("file_type")), path)


def audit_files(
    files: DataFrame, expected: DataFrame | None = None, min_size: int = 1
) -> DataFrame:
    """``name``, ``size``, ``sha256``, ``ok`` and ``reason`` per file.

    ``files`` has ``path`` and ``length``, and ``sha256`` (see ``file_digests``) or ``content`` if
    checksums are wanted; ``expected`` has ``name`` and ``sha256`` (any case; null accepts any content).
    Expected files that are not there are reported as missing.
    """
    digest = F.lit(None).cast("string")
    if "sha256" in files.columns:
        digest = F.col("sha256")
    elif "content" in files.columns:
        digest = F.sha2("content", 256)
    found = files.select(
        file_name(F.col("path")).alias("name"), F.col("length").alias("size"), digest.alias("sha256")
    )
    if expected is None:
        wanted = F.lit(None).cast("string")
    else:
        expected = expected.select("name", F.lower("sha256").alias("_wanted"))
        found = found.join(expected, "name", "full_outer")
        wanted = F.col("_wanted")
    reason = (
        F.when(F.col("size").isNull(), "missing")
        .when(F.col("size") < min_size, "too small")
        .when(F.col("sha256") != wanted, "checksum differs")
    )
    return found.select("name", "size", "sha256", reason.isNull().alias("ok"), reason.alias("reason"))


def empty_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path`` and ``length`` of files without content, which Spark's file scans leave out."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    conf = spark._jsc.hadoopConfiguration()
    found = []
    for root in roots:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = pattern.getFileSystem(conf)
        for status in fs.globStatus(pattern) or []:
            inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [
                (file.getPath().toString(), 0)
                for file in inside
                if file.isFile() and not file.getLen() and file.getPath().getName()[0] not in "._"
            ]
    return spark.createDataFrame(found, "path string, length bigint")


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, str, int]]) -> None:
        self.files = files


class DigestReader(DataSourceReader):
    """Files in parts of about ``PART_BYTES``; a larger file is a part of its own."""

    def __init__(self, files: list[tuple[str, str, int]], chunk: int) -> None:
        self._files, self._chunk = files, chunk

    def partitions(self) -> Sequence[InputPartition]:
        parts: list[list[tuple[str, str, int]]] = []
        held = PART_BYTES
        for file in sorted(self._files, key=lambda f: (-f[2], f[0])):
            if held + file[2] > PART_BYTES:
                parts.append([])
                held = 0
            parts[-1].append(file)
            held += max(file[2], 1)
        return [_Files(p) for p in parts] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple[str, int, str]]:
        for path, uri, length in partition.files:
            digest = hashlib.sha256()
            with open_uri(uri) as stream:
                while part := stream.read(self._chunk):
                    digest.update(part)
            yield path, length, digest.hexdigest()


class DigestSource(DataSource):
    """``spark.read.format("file_digests")``; options ``files`` (path, URI, length) and ``chunk``."""

    @classmethod
    def name(cls) -> str:
        return "file_digests"

    def schema(self) -> str:
        return "path string, length bigint, sha256 string"

    def reader(self, schema) -> DigestReader:  # noqa: ARG002
        files = [tuple(f) for f in json.loads(self.options["files"])]
        return DigestReader(files, int(self.options["chunk"]))


def file_digests(
    spark: SparkSession, paths: str | Sequence[str], chunk: int = CHUNK_BYTES
) -> DataFrame:
    """``path, length, sha256`` of files of any size: a task streams a file in chunks.

    Files that only Spark can open are hashed as binary values, which bounds those to 2 GB.
    """
    files = resolve(spark, paths)
    if files and not within_reach(files[0].file_path):
        content = spark.read.format("binaryFile").load([f.path for f in files])
        return content.select("path", "length", F.sha2("content", 256).alias("sha256"))
    spark.dataSource.register(DigestSource)
    reader = spark.read.format("file_digests").option("files", json.dumps(files))
    return reader.option("chunk", str(chunk)).load()


def audit_paths(
    spark: SparkSession,
    paths: str | Sequence[str],
    expected: DataFrame | None = None,
    min_size: int = 1,
) -> DataFrame:
    """:func:`audit_files` over a path or glob; content is read only to compare checksums."""
    if expected is None:
        none = empty_files(spark, paths)
        return audit_files(list_files(spark, paths).select("path", "length").unionByName(none), None, min_size)
    nothing = F.sha2(F.lit(b""), 256).alias("sha256")
    files = file_digests(spark, paths).unionByName(empty_files(spark, paths).select("*", nothing))
    return audit_files(files, expected, min_size)
