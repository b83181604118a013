"""One way to load files of any supported type."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession

from kinfold.operators.mapping import union_all_by_name
from kinfold.sources.archives import read_archives
from kinfold.sources.delimited import read_delimited
from kinfold.sources.files import TYPE_BY_SUFFIX, TYPE_PRIORITY, resolve
from kinfold.sources.json_records import read_json


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet files; columns that some files lack are null there."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("mergeSchema", True).parquet(*roots)


def load_dataframe(
    spark: SparkSession,
    paths: str | Sequence[str],
    max_rows: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Load files of mixed types and concatenate them by column name.

    ``multi_line`` is for delimited files outside archives, see ``read_delimited``.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for file in resolve(spark, paths):
        suffix = PurePosixPath(file.path).suffix.lower()
        kind = TYPE_BY_SUFFIX.get(suffix)
        if kind is None or kind == "excel":
            raise ValueError(f"unsupported file type: {file.path}")
        groups[kind].append(file.path)
    parts = []
    for kind in sorted(groups, key=lambda k: TYPE_PRIORITY.get(k, 99)):
        files = groups[kind]
        if kind == "csv":
            parts.append(read_delimited(spark, files, max_rows=max_rows, multi_line=multi_line))
        elif kind == "json":
            parts.append(read_json(spark, files))
        elif kind == "parquet":
            parts.append(read_parquet(spark, files))
        else:
            parts.append(read_archives(spark, files))
    return union_all_by_name(parts)
