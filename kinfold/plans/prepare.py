"""Preparation of voter files: select, clean, number, write; each dataset once."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kinfold.operators.cleaning import VOTER_RULES, cleaning_columns
from kinfold.operators.identity import add_file_ids, add_sequential_ids
from kinfold.operators.mapping import LINKAGE_COLUMNS, select_columns
from kinfold.sources.delimited import POSITION, Layout, read_delimited
from kinfold.sources.files import SourceFile, files_exist, resolve


def prepare(raw: DataFrame, dataset: str, order: Sequence[str]) -> DataFrame:
    """Matching-ready rows: ``unique_id``, ``dataset`` and the eight cleaned linkage columns.

    Rows in the order of their files (``order`` is ``POSITION``) are numbered without a sort.
    """
    kept = [dataset, *order]
    rows = select_columns(raw, [*LINKAGE_COLUMNS, *kept])
    cleaned = rows.select(*cleaning_columns(rows, VOTER_RULES, LINKAGE_COLUMNS), *kept)
    number = add_file_ids if tuple(order) == POSITION else add_sequential_ids
    return number(cleaned, dataset, order).select("unique_id", dataset, *LINKAGE_COLUMNS)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _prepared(spark: SparkSession, out_dir: str) -> DataFrame:
    """What is there; dataset names such as ``001`` are not read as numbers."""
    found = spark.read.parquet(out_dir).schema
    name = T.StructField("dataset", T.StringType())
    schema = T.StructType([name if f.name == "dataset" else f for f in found])
    return spark.read.schema(schema).parquet(out_dir)


def prepare_files(
    spark: SparkSession,
    raw: str | Sequence[str],
    out_dir: str,
    layout: Layout | None = None,
    multi_line: bool = False,
) -> DataFrame | None:
    """Prepare the raw files whose dataset is not in ``out_dir`` yet; return all that is there.

    Files already prepared are not read again. Every dataset is one partition folder, so a later
    run sees what is done. Returns None if there is nothing at all.
    """
    done: set[str] = set()
    if _exists(spark, out_dir):  # one name per file that was prepared
        done = {r.dataset for r in _prepared(spark, out_dir).select("dataset").distinct().collect()}
    todo: list[SourceFile] = [
        f
        for f in (resolve(spark, raw) if files_exist(spark, raw) else [])
        if PurePosixPath(f.path).stem not in done
    ]
    if todo:
        table = read_delimited(
            spark, [f.path for f in todo], layout=layout, position=True, multi_line=multi_line
        )
        prepare(table, "dataset", POSITION).write.mode("append").partitionBy("dataset").parquet(
            out_dir
        )
    elif not done:
        return None
    return _prepared(spark, out_dir)
