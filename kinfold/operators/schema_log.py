"""Schema snapshots as rows: one row per column of a dataset version."""

from __future__ import annotations

from datetime import datetime
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.session import create_once, materialize, remove_file

SNAPSHOT = (
    "dataset string, version bigint, ordinal int, column string, dtype string, column_count int, "
    "row_count bigint, generated_at timestamp, filename string, source string, "
    "file_size_bytes bigint, file_hash string"
)


def extract_schema(
    df: DataFrame,
    dataset: str,
    version: int,
    generated_at: datetime,
    filename: str | None = None,
    source: str | None = None,
    file_size_bytes: int | None = None,
    file_hash: str | None = None,
) -> DataFrame:
    """Snapshot of ``df``: its columns in order with types and counts. Only rows are counted.

    Size and hash of the file behind it come from the file audit.
    """
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return (
        df.agg(F.count("*").alias("row_count"))
        .select("row_count", F.explode(columns).alias("c"))
        .select(
            F.lit(dataset).alias("dataset"),
            F.lit(version).cast("bigint").alias("version"),
            "c.ordinal",
            "c.column",
            "c.dtype",
            F.lit(len(df.columns)).alias("column_count"),
            "row_count",
            F.lit(generated_at).cast("timestamp").alias("generated_at"),
            F.lit(filename).cast("string").alias("filename"),
            F.lit(source).cast("string").alias("source"),
            F.lit(file_size_bytes).cast("bigint").alias("file_size_bytes"),
            F.lit(file_hash).cast("string").alias("file_hash"),
        )
    )


class VersionTaken(ValueError):
    """Another snapshot is registered under this dataset and version."""


def register(snapshot: DataFrame, path: str) -> None:
    """Add a snapshot to the history, or raise ``VersionTaken``.

    The version is claimed first, by creating a file that must not exist. Of several writers one
    succeeds, and the history never shows two snapshots of a version. A claim whose writer then
    fails is given back; if it cannot be, its version stays unused.
    """
    spark = snapshot.sparkSession
    rows = materialize(snapshot, "snapshot")
    claimed: list[str] = []
    try:
        for r in rows.select("dataset", "version").distinct().collect():  # one, as a rule
            name = quote(r["dataset"], safe="")
            claim = f"{path.rstrip('/')}/_versions/{name}/{r['version']}"
            if not create_once(spark, claim):
                raise VersionTaken(f"version {r['version']} of {r['dataset']} is registered already")
            claimed.append(claim)
        rows.write.mode("append").parquet(path)
    except Exception:
        for claim in claimed:
            remove_file(spark, claim)
        raise


def register_next(
    df: DataFrame, path: str, dataset: str, generated_at: datetime, **about: str | int | None
) -> int:
    """Register a snapshot of ``df`` under the next free version, which is returned."""
    spark = df.sparkSession
    snapshot = materialize(extract_schema(df, dataset, 0, generated_at, **about), "snapshot")
    version = 1
    try:
        past = history(spark, path).where(F.col("dataset") == dataset)
        version = (past.agg(F.max("version")).first()[0] or 0) + 1
    except AnalysisException:  # no history yet
        pass
    while True:
        try:
            register(snapshot.withColumn("version", F.lit(version).cast("bigint")), path)
        except VersionTaken:  # by another writer in the meantime
            version += 1
        else:
            return version


def history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT).parquet(path)


def is_empty(snapshots: DataFrame) -> bool:
    return snapshots.isEmpty()


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The rows of the newest version of every dataset."""
    newest = snapshots.groupBy("dataset").agg(F.max("version").alias("version"))
    return snapshots.join(newest, ["dataset", "version"], "left_semi")


def latest_schema(snapshots: DataFrame, dataset: str) -> DataFrame:
    """The newest version of one dataset; an error if it has none."""
    mine = snapshots.where(F.col("dataset") == dataset)
    if is_empty(mine):
        raise ValueError(f"no schema registered for {dataset}")
    return latest_snapshots(mine)


def diff_schemas(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns that differ: ``column``, ``change_type``, ``old_dtype``, ``new_dtype``.

    Sorted by column; no rows means no changes.
    """
    before = old.select("column", F.col("dtype").alias("old_dtype"), F.lit(True).alias("_old"))
    after = new.select("column", F.col("dtype").alias("new_dtype"), F.lit(True).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(~F.col("old_dtype").eqNullSafe(F.col("new_dtype")), "dtype changed")
    )
    return (
        before.join(after, "column", "full_outer")
        .select("column", change.alias("change_type"), "old_dtype", "new_dtype")
        .where(F.col("change_type").isNotNull())
        .orderBy("column")
    )


def has_changes(diff: DataFrame) -> bool:
    return not diff.isEmpty()
