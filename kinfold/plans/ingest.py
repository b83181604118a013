"""Taking in landed files: what is pending, load it, log the attempt, track the schema."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from kinfold.operators import ingest_log as log
from kinfold.operators import schema_log
from kinfold.sources.files import audit_paths, empty_files, file_name, list_files
from kinfold.sources.loader import load_dataframe


@dataclass(frozen=True)
class Ingested:
    table: DataFrame | None
    snapshot: DataFrame | None
    changes: DataFrame | None


def ingest_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    events_path: str,
    schemas_path: str,
    dataset: str,
    version: int,
    at: datetime,
    source: str = "landed",
    expected: DataFrame | None = None,
    min_size: int = 1,
    overwrite: bool = False,
    multi_line: bool = False,
) -> Ingested:
    """Load the files that were not ingested before and record attempts and schema.

    Files that fail the audit get a failed attempt and stay pending.
    """
    found = list_files(spark, paths).select("path").union(empty_files(spark, paths).select("path"))
    listed = found.select("path", file_name(F.col("path")).alias("filename"))
    audited = audit_paths(spark, paths, expected, min_size)
    events = _or_none(lambda: log.read_current(spark, events_path))
    pending = listed if events is None else log.pending_files(listed, events, audited, overwrite)
    started = log.start_attempts(pending, source, at)
    if started.isEmpty():
        return Ingested(None, None, None)
    checked = audited.withColumnRenamed("name", "filename")
    good = checked.where("ok").select(
        "filename", F.col("size").alias("size_bytes"), F.col("sha256").alias("checksum")
    )
    bad = checked.where("NOT ok").select("filename", F.col("reason").alias("error"))
    log.append_events(started.unionByName(log.fail_attempts(started, bad, at)), events_path)
    ready = pending.join(good, "filename").select("path", "filename", "size_bytes", "checksum")
    ready = ready.orderBy("filename").collect()  # a file list
    if not ready:
        return Ingested(None, None, None)
    try:
        table, snapshot, changes = _load(
            spark, ready, schemas_path, dataset, version, at, source, multi_line
        )
    except Exception as error:
        lost = good.select("filename", F.lit(f"{type(error).__name__}: {error}"[:500]).alias("error"))
        log.append_events(log.fail_attempts(started, lost, at), events_path)
        raise
    log.append_events(log.complete_attempts(started, good, at), events_path)
    return Ingested(table, snapshot, changes)


def _about(files: Sequence[Row]) -> dict[str, str | int | None]:
    """Name, size and hash of a snapshot's file; of several the sum and the hash of their hashes."""
    hashes = [f["checksum"] for f in files]
    if None in hashes:
        whole = None
    else:
        whole = hashes[0] if len(hashes) == 1 else hashlib.sha256("".join(hashes).encode()).hexdigest()
    return {
        "filename": files[0]["filename"] if len(files) == 1 else None,
        "file_size_bytes": sum(f["size_bytes"] for f in files),
        "file_hash": whole,
    }


def _load(spark, files, schemas_path, dataset, version, at, source, multi_line):
    """Read the files, register their schema and compare it with the one before."""
    table = load_dataframe(spark, [f["path"] for f in files], multi_line=multi_line)
    snapshot = schema_log.extract_schema(
        table, dataset, version, at, source=source, **_about(files)
    )
    past = _or_none(lambda: schema_log.history(spark, schemas_path))
    changes = None
    if past is not None:
        before = past.where((F.col("dataset") == dataset) & (F.col("version") < version))
        if not schema_log.is_empty(before):
            changes = schema_log.diff_schemas(schema_log.latest_snapshots(before), snapshot)
    schema_log.register(snapshot, schemas_path)
    return table, snapshot, changes


def _or_none(read):
    """A log that has not been written yet."""
    from pyspark.errors import AnalysisException

    try:
        return read()
    except AnalysisException:
        return None
