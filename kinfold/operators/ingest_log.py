"""Ingestion state as an append-only table of attempt events.

A file's state and an attempt's record are folds over its events, so writers only ever append. A snapshot
of the events that decide the states spares readers what was appended before it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.session import create_once, materialize

STARTED, COMPLETED, FAILED = "in_progress", "completed", "failed"
EVENT = (
    "filename string, attempt_id string, source string, status string, event_ts timestamp, "
    "seq bigint, size_bytes bigint, checksum string, error string"
)


def _event(
    status: str,
    at: datetime,
    seq: int,
    attempt_id: Column,
    source: Column,
    size_bytes: Column | None = None,
    checksum: Column | None = None,
    error: Column | None = None,
) -> list[Column]:
    none = F.lit(None)
    return [
        F.col("filename"),
        attempt_id.alias("attempt_id"),
        source.cast("string").alias("source"),
        F.lit(status).alias("status"),
        F.lit(at).cast("timestamp").alias("event_ts"),
        F.lit(seq).cast("bigint").alias("seq"),
        (none if size_bytes is None else size_bytes).cast("bigint").alias("size_bytes"),
        (none if checksum is None else checksum).cast("string").alias("checksum"),
        (none if error is None else error).cast("string").alias("error"),
    ]


def start_attempts(files: DataFrame, source: str, at: datetime) -> DataFrame:
    """A started event for every ``filename``, under a new attempt id.

    The ids are random, so the events are written once here and can be used again.
    """
    stamp = at.isoformat()
    attempt = F.concat_ws("_", "filename", F.lit(stamp), F.replace(F.uuid(), F.lit("-"), F.lit("")))
    return materialize(files.select(*_event(STARTED, at, 0, attempt, F.lit(source))), "attempts")


def complete_attempts(started: DataFrame, files: DataFrame, at: datetime) -> DataFrame:
    """Completed events; ``files`` has ``filename``, ``size_bytes`` and ``checksum``."""
    done = started.select("filename", "attempt_id", "source").join(
        files.select("filename", "size_bytes", "checksum"), "filename"
    )
    return done.select(
        *_event(
            COMPLETED,
            at,
            1,
            F.col("attempt_id"),
            F.col("source"),
            size_bytes=F.col("size_bytes"),
            checksum=F.col("checksum"),
        )
    )


def fail_attempts(started: DataFrame, files: DataFrame, at: datetime) -> DataFrame:
    """Failed events; ``files`` has ``filename`` and ``error``."""
    lost = started.select("filename", "attempt_id", "source").join(
        files.select("filename", "error"), "filename"
    )
    return lost.select(
        *_event(FAILED, at, 1, F.col("attempt_id"), F.col("source"), error=F.col("error"))
    )


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT).parquet(path)


_WHEN = ("event_ts", "seq")
_SNAPSHOTS = "_snapshots"  # below the events, hidden from readers of all events


def deciding_events(events: DataFrame) -> DataFrame:
    """The events that decide the state of their files: of each the latest, and the latest that is no
    failure. ``latest_state`` gives the same for them, whatever later events are added."""
    time = F.struct(*_WHEN)
    row = F.struct(*[F.col(c) for c in events.columns])
    good = F.col("status") != FAILED
    last = events.groupBy("filename").agg(
        F.max_by(row, time).alias("_last"), F.max_by(F.when(good, row), F.when(good, time)).alias("_good")
    )
    same = F.col("_last").eqNullSafe(F.col("_good")) | F.col("_good").isNull()
    both = F.when(same, F.array("_last")).otherwise(F.array("_last", "_good"))
    return last.select(F.explode(both).alias("x")).select("x.*")


def _children(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def _event_files(spark: SparkSession, path: str) -> list[str]:
    return [n for n in _children(spark, path) if not n.startswith(("_", "."))]


def _newest_snapshot(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest snapshot that was finished."""
    root = f"{path.rstrip('/')}/{_SNAPSHOTS}"
    done = [n for n in _children(spark, root) if "_SUCCESS" in _children(spark, f"{root}/{n}/covered")]
    return f"{root}/{max(done, key=int)}" if done else None


def _current(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Deciding events of the newest snapshot with all events after it, and the names of all files."""
    names, snapshot = _event_files(spark, path), _newest_snapshot(spark, path)
    reader = spark.read.schema(EVENT)
    if snapshot is None:
        return reader.parquet(path), names
    covered = {r["name"] for r in spark.read.schema("name string").parquet(f"{snapshot}/covered").collect()}
    tail = [f"{path.rstrip('/')}/{n}" for n in names if n not in covered]
    return reader.parquet(f"{snapshot}/events", *tail), names


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """Events that give the same state as all of them: the newest snapshot's and those after it.

    What a snapshot covers is not read. For the history of attempts take ``read_events``.
    """
    return _current(spark, path)[0]


def compact_events(spark: SparkSession, path: str) -> None:
    """Write a snapshot of the deciding events of everything appended so far.

    It holds at most two events per file. The list of the event files it covers is written last and
    makes it valid; events that are appended meanwhile are in none of them. Old events stay.
    """
    events, names = _current(spark, path)
    root = f"{path.rstrip('/')}/{_SNAPSHOTS}"
    number = max((int(n) for n in _children(spark, root) if n.isdigit()), default=0) + 1
    while not create_once(spark, f"{root}/{number}/_claim"):
        number += 1
    deciding_events(events).write.mode("overwrite").parquet(f"{root}/{number}/events")
    covered = spark.createDataFrame([(n,) for n in names], "name string")
    covered.write.mode("overwrite").parquet(f"{root}/{number}/covered")


def latest_state(events: DataFrame) -> DataFrame:
    """Per file: status, latest attempt, and size and checksum if that attempt completed.

    A failure changes the status only. ``max_by`` pre-aggregates in the map tasks, so a file with
    very many events is no hot spot.
    """
    time = F.struct(*_WHEN)
    kept = F.when(
        F.col("status") != FAILED,
        F.struct("attempt_id", "size_bytes", "checksum"),
    )
    kept_time = F.when(F.col("status") != FAILED, time)
    return (
        events.groupBy("filename")
        .agg(F.max_by("status", time).alias("status"), F.max_by(kept, kept_time).alias("_kept"))
        .select(
            "filename",
            "status",
            F.col("_kept.attempt_id").alias("latest_attempt"),
            F.col("_kept.size_bytes").alias("size_bytes"),
            F.col("_kept.checksum").alias("checksum"),
        )
    )


def attempts(events: DataFrame, filename: str | None = None) -> DataFrame:
    """One row per attempt with its latest status, times, size, checksum and error."""
    if filename is not None:
        events = events.where(F.col("filename") == filename)
    time = F.struct(*_WHEN)

    def at(status: str) -> Column:
        return F.max(F.when(F.col("status") == status, F.col("event_ts")))

    return events.groupBy("attempt_id").agg(
        F.max_by("filename", time).alias("filename"),
        F.max_by("source", time).alias("source"),
        F.max_by("status", time).alias("status"),
        at(STARTED).alias("started_at"),
        at(COMPLETED).alias("completed_at"),
        at(FAILED).alias("failed_at"),
        F.max("size_bytes").alias("size_bytes"),
        F.max("checksum").alias("checksum"),
        F.max("error").alias("error"),
    )


def pending_files(
    wanted: DataFrame,
    events: DataFrame,
    audited: DataFrame | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """The ``filename`` rows of ``wanted`` still to ingest.

    A file is done if its state is completed and, where an audit (``name``, ``ok``) is given, it
    is there and valid. ``overwrite`` takes all.
    """
    if overwrite:
        return wanted
    done = latest_state(events).where(F.col("status") == COMPLETED).select("filename")
    if audited is not None:
        valid = audited.where("ok").select(F.col("name").alias("filename"))
        done = done.join(valid, "filename", "left_semi")
    return wanted.join(done, "filename", "left_anti")
