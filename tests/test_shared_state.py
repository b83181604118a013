"""What several writers share: versions, snapshots of the state, checksums of large files."""

import hashlib
import threading
from datetime import datetime, timedelta

import pytest

from kinfold.operators import ingest_log as log
from kinfold.operators import schema_log
from kinfold.plans.ingest import ingest_files
from kinfold.sources.files import audit_paths, file_digests

T0 = datetime(2024, 1, 1)


def at(n):
    return T0 + timedelta(minutes=n)


def test_one_of_two_registrations_is_refused(spark, frame, tmp_path):
    path, results = str(tmp_path / "schemas"), []
    frames = [frame([(1,)], "x int"), frame([("a",)], "x string")]
    start = threading.Barrier(2)

    def attempt(df):
        snapshot = schema_log.extract_schema(df, "d", 1, T0)
        start.wait()
        try:
            schema_log.register(snapshot, path)
            results.append("done")
        except schema_log.VersionTaken:
            results.append("refused")

    writers = [threading.Thread(target=attempt, args=(df,)) for df in frames]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert sorted(results) == ["done", "refused"]
    assert schema_log.history(spark, path).count() == 1


def test_next_version_and_a_claim_given_back(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "schemas")
    versions = [schema_log.register_next(frame([(n,)], f"c{n} int"), path, "d/e", T0, source="s") for n in range(3)]
    assert versions == [1, 2, 3] and schema_log.register_next(frame([(1,)], "x int"), path, "f", T0) == 1
    assert schema_log.latest_schema(schema_log.history(spark, path), "d/e").first()["column"] == "c2"
    snapshot = schema_log.extract_schema(frame([(1,)], "x int"), "d/e", 4, T0)
    with pytest.raises(Exception):  # noqa: B017
        schema_log.register(snapshot.withColumnRenamed("dtype", "version2").withColumn("bad", snapshot["ordinal"]), "/proc/none")
    assert schema_log.create_once(spark, f"{path}/_versions/d%2Fe/4")


def test_state_from_snapshot_and_tail(spark, frame, tmp_path):
    path, every = str(tmp_path / "events"), None
    files = frame([(f"{i}.csv", i, f"h{i}", "boom") for i in range(40)], "filename string, size_bytes bigint, checksum string, error string")
    for n in range(6):
        some = files.where(f"size_bytes % 5 <> {n % 5}")
        started = log.start_attempts(some, "s", at(3 * n))
        done = log.complete_attempts(started, some.where(f"size_bytes % 3 = {n % 3}"), at(3 * n + 1))
        lost = log.fail_attempts(started, some.where(f"size_bytes % 3 <> {n % 3}"), at(3 * n + 2))
        events = started.unionByName(done).unionByName(lost)
        log.append_events(events, path)
        every = events if every is None else every.unionByName(events)
        if n in (1, 3):
            before = {f.rsplit("/", 1)[1] for f in log.read_events(spark, path).inputFiles()}
            log.compact_events(spark, path)
    state = lambda df: sorted(map(tuple, log.latest_state(df).collect()))
    current = log.read_current(spark, path)
    assert state(current) == state(every) == state(log.read_events(spark, path))
    read = {f.rsplit("/", 1)[1] for f in current.inputFiles()}
    assert before and not before & read  # what the snapshot covers is not read
    assert current.count() < every.count()
    assert log.attempts(log.read_events(spark, path)).count() == log.attempts(every).count()


def test_an_unfinished_snapshot_does_not_count(spark, frame, tmp_path):
    path = tmp_path / "events"
    files = frame([("a",), ("b",)], "filename string")
    log.append_events(log.start_attempts(files, "s", at(0)), str(path))
    (path / "_snapshots" / "1" / "events").mkdir(parents=True)
    assert log.read_current(spark, str(path)).count() == 2
    log.compact_events(spark, str(path))
    assert log.read_current(spark, str(path)).count() == 2


def test_large_files_are_hashed_in_chunks(spark, frame, tmp_path):
    data = {"a.bin": b"0123456789" * 1000, "b.bin": b"x", "c.bin": b"y" * 64}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    got = file_digests(spark, str(tmp_path), chunk=64)
    want = {(n, len(c), hashlib.sha256(c).hexdigest()) for n, c in data.items()}
    assert {(r.path.rsplit("/", 1)[1], r.length, r.sha256) for r in got.collect()} == want
    expected = frame([(n, hashlib.sha256(c).hexdigest()) for n, c in data.items()], "name string, sha256 string")
    assert all(r.ok for r in audit_paths(spark, str(tmp_path), expected).collect())


def test_ingest_tells_size_and_hash_of_the_file(spark, frame, tmp_path):
    (tmp_path / "land").mkdir()
    (tmp_path / "land" / "a.csv").write_text("x,y\n1,2\n")
    digest = hashlib.sha256(b"x,y\n1,2\n").hexdigest()
    expected = frame([("a.csv", digest)], "name string, sha256 string")
    done = ingest_files(
        spark, str(tmp_path / "land"), str(tmp_path / "e"), str(tmp_path / "s"), "d", 1, T0, expected=expected
    )
    r = done.snapshot.first()
    assert (r["filename"], r["file_size_bytes"], r["file_hash"]) == ("a.csv", 8, digest)
