from datetime import datetime, timedelta

import pytest

from kinfold.operators import ingest_log as log
from kinfold.operators import schema_log
from kinfold.plans.ingest import ingest_files

T0 = datetime(2024, 1, 1)


def at(n):
    return T0 + timedelta(minutes=n)


def test_snapshot_history_and_diff(spark, frame, tmp_path):
    path = str(tmp_path / "schemas")
    old = schema_log.extract_schema(frame([(1, "a")] * 3, "x int, y string"), "d", 1, at(0), "f.csv", "s")
    first = old.orderBy("ordinal").first()
    assert (first["column"], first["dtype"], first["column_count"], first["row_count"]) == (
        "x", "int", 2, 3)
    schema_log.register(old, path)
    new = schema_log.extract_schema(frame([(1.0, 2)], "x double, z int"), "d", 2, at(1))
    schema_log.register(new, path)
    past = schema_log.history(spark, path)
    assert past.select("version").distinct().count() == 2
    latest = schema_log.latest_schema(past, "d")
    assert {r["column"] for r in latest.collect()} == {"x", "z"}
    with pytest.raises(ValueError):
        schema_log.latest_schema(past, "other")
    diff = schema_log.diff_schemas(past.where("version = 1"), latest)
    assert [tuple(r) for r in diff.collect()] == [
        ("x", "dtype changed", "int", "double"), ("y", "removed", "string", None),
        ("z", "added", None, "int")]
    assert schema_log.has_changes(diff)
    assert not schema_log.has_changes(schema_log.diff_schemas(latest, latest))


def test_attempts_and_state(spark, frame, tmp_path):
    path = str(tmp_path / "events")
    files = frame([("a.csv",), ("b.csv",)], "filename string")
    one = log.start_attempts(files, "src", at(0))
    assert one.select("attempt_id").distinct().count() == 2
    log.append_events(one, path)
    lost = frame([("a.csv", "boom")], "filename string, error string")
    log.append_events(log.fail_attempts(one, lost, at(1)), path)
    state = {r["filename"]: r["status"] for r in log.latest_state(log.read_events(spark, path)).collect()}
    assert state == {"a.csv": "failed", "b.csv": "in_progress"}
    two = log.start_attempts(files.where("filename = 'a.csv'"), "src", at(2))
    done = frame([("a.csv", 200, "abc")], "filename string, size_bytes bigint, checksum string")
    log.append_events(two.unionByName(log.complete_attempts(two, done, at(2))), path)
    events = log.read_events(spark, path)
    state = log.latest_state(events).where("filename = 'a.csv'").first()
    assert (state["status"], state["size_bytes"], state["checksum"]) == ("completed", 200, "abc")
    assert state["latest_attempt"] == two.first()["attempt_id"]
    tried = log.attempts(events, "a.csv").orderBy("started_at").collect()
    assert [(r["status"], r["error"], r["size_bytes"]) for r in tried] == [
        ("failed", "boom", None), ("completed", None, 200)]
    # a late failure changes the status but not what the last good attempt left
    late = log.fail_attempts(one.where("filename = 'a.csv'"), lost, at(3))
    state = log.latest_state(events.unionByName(late)).where("filename = 'a.csv'").first()
    assert (state["status"], state["size_bytes"]) == ("failed", 200)
    assert state["latest_attempt"] == two.first()["attempt_id"]


def test_pending(frame):
    wanted = frame([("a",), ("b",), ("c",)], "filename string")
    started = log.start_attempts(wanted.where("filename <> 'c'"), "s", at(0))
    done = frame([("a", 1, None), ("b", 1, None)], "filename string, size_bytes bigint, checksum string")
    events = started.unionByName(log.complete_attempts(started, done, at(1)))
    names = lambda df: sorted(r["filename"] for r in df.collect())
    assert names(log.pending_files(wanted, events)) == ["c"]
    audited = frame([("a", True), ("b", False)], "name string, ok boolean")
    assert names(log.pending_files(wanted, events, audited)) == ["b", "c"]
    assert names(log.pending_files(wanted, events, audited, overwrite=True)) == ["a", "b", "c"]


def test_ingest_flow(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    args = dict(events_path=str(tmp_path / "ev"), schemas_path=str(tmp_path / "sc"), dataset="d")
    (land / "a.csv").write_text("x,y\n1,2\n")
    first = ingest_files(spark, str(land), version=1, at=at(0), **args)
    assert first.table.count() == 1 and first.changes is None
    again = ingest_files(spark, str(land), version=2, at=at(1), **args)
    assert again.table is None
    (land / "b.csv").write_text("x,z\n3,4\n")
    (land / "empty.csv").write_text("")
    second = ingest_files(spark, str(land), version=2, at=at(2), **args)
    assert [tuple(r) for r in second.table.collect()] == [("3", "4")]
    assert {(r["column"], r["change_type"]) for r in second.changes.collect()} == {
        ("y", "removed"), ("z", "added")}
    state = {r["filename"]: r["status"] for r in log.latest_state(log.read_events(spark, args["events_path"])).collect()}
    assert state == {"a.csv": "completed", "b.csv": "completed", "empty.csv": "failed"}
    redo = ingest_files(spark, str(land / "*.csv"), version=3, at=at(3), overwrite=True, **args)
    assert redo.table.count() == 2


def test_file_that_fails_to_load_is_retried(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.csv").write_text("only one column\n1\n")
    args = dict(
        source="s", dataset="d", events_path=str(tmp_path / "e"), schemas_path=str(tmp_path / "s")
    )
    with pytest.raises(Exception):  # noqa: B017
        ingest_files(spark, str(land), version=1, at=at(0), **args)
    states = {r.filename: r.status for r in log.latest_state(log.read_events(spark, args["events_path"])).collect()}
    assert states == {"a.csv": "failed"}
    (land / "a.csv").write_text("x,y\n1,2\n")
    assert ingest_files(spark, str(land), version=1, at=at(1), **args).table.count() == 1
