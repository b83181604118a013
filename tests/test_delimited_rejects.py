"""Lines that give no row, and how many jobs the looking takes."""

import re

import pytest

from kinfold.sources import delimited
from kinfold.sources.delimited import read_delimited, read_delimited_with_rejects

HEAD = "|".join("abcdefg")


def fill(folder, n=6):
    for k in range(n):
        lines = [f"{i}|" + "|".join("x" * 6) for i in range(50)]
        lines[3] += "|more"
        lines[7] = '7|"open'
        lines[9] = "short"
        lines.insert(20, "")
        (folder / f"p{k}.txt").write_text("\n".join(["note", HEAD, *lines]) + "\n")
        (folder / f"c{k}.csv").write_bytes("k,v\n1,\xe9\n2,b,c\n3\n".encode("latin-1"))


def test_rows_and_rejects_are_all_lines(spark, tmp_path):
    fill(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")  # lines of a file in several splits
    try:
        rows, rejects = read_delimited_with_rejects(spark, str(tmp_path), position=True)
        assert rows.where("dataset like 'p%'").count() == 6 * 48 and rows.where("dataset like 'c%'").count() == 12
        found = sorted((re.search(r"[^/]*$", r.file)[0], r.line, r.reason, r.text) for r in rejects.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [(f"c{k}.csv", 3, "too long", "2,b,c") for k in range(6)]
    for k in range(6):
        want.append((f"p{k}.txt", 6, "too long", "3|" + "|".join("x" * 6) + "|more"))
        want.append((f"p{k}.txt", 10, "open quote", '7|"open'))
    assert found == sorted(want)


def test_the_number_of_jobs_does_not_depend_on_the_files(spark, tmp_path):
    def jobs(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for k in range(n):
            (folder / f"{k}.csv").write_text(f"a,b\n{k},1\n")
        spark.sparkContext.setJobGroup(f"sniff {n}", "")
        read_delimited(spark, str(folder))
        found = spark.sparkContext.statusTracker().getJobIdsForGroup(f"sniff {n}")
        spark.sparkContext.setJobGroup("", "")
        return len(found)

    assert jobs(1) == jobs(30)


@pytest.mark.parametrize("reach", [True, False])
def test_layouts_are_the_same_whoever_opens_the_files(spark, tmp_path, monkeypatch, reach):
    fill(tmp_path, 3)
    (tmp_path / "one_line.csv").write_text("a,b")
    (tmp_path / "cr.csv").write_bytes(b"a,b\r1,2\r3,4\r")
    monkeypatch.setattr(delimited, "within_reach", lambda uri: reach)
    files = delimited.resolve(spark, str(tmp_path))
    got = {k: sorted(p.rsplit("/", 1)[1] for p in v) for k, v in delimited.find_layouts(spark, files).items()}
    assert got == {
        delimited.Layout("|", 1, tuple("abcdefg"), "UTF-8"): ["p0.txt", "p1.txt", "p2.txt"],
        delimited.Layout(",", 0, ("k", "v"), "ISO-8859-1"): ["c0.csv", "c1.csv", "c2.csv"],
        delimited.Layout(",", 0, ("a", "b"), "UTF-8"): ["cr.csv", "one_line.csv"],
    }
