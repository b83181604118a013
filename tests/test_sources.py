import hashlib
import io
import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinfold.sources.api_pages import explode_api_records
from kinfold.sources.archives import explode_archives, member_type, read_archives, read_members
from kinfold.sources.delimited import Layout, find_layout, read_delimited
from kinfold.sources.files import audit_paths, classify_files, files_exist, list_files, sort_by_priority
from kinfold.sources import json_records
from kinfold.sources.json_records import array_records, json_kind, read_json
from kinfold.sources.loader import load_dataframe
from kinfold.sources.sinks import write_stage


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_classify_files(frame):
    files = frame([("a/B.CSV",), ("c.tsv",), ("x.txt",), ("d.json",), ("e.XLS",), ("f.zip",),
                   ("g.parquet",)], "path string")
    kinds = {r["path"]: r["file_type"] for r in classify_files(files).collect()}
    assert kinds == {"a/B.CSV": "csv", "c.tsv": "csv", "x.txt": "csv", "d.json": "json",
                     "e.XLS": "excel", "f.zip": "zip", "g.parquet": "parquet"}
    ordered = [r["file_type"] for r in sort_by_priority(classify_files(files)).collect()]
    assert ordered == ["csv", "csv", "csv", "json", "excel", "parquet", "zip"]


@pytest.mark.parametrize("path", ["a.exe", "noext", ".csv", "dir.csv/plain"])
def test_classify_unsupported(frame, path):
    files = frame([(path,)], "path string")
    assert classify_files(files, unsupported="null").first()["file_type"] is None
    with pytest.raises(Exception, match="unsupported file type"):
        classify_files(files).collect()


def test_find_layout():
    tabs = "\t".join("abcdefg")
    assert find_layout(["note", "second note, with comma", tabs]) == Layout(
        "\t", 2, tuple("abcdefg"), "UTF-8"
    )
    assert find_layout(["a|b,c", "1|2"]).delimiter == "|"
    assert find_layout(['"x,y",b', "1,2"]).columns == ("x,y", "b")
    assert find_layout(["a,a,"]).columns == ("a", "a.1", "Unnamed: 2")
    with pytest.raises(ValueError):
        find_layout(["single", "1"])
    with pytest.raises(ValueError):
        find_layout([])


def test_read_delimited_widths_quotes_and_blanks(spark, tmp_path):
    text = 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12,\n\n13,"x, ""y""",14\n15,,""\n16,17,18,19,20\n'
    (tmp_path / "d.csv").write_text(text)
    got = read_delimited(spark, str(tmp_path / "d.csv"))
    assert sorted(rows(got), key=lambda r: int(r[0])) == [
        ("1", "2", "3"), ("4", "5", None), ("13", 'x, "y"', "14"), ("15", None, None),
    ]
    assert got.count() == 4
    assert got.select("a").where("a > '4'").collect() == []


def test_read_delimited_preamble_latin1_and_order(spark, tmp_path):
    head = "\t".join(f"c{i}" for i in range(7))
    body = "\n".join("\t".join(f"{r}-{i}" for i in range(7)) for r in range(30))
    short = "s0\ts1"
    long = "\t".join("l" * 9)
    (tmp_path / "p.txt").write_bytes(
        f"a title\nand a note\n{head}\n{body}\n{short}\n{long}\n".encode()
    )
    (tmp_path / "l.txt").write_bytes("name\tcity\nJos\xe9\tX\nAnn\tY\n".encode("latin-1"))
    (tmp_path / "u.txt").write_bytes("name\tcity\nZoë\tZ\n".encode())
    got = read_delimited(spark, str(tmp_path), position=True)
    pre = got.where("dataset = 'p'").orderBy("_block", "_row").collect()
    assert [r["c0"] for r in pre] == [f"{r}-0" for r in range(30)] + ["s0"]
    assert pre[-1]["c2"] is None
    names = {r["name"] for r in got.where("dataset <> 'p'").collect()}
    assert names == {"José", "Ann", "Zoë"}


def test_read_delimited_row_cap_and_types(spark, tmp_path):
    for name in "ab":
        lines = "\n".join(f"{i},{i}.5,x{i},true" for i in range(20))
        (tmp_path / f"{name}.csv").write_text(f"n,f,s,t\n{lines}\n")
    assert read_delimited(spark, str(tmp_path)).count() == 40
    capped = read_delimited(spark, str(tmp_path), max_rows=5, position=True)
    assert rows(capped.groupBy("dataset").agg(F.max(F.col("n").cast("int")), F.count("*"))) == [
        ("a", 4, 5), ("b", 4, 5),
    ]
    typed = read_delimited(spark, str(tmp_path), infer=True)
    assert [t for _, t in typed.dtypes] == ["bigint", "double", "string", "boolean"]


def test_read_delimited_many_blocks(spark, tmp_path):
    lines = "\n".join("\t".join([str(i)] + ["v"] * 6) for i in range(5000))
    head = "\t".join(f"c{i}" for i in range(7))
    (tmp_path / "big.txt").write_text(f"note\n{head}\n{lines}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = read_delimited(spark, str(tmp_path), position=True)
        assert got.select("_block").distinct().count() > 1
        order = [int(r["c0"]) for r in got.orderBy("_block", "_row").collect()]
        assert order == list(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_read_delimited_nothing_fits(spark, tmp_path):
    (tmp_path / "one.csv").write_text("single\n1\n")
    with pytest.raises(ValueError, match="one.csv"):
        read_delimited(spark, str(tmp_path))


def test_json_kinds():
    assert json_kind("[", True) == "array"
    assert json_kind('{"a": 1}', False) == "object"
    assert json_kind('{"a": 1}', True) == "lines"
    assert json_kind("{", True) == "object"
    with pytest.raises(ValueError):
        json_kind("3", False)


def test_read_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2, "y": "b"}]')
    (tmp_path / "b.json").write_text('{"x": 3}\n{"x": 4, "y": "d"}\n')
    assert rows(read_json(spark, str(tmp_path))) == [(1, None), (2, "b"), (3, None), (4, "d")]
    (tmp_path / "o").mkdir()
    (tmp_path / "o" / "c.json").write_text('{\n "x": 5, "n": {"p": 1, "q": {"r": "s"}}, "l": [1, 2]}')
    one = read_json(spark, str(tmp_path / "o"))
    assert set(one.columns) == {"x", "n.p", "n.q.r", "l"}
    assert one.select("`n.q.r`", "l").first() == ("s", [1, 2])
    (tmp_path / "s.json").write_text("12")
    with pytest.raises(ValueError, match="s.json"):
        read_json(spark, str(tmp_path / "s.json"))


@pytest.mark.parametrize("reach", [True, False])
def test_json_kinds_of_files(spark, tmp_path, monkeypatch, reach):
    monkeypatch.setattr(json_records, "within_reach", lambda uri: reach)
    texts = {
        "a1": '[{"x": 1}]', "a2": "\ufeff\n \n[\n]", "o1": '{"x": 1}', "o2": '\n{\n"x": 1}\n', "o3": '{"x":\n1}',
        "l1": '{"x": 1}\n\n{"x": 2}', "l2": '\ufeff{"x": "' + "y" * 100_000 + '"}\n{"x": 2}\n',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    files = json_records.resolve(spark, str(tmp_path))
    kinds = json_records.find_kinds(spark, files)
    assert {p.rsplit("/", 1)[1][0]: k for p, k in kinds.items()} == {"a": "array", "o": "object", "l": "lines"}
    assert len(kinds) == len(texts)


def test_large_arrays_are_split(spark, tmp_path):
    records = [{"x": i, "t": "a\nb ]", "n": {"k": [{"q": None, "z": i}]}} for i in range(20_000)]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=2))
    (tmp_path / "b.json").write_text(json.dumps(records[:5]))
    (tmp_path / "e.json").write_text("[]")
    small = read_json(spark, str(tmp_path))
    split = read_json(spark, str(tmp_path), split_over=1000)
    assert split.schema == small.schema and sorted(split.collect(), key=str) == sorted(small.collect(), key=str)
    assert split.count() == 20_005
    (tmp_path / "f.json").write_text('[{"x": 1}, {"x" 2}]')
    with pytest.raises(Exception, match="JSONDecodeError"):
        read_json(spark, str(tmp_path / "f.json"), split_over=0).count()


@pytest.mark.parametrize(
    ("name", "kind"),
    [("a.csv", "csv"), ("d/e.TXT", "csv"), ("../evil.txt", None), (".hid.csv", None),
     ("__x.csv", None), ("__MACOSX/x.csv", "csv"), ("d/", None), ("in.zip", None),
     ("readme", None), ("p.parquet", "parquet"), ("x.xlsx", "excel")],
)
def test_member_type(name, kind):
    assert member_type(name) == kind


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)


def test_read_archives(spark, tmp_path):
    table = io.BytesIO()
    pd.DataFrame({"a": ["p1"], "b": ["p2"]}).to_parquet(table)
    _zip(tmp_path / "one.zip", {
        "x.csv": "a,b\n1,2\n3\n4,5,6\n",
        "d/y.txt": "note\n" + "\t".join("abcdefg") + "\n" + "\t".join("1234567") + "\n",
        "l.csv": "a,b\nJos\xe9,q\n".encode("latin-1"),
        "z.json": '[{"a": "j1", "b": "j2"}]',
        "o.json": '{"a": "o1", "n": {"k": "v"}}',
        "t.parquet": table.getvalue(),
        "../evil.csv": "a,b\nno,no\n", ".hid.csv": "a,b\nno,no\n", "notes.md": "no",
    })
    _zip(tmp_path / "two.zip", {"w.csv": "a|b\n8|9\n", "only_header.csv": "a,b\n"})
    got = read_archives(spark, str(tmp_path), position=True)
    found = sorted((r["a"], r["b"]) for r in got.collect() if r["a"] != "o1" and r["member"] != "d/y.txt")
    assert found == sorted([("1", "2"), ("3", None), ("José", "q"), ("j1", "j2"),
                            ("p1", "p2"), ("8", "9")], key=lambda t: t[0])
    wide = got.where("member = 'd/y.txt'").first()
    assert (wide["a"], wide["g"], wide["line_no"]) == ("1", "7", 0)
    assert got.where("a = 'o1'").first()["n.k"] == "v"


def test_members_are_tasks(spark, tmp_path):
    numbers = range(30_000)
    table = io.BytesIO()
    pd.DataFrame({"a": [f"p{i}" for i in numbers]}).to_parquet(table, row_group_size=4_000)
    members = {
        "x.csv": "a,b\n" + "".join(f"c{i},1\n" for i in numbers),
        "y.json": json.dumps([{"a": f"j{i}", "b": "]},{[\\\""} for i in numbers], indent=1),
        "t.parquet": table.getvalue(),
    }
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    lines = read_members(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() == 3
    got = read_archives(spark, str(tmp_path), position=True)
    want = {f"{k}{i}" for k in "cjp" for i in numbers}
    assert {r["a"] for r in got.select("a").collect()} == want and got.count() == len(want)
    assert got.where("b = ']},{[\\\\\"'").count() == len(numbers)
    content = spark.read.format("binaryFile").load(str(tmp_path))  # a store out of reach
    assert sorted(explode_archives(content).drop("archive").collect(), key=str) == sorted(
        lines.drop("archive").collect(), key=str
    )


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
@pytest.mark.parametrize(
    "text",
    ["[]", " [ ] ", '[{"a": [1, {"b": "]"}]}, 12, "x\\\"", null, -1.5e3]', "\ufeff[\n12]\n", "[[],[[]]]"],
)
def test_array_records(text, size):
    parts = [text[i : i + size] for i in range(0, len(text), size)]
    assert [json.loads(r) for r in array_records(parts)] == json.loads(text.lstrip("\ufeff"))


@pytest.mark.parametrize("text", ["[1", "[1 2]", "{}", "[1,]", '[{"a": ]', ""])
def test_broken_arrays(text):
    with pytest.raises(ValueError):
        list(array_records([text]))


def test_archive_without_supported_member(spark, tmp_path):
    _zip(tmp_path / "none.zip", {"readme.md": "x"})
    with pytest.raises(Exception, match="no supported file"):
        read_archives(spark, str(tmp_path))


def test_explode_api_records(frame):
    bodies = ['[{"a": 1}, {"a": 2}]', '{"results": [{"a": 3}], "data": [{"a": 9}]}',
              '{"results": 5, "data": [{"a": 4}]}', '{"items": []}', '{"a": 6}']
    pages = frame([(i, b) for i, b in enumerate(bodies)], "page int, body string")
    got = [(p, json.loads(r)) for p, r in rows(explode_api_records(pages), "page", "record")]
    assert got == [(0, {"a": 1}), (0, {"a": 2}), (1, {"a": 3}), (2, {"a": 4}), (4, {"a": 6})]
    keyed = frame([(1, '{"rows": [{"a": 1}]}'), (2, '{"other": 1}')], "page int, body string")
    assert rows(explode_api_records(keyed, data_key="rows")) == [(1, '{"a":1}')]
    for body, key in (("3", None), ('{"rows": 4}', "rows"), ("no json", None)):
        with pytest.raises(Exception, match="API"):
            explode_api_records(frame([(body,)], "body string"), data_key=key).collect()


def test_audit_paths(spark, frame, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"test data")
    (tmp_path / "b.bin").write_bytes(b"x")
    (tmp_path / "e.bin").write_bytes(b"")
    good = hashlib.sha256(b"test data").hexdigest().upper()
    expected = frame([("a.bin", good), ("b.bin", "0" * 64), ("gone.bin", None)],
                     "name string, sha256 string")
    got = {r["name"]: (r["ok"], r["reason"]) for r in audit_paths(spark, str(tmp_path), expected).collect()}
    assert got == {"a.bin": (True, None), "b.bin": (False, "checksum differs"),
                   "e.bin": (False, "too small"), "gone.bin": (False, "missing")}
    sizes = audit_paths(spark, str(tmp_path))
    assert {r["name"]: r["size"] for r in sizes.collect()} == {"a.bin": 9, "b.bin": 1, "e.bin": 0}
    plan = sizes._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan
    assert list_files(spark, str(tmp_path), ["a*", "b*"]).count() == 2
    assert files_exist(spark, str(tmp_path), min_files=2)
    assert not files_exist(spark, str(tmp_path), ["a*"], min_files=2)
    assert not files_exist(spark, str(tmp_path / "nowhere"))


def test_write_stage_keeps_what_is_there(spark, frame, tmp_path):
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        write_stage(frame([("one",)], "v string"), path, fmt)
        again = write_stage(frame([("two",)], "v string"), path, fmt)
        assert rows(again) == [("one",)]
        assert rows(write_stage(frame([("two",)], "v string"), path, fmt, "overwrite")) == [("two",)]


def test_load_dataframe(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.json").write_text('[{"x": "3", "z": "4"}]')
    pd.DataFrame({"x": ["5"]}).to_parquet(tmp_path / "c.parquet")
    _zip(tmp_path / "d.zip", {"m.csv": "x,y\n6,7\n"})
    got = load_dataframe(spark, str(tmp_path))
    assert {(r["x"], r["y"], r["z"]) for r in got.collect()} == {
        ("1", "2", None), ("3", None, "4"), ("5", None, None), ("6", "7", None),
    }
    (tmp_path / "e.xlsx").write_bytes(b"x")
    with pytest.raises(ValueError, match="xlsx"):
        load_dataframe(spark, str(tmp_path))
