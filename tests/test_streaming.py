from pyspark.sql import functions as F

from kinfold.operators.mapping import LINKAGE_COLUMNS
from kinfold.plans.prepare import prepare, prepare_files
from kinfold.sources.delimited import POSITION, read_delimited
from kinfold.streaming.incremental import numbered_batch, read_ledger, run_incremental

HEAD = "\t".join(["id", *LINKAGE_COLUMNS])


def write(path, rows):
    path.write_text("\n".join([HEAD, *("\t".join(r) for r in rows)]) + "\n")


def row(i, name, county):
    return [str(i), f" Mr {name} ", "", "O'Neil", "F", "1980", "Town", f"NC 2760{i % 10}", county]


def test_stream_takes_only_new_files(spark, tmp_path):
    landing, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    landing.mkdir()
    write(landing / "c1.txt", [row(i, "Ann", "wake") for i in range(3)])
    schema = ", ".join(f"{c} string" for c in ["id", *LINKAGE_COLUMNS])
    counts = []
    for arriving in (None, "c2", None):
        if arriving:
            write(landing / f"{arriving}.txt", [row(i, "Bob", "durham") for i in range(2)])
        stream = run_incremental(spark, str(landing), schema, out, state, sep="\t", header="true")
        stream.awaitTermination()
        counts.append(spark.read.parquet(out).count())
    assert counts == [3, 5, 5]
    got = spark.read.parquet(out)
    assert {tuple(r) for r in got.select("dataset", "first_name", "last_name").distinct().collect()} == {
        ("c1", "ann", "oneil"), ("c2", "bob", "oneil")}
    assert got.where(F.length("unique_id") != 64).count() == 0


def test_prepare_files_skips_finished_datasets(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "ready")
    assert prepare_files(spark, str(raw), out) is None
    raw.mkdir()
    write(raw / "c1.txt", [row(i, "Ann", "wake") for i in range(12)])
    first = prepare_files(spark, str(raw), out)
    ids = [r["unique_id"] for r in first.orderBy("zip_code").collect()]
    assert set(ids) == {f"c1_{i}" for i in range(1, 13)}
    write(raw / "c2.txt", [row(i, "Bob", "durham") for i in range(2)])
    write(raw / "c1.txt", [row(0, "Changed", "wake")])
    both = prepare_files(spark, str(raw), out)
    assert both.count() == 14 and both.where("first_name = 'changed'").count() == 0
    assert prepare_files(spark, str(raw), out).count() == 14
    order = {r["unique_id"]: r["zip_code"] for r in both.where("dataset = 'c1'").collect()}
    assert [order[f"c1_{i + 1}"] for i in range(12)] == [f"2760{i % 10}" for i in range(12)]


def test_prepare_files_keeps_odd_dataset_names(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "ready")
    raw.mkdir()
    for name in ("a=b", "001"):
        write(raw / f"{name}.txt", [row(i, "Ann", "wake") for i in range(3)])
    for _ in range(2):  # the second run finds both datasets done
        got = prepare_files(spark, str(raw), out).select("dataset", "unique_id").collect()
        assert sorted(got) == [(n, f"{n}_{i}") for n in ("001", "a=b") for i in (1, 2, 3)]


def numbered(path, spark):
    return {(r["dataset"], int(r["unique_id"].rsplit("_", 1)[1])): r["zip_code"] for r in spark.read.parquet(path).collect()}


def test_numbered_stream_keeps_copies_and_goes_on_counting(spark, tmp_path):
    landing, out, ledger, state = tmp_path / "in", *(str(tmp_path / n) for n in ("out", "ledger", "state"))
    landing.mkdir()
    schema = ", ".join(f"{c} string" for c in ["id", *LINKAGE_COLUMNS])
    arrivals = [("a", "c1", 300), ("a", "c2", 5), ("b", "c1", 300), (None, "", 0)]
    want = {}
    for folder, name, n in arrivals:
        if folder:
            (landing / folder).mkdir(exist_ok=True)
            write(landing / folder / f"{name}.txt", [row(i, "Ann", "wake") for i in range(n)])
        query = run_incremental(
            spark, f"{landing}/*", schema, out, state, ledger=ledger, sep="\t", header="true"
        )
        query.awaitTermination()
        first = sum(d == name for d, _ in want) + 1
        want |= {(name, first + i): f"2760{i % 10}" for i in range(n)}
    assert numbered(out, spark) == want
    assert read_ledger(spark, ledger).count() == 3


def test_a_batch_run_again_draws_the_same_numbers(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    rows = [(d, f"/{d}{f}", b, f"{f}{b}{i}") for f in "xy" for d in ("c1", "c2") for b in (0, 64) for i in range(4)]
    schema = "dataset string, _file string, _block long, zip_code string"
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", 4)  # a split is in one partition
    try:
        batch = spark.createDataFrame(rows, schema)
        write_batch = numbered_batch(out, ledger)
        write_batch(batch, 0)
        write_batch(batch, 1)
        both = numbered(out, spark)
        ordered = lambda d: [r[3] for r in sorted(r for r in rows if r[0] == d)]
        assert both == {(d, i + 1): z for d in ("c1", "c2") for i, z in enumerate(ordered(d) * 2)}
        write_batch(batch, 1)  # after a failure
        assert numbered(out, spark) == both
        (tmp_path / "ledger" / "batch=1").rename(tmp_path / "lost")  # it failed before the ledger
        write_batch(batch, 1)
        assert numbered(out, spark) == both
        write_batch(batch.where("dataset = 'c2'"), 2)
        assert len(numbered(out, spark)) == len(both) + 16
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_file_order_needs_no_sort(spark, tmp_path):
    path = tmp_path / "c1.txt"
    write(path, [row(i, "Ann" * 50, "wake") for i in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        raw = read_delimited(spark, str(path), position=True)
        assert raw.rdd.getNumPartitions() > 3
        ready = prepare(raw, "dataset", POSITION)
        assert "rangepartitioning" not in ready._jdf.queryExecution().toString()
        got = {r["unique_id"]: r["zip_code"] for r in ready.collect()}
        assert got == {f"c1_{i + 1}": f"2760{i % 10}" for i in range(5000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
