import hashlib

from pyspark.sql import functions as F

from kinfold.operators.identity import (
    add_hash_ids,
    add_sequential_ids,
    add_uuid_ids,
    keep_first_rows,
    number_in_order,
    sample_exactly,
)


def test_numbering_is_gapless_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("g"))
    got = {r["k"]: r["n"] for r in number_in_order(df, ["k"]).collect()}
    assert got == {k: k + 1 for k in range(1000)}
    # one group with far more rows than the others, and a null group
    skew = df.withColumn("g", F.when(F.col("k") < 900, 1).when(F.col("k") < 950, 2))
    rows = number_in_order(skew, ["k"], within=["g"]).collect()
    want = {}
    for k in range(1000):
        g = 1 if k < 900 else 2 if k < 950 else None
        want[k] = k + 1 - {1: 0, 2: 900, None: 950}[g]
    assert {r["k"]: r["n"] for r in rows} == want


def test_sequential_ids(frame):
    df = frame([("b", 2), ("a", 9), ("b", 1)], "dataset string, pos int")
    got = add_sequential_ids(df, "dataset", ["pos"])
    assert got.columns[0] == "unique_id"
    assert {tuple(r) for r in got.collect()} == {("b_1", "b", 1), ("b_2", "b", 2), ("a_1", "a", 9)}


def test_hash_and_uuid_ids(frame):
    df = frame([("a", "b"), ("ab", None), ("a", "b")], "x string, y string")
    ids = [r[0] for r in add_hash_ids(df).collect()]
    assert ids[0] == ids[2] == hashlib.sha256(b"1:a|1:b").hexdigest() and ids[1] != ids[0]
    assert add_uuid_ids(df).select("unique_id").distinct().count() == 3


def test_sample(spark):
    df = spark.range(500).select(F.concat(F.lit("r_"), "id").alias("unique_id"), "id")
    ranked = sorted((hashlib.md5(f"r_{i}|42".encode()).hexdigest(), f"r_{i}") for i in range(500))
    got = {r["unique_id"] for r in sample_exactly(df, 60).collect()}
    assert got == {u for _, u in ranked[:60]}
    assert sample_exactly(df, 500).count() == 500
    assert sample_exactly(df, 501).count() == 500


def test_row_cap(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 2).alias("g"))
    got = keep_first_rows(df, 3, ["id"], ["g"])
    assert sorted(r["id"] for r in got.collect()) == [0, 1, 2, 3, 4, 5]
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
