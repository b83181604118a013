"""Pairs of a block are dealt to tasks by their number, and levels are bounded without loss."""

import random

from pyspark.sql import functions as F

from kinfold.functions.similarity import letter_bits, similarity_level
from kinfold.operators import blocking as B
from kinfold.operators.comparison import compare, similar
from tests.test_similarity import by_hand

ROWS = "profile_id string, name string, block string, county_desc string, n_records bigint"


def test_no_task_gets_a_whole_block(spark, monkeypatch):
    monkeypatch.setattr(B, "TASK_PAIRS", 5_000)
    rows = [(f"p{i:04d}", f"n{i}", "hot" if i % 4 else f"b{i % 40}", f"c{i % 3}", 1) for i in range(800)]
    profiles = spark.createDataFrame(rows, ROWS)
    pairs = B.join_block(profiles, ["block"], "county_desc", 100)
    # 600 x 600 pairs of the hot block are looked at
    per_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 10 * (20 * 20 - 7 * 7 - 7 * 7 - 6 * 6) // 2 + 3 * 200 * 200
    assert len(per_task) >= 20 and max(per_task) < sum(per_task) / 4
    assert B.block_tasks(profiles, ["block"]) == -(-(600**2 + 10 * 20**2) // 5_000)
    assert B.block_tasks(profiles.where("block <> 'hot'"), ["block"]) == 0


def test_levels_of_long_names_equal_the_definition(spark):
    """Names of one start with typos, turned letters and anagrams around the thresholds."""
    rng = random.Random(4)
    rows = []
    for i in range(4000):
        a = "mary " + "".join(rng.choice("aeinrstvxz ") for _ in range(rng.randint(1, 24)))
        b = list(a)
        for _ in range(rng.randint(1, 6)):
            j, k = sorted((rng.randrange(len(b)), rng.randrange(len(b))))
            edit = rng.randrange(3)
            if edit == 0:
                b[j], b[k] = b[k], b[j]
            elif edit == 1:
                b[j] = rng.choice("aeinrstvxz")
            elif len(b) > 2:
                del b[j]
        rows.append((i, a, "".join(b)))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    df = df.withColumns({"x": letter_bits("a"), "y": letter_bits("b")})
    cuts = [0.85, 0.92, 0.97]
    got = df.orderBy("i").select(similarity_level("a", "b", cuts, ("x", "y"))).collect()
    want = [4 if a == b else sum(by_hand(a, b) >= t for t in cuts) for _, a, b in rows]
    assert [r[0] for r in got] == want and min(want.count(g) for g in range(4)) > 100


def test_levels_are_computed_below_the_generator(spark):
    df = spark.createDataFrame([("martha", "marhta")], "a_l string, a_r string")
    levels = compare(df, [similar("a", [0.9])], [])
    plan = levels.where("gamma_a > 0")._jdf.queryExecution().optimizedPlan().toString()
    generators = [line for line in plan.splitlines() if "Generate inline" in line]
    assert levels.first()[0] == 1 and generators and not any("aggregate(" in g for g in generators)
