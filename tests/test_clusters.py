import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators import clusters as C
from kinfold.session import materialize


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in list(parent)}


def random_graph(n, m, seed):
    rng = random.Random(seed)
    return [(f"v{rng.randrange(n):03d}", f"v{rng.randrange(n):03d}") for _ in range(m)]


GRAPHS = {
    "chain": [(f"v{i:03d}", f"v{i + 1:03d}") for i in range(60)],
    "mixed chain": [(f"v{(i * 37) % 101:03d}", f"v{((i + 1) * 37) % 101:03d}") for i in range(90)],
    "star": [("v500", f"v{i:03d}") for i in range(200)],
    "cycle": [(f"v{i:03d}", f"v{(i + 1) % 30:03d}") for i in range(30)],
    "two parts": [("a", "b"), ("b", "c"), ("x", "y")],
    "repeats and loops": [("a", "b"), ("b", "a"), ("a", "a"), ("c", "c")],
    "random": random_graph(200, 150, 1),
    "dense": random_graph(40, 300, 2),
    "none": [],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components_equal_union_find(spark, name):
    edges = GRAPHS[name]
    got = C.connected_components(spark.createDataFrame(edges, "src string, dst string"))
    rows = [tuple(r) for r in got.collect()]
    want = union_find([(a, b) for a, b in edges if a != b])
    assert len(rows) == len(want) and dict(rows) == want


def test_the_edges_of_a_hub_are_split(spark):
    """The join of a round spreads one vertex over several tasks."""
    own = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        hub = spark.range(1, 200_000, 1, 16).select(F.col("id").alias("a"), F.lit(0).alias("b"))
        edges = materialize(hub, "hub")
        star = C._large_star(edges, C._lowest(edges.unionByName(C._turned(edges))))
        assert len(star.collect()) == 199_999
        assert "skew=true" in star._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_vertices_and_golden_ids(spark):
    components = C.connected_components(
        spark.createDataFrame([("d", "b"), ("c", "e")], "src string, dst string")
    )
    vertices = spark.createDataFrame([(x,) for x in "abcdef"], "unique_id string")
    labelled = C.label_vertices(vertices, components, "unique_id")
    golden = C.assign_golden_ids(labelled)
    assert {r["unique_id"]: r["golden_id"] for r in golden.collect()} == {
        "a": 1, "b": 2, "c": 3, "d": 2, "e": 3, "f": 4}


def test_reports(spark):
    records = spark.createDataFrame(
        [("a", "x"), ("b", "x"), ("c", "y"), ("d", None)], "unique_id string, county_desc string")
    ids = spark.createDataFrame([(1, "a"), (1, "c"), (2, "b"), (2, "d"), (3, "gone")],
                                "golden_id bigint, unique_id string")
    golden = C.attach_records(ids, records)
    assert golden.count() == 5
    counts = {r["golden_id"]: r["county_count"] for r in C.count_sources(golden).collect()}
    assert counts == {1: 2, 2: 1, 3: 0}
    report = C.multi_source_report(golden)
    assert report.columns == ["golden_id", "county_count", "unique_id", "county_desc"]
    assert sorted(r["unique_id"] for r in report.collect()) == ["a", "c"]


def test_rounds_are_bounded(spark):
    chain = spark.createDataFrame(GRAPHS["chain"], "src string, dst string")
    with pytest.raises(RuntimeError):
        C.connected_components(chain, max_rounds=1)
