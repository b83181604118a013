"""Small cells do not copy the rows of a large block more and more often."""

from pyspark.sql import functions as F

from kinfold.operators import blocking as B
from kinfold.operators.pattern_counts import cells_of


def block_of(spark, n):
    source = F.concat(F.lit("c"), F.col("id") % 3).alias("county_desc")
    key = F.lpad(F.col("id").cast("string"), 6, "0").alias("profile_id")
    return spark.range(n).select(key, source, F.lit("x").alias("k"), F.lit(1).cast("long").alias("n_records"))


def test_copies_stay_few(spark):
    parts = lambda n, rows: B.hot_blocks(block_of(spark, n), ["k"], rows).first()["_parts"]
    assert B.hot_blocks(block_of(spark, 10), ["k"], 10) is None
    assert [parts(11, 10), parts(80, 10), parts(2000, 10), parts(8001, 10)] == [2, 8, 8, 9]
    assert [parts(20_001, 1000), parts(20_001, 5000)] == [21, 5]
    assert cells_of(block_of(spark, 2000), ["k"], 10).count() == 8 * 2000


def test_no_pair_is_lost(spark):
    pairs = B.candidate_pairs(block_of(spark, 900), [("k",)], cell_rows=10)
    assert pairs.count() == pairs.select("profile_id_l", "profile_id_r").distinct().count() == 3 * 300 * 300
    assert pairs.where("county_desc_l >= county_desc_r").isEmpty()
