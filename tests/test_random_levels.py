"""Levels of random pairs, over rows of their own."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", ["random_pair_levels", "random_pair_levels_of_all"])
def test_random_levels_equal_sql(spark, tmp_path, name):
    words = ["anna", "berta", "bertha", "carl", "karl"]
    rows = [
        (i, f"{words[i % 5]} x {words[i % 3]}" if i % 11 else None, "en" if i % 2 else None, f"s{i % 3}", 500 * (i % 4))
        for i in range(90)
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).toPandas().to_parquet(tmp_path / "documents.parquet")
    got = queries()[name](spark, str(tmp_path))
    assert compare(got, connect(str(tmp_path)), oracle_sql()[name]) is None
    assert got.count() > 3
