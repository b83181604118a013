"""Patterns counted cell by cell against the levels of all record pairs."""

import pytest
from pyspark.sql import functions as F

from kinfold.operators import training
from kinfold.operators.blocking import candidate_pairs, fold_profiles, single_profiles
from kinfold.operators.comparison import compare, exact, similar
from kinfold.operators.training import block_patterns, count_patterns
from tests.test_training_tuples import COMPARISONS, RULE, SCHEMA, counted, people


@pytest.mark.parametrize("cell_rows", [5000, 3])
@pytest.mark.parametrize("pairs_at_once", [7, 100_000])
def test_patterns_equal_those_of_all_record_pairs(spark, monkeypatch, cell_rows, pairs_at_once):
    from kinfold.operators import pattern_counts

    monkeypatch.setattr(pattern_counts, "PAIRS_AT_ONCE", pairs_at_once)
    df = spark.createDataFrame(people(300, "abc"), SCHEMA)
    every = candidate_pairs(single_profiles(df), [RULE])
    want = counted(count_patterns(compare(every, COMPARISONS, ["n_pairs"]), COMPARISONS))
    profiles = fold_profiles(df.withColumn("more", F.col("unique_id") % 3), ["first", "sex", "full", "more", *RULE])
    assert counted(block_patterns(profiles, RULE, COMPARISONS, cell_rows=cell_rows)) == want
    monkeypatch.setattr(training, "MAX_PATTERNS", 1)
    assert counted(block_patterns(profiles, RULE, COMPARISONS, cell_rows=cell_rows)) == want


def test_pairs_are_no_rows(spark):
    """2,000 different names in one block, four million pairs: no node of the plan gives a row per pair."""
    rows = [(f"{i}", "ab"[i % 2], 1980, "lee", f"n{i}", "f", f"n{i} lee") for i in range(2000)]
    profiles = fold_profiles(spark.createDataFrame(rows, SCHEMA), ["first", "sex", "full", *RULE])
    found = block_patterns(profiles, RULE, [similar("first", [0.9]), exact("sex")])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and not any(x in plan for x in ("SortMergeJoin", "ShuffledHashJoin"))
    assert found.agg(F.sum("n_pairs")).first()[0] == 1000 * 1000


def test_large_counts_are_exact(spark):
    n = 2_000_000_001
    rows = [("1", "a", 1980, "lee", "ann", "f", "x", n), ("2", "b", 1980, "lee", "ann", "f", "x", n),
            ("3", "b", 1980, "lee", "bob", None, "y", 3)]
    df = spark.createDataFrame(rows, SCHEMA + ", n_records long").withColumnRenamed("unique_id", "profile_id")
    found = counted(block_patterns(df, RULE, [similar("first", [0.9]), exact("sex")]))
    assert found == {(2, 1): n * n, (0, -1): 3 * n}


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert counted(block_patterns(fold_profiles(df, ["first", "sex", "full", *RULE]), RULE, COMPARISONS)) == {}
