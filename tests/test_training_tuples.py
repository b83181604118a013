"""Level patterns from distinct values against all pairs of records."""

import random

import pytest
from pyspark.sql import functions as F

from kinfold.functions.similarity import jaro_winkler
from kinfold.operators.blocking import candidate_pairs, fold_profiles, single_profiles
from kinfold.operators.comparison import add_letter_bits, compare, exact, similar
from kinfold.operators.training import count_patterns, tuple_pairs

COMPARISONS = (similar("first", [0.95, 0.8]), exact("sex"), similar("full", [0.9]))
RULE = ("year", "last")
SCHEMA = "unique_id string, county_desc string, year int, last string, first string, sex string, full string"


def people(n, sources, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        first = rng.choice(["ann", "anna", "anne", "bob", "rob", None])
        rows.append((
            f"{i}", rng.choice([*sources, None]), rng.choice([1980, 1981, None]),
            rng.choice(["lee", "li", None]), first, rng.choice(["f", "m", None]), f"{first} lee",
        ))
    return rows


def counted(df):
    return {tuple(r[:-1]): r[-1] for r in df.collect()}


@pytest.mark.parametrize("cell_rows", [5000, 3])
def test_patterns_equal_those_of_all_record_pairs(spark, cell_rows):
    df = spark.createDataFrame(people(300, "abc"), SCHEMA)
    bits = lambda rows: add_letter_bits(rows, COMPARISONS)
    every = candidate_pairs(bits(single_profiles(df)), [RULE])
    want = counted(count_patterns(compare(every, COMPARISONS, ["n_pairs"]), COMPARISONS))
    # Profiles may be finer than the compared values.
    profiles = fold_profiles(df.withColumn("more", F.col("unique_id") % 3), ["first", "sex", "full", "more", *RULE])
    pairs = tuple_pairs(profiles, RULE, COMPARISONS, cell_rows=cell_rows)
    assert counted(count_patterns(compare(pairs, COMPARISONS, ["n_pairs"]), COMPARISONS)) == want


def test_copies_and_sources_add_no_pairs(spark):
    def formed(rows):
        df = spark.createDataFrame(rows, SCHEMA)
        return tuple_pairs(fold_profiles(df, ["first", "sex", "full", *RULE]), RULE, COMPARISONS).count()

    rows = people(300, "ab")
    copies = [(f"{r[0]}-{k}", *r[1:]) for r in rows for k in range(3)]
    elsewhere = [(f"{r[0]}+{k}", f"{r[1]}{k}" if r[1] else None, *r[2:]) for r in rows for k in range(4)]
    assert formed(rows) == formed(copies)
    assert formed(elsewhere) <= 2 * (6 * 3) * (6 * 3 + 1) // 2 * 2  # pairs of values in four blocks


def test_no_pairs_without_a_second_source(spark):
    df = spark.createDataFrame([("1", "a", 1980, "lee", "ann", "f", "x")] * 3, SCHEMA)
    assert tuple_pairs(fold_profiles(df, ["first", "sex", "full", *RULE]), RULE, COMPARISONS).count() == 0


def test_similarity_does_not_depend_on_the_order(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))
    df = spark.createDataFrame([(word(), word()) for _ in range(20_000)], "a string, b string")
    assert df.where(jaro_winkler("a", "b") != jaro_winkler("b", "a")).count() == 0
