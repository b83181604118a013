"""Pairs with their levels, taken cell by cell, against pairs that are joined and compared one by one."""

import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators import compared_pairs as P
from kinfold.operators.blocking import candidate_pairs
from kinfold.operators.comparison import add_letter_bits, compare, exact, similar
from kinfold.operators.scoring import predict
from kinfold.operators.training import Model
from kinfold.plans import match as M

SCHEMA = (
    "profile_id string, county_desc string, n_records bigint, first_name string, middle_name string,"
    " last_name string, full_name string, birth_year smallint, gender_code string"
)


def some_profiles(n, seed=3, nulls=0.1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        middle = "".join(rng.choice("aeilnrst") for _ in range(rng.randint(2, 12)))
        names = [rng.choice(["mary", "mari", "é", "Mary Ann"]), middle, rng.choice(["lee", "leigh", "lees", "li"])]
        names = [None if rng.random() < nulls else x for x in names]
        full = " ".join(x for x in names if x) or None
        year, sex = rng.choice([1980, 1981, None]), rng.choice(["f", "m", None])
        source = rng.choice(["b", "a", "é", "c", "Z", None])
        rows.append((f"p{i:04d}", source, rng.randint(1, 4), *names, full, year, sex))
    return rows


def counted(df):
    return sorted(map(repr, map(tuple, df.collect())))


def joined(profiles, settings):
    """Levels of joined pairs, as before they were taken where pairs are formed."""
    bits = add_letter_bits(profiles, settings.comparisons)
    pairs = candidate_pairs(bits, settings.rules, settings.source)
    keep = ["profile_id_l", "profile_id_r", "match_key", "n_pairs"]
    keep += [f"{c}_{s}" for c in ("county_desc", "gender_code", "birth_year") for s in "lr"]
    return compare(pairs, settings.comparisons, keep)


@pytest.mark.parametrize("rules", [M.PERSON_RULES, (("last_name", "gender_code"), ("birth_year", "first_name"))])
@pytest.mark.parametrize(("cell_rows", "pairs_at_once"), [(1000, 100_000), (7, 50)])
def test_levels_equal_those_of_joined_pairs(spark, monkeypatch, rules, cell_rows, pairs_at_once):
    monkeypatch.setattr(P, "PAIRS_AT_ONCE", pairs_at_once)
    profiles = spark.createDataFrame(some_profiles(260), SCHEMA)
    settings = M.MatchSettings(rules=rules, cell_rows=cell_rows)
    got = M.compare_candidates(profiles, settings)
    want = joined(profiles, settings)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert counted(got) == counted(want) and got.count() > 500


def test_candidates_are_not_joined_row_by_row(spark):
    """No join gives a row with texts per pair, and no loop over characters is left to the expressions."""
    profiles = spark.createDataFrame(some_profiles(50), SCHEMA)
    model = Model.start(M.PERSON_COMPARISONS, 0.01)
    found = predict(M.compare_candidates(profiles, M.MatchSettings()), model)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "levenshtein" not in plan and "lambda" not in plan


def test_other_kinds_of_columns_are_joined(spark):
    """Doubles, of which Spark finds 0.0 and -0.0 equal, and more levels than a number holds."""
    rows = [(f"p{i}", "ab"[i % 2], 1, "x", (0.0, -0.0, float("nan"), 1.5)[i % 4]) for i in range(24)]
    profiles = spark.createDataFrame(rows, "profile_id string, county_desc string, n_records bigint, k string, d double")
    some = M.MatchSettings(comparisons=(exact("d"),), rules=(("k",),), equal=())
    got = M.compare_candidates(profiles, some)
    assert got.agg(F.sum("gamma_d")).first()[0] == sum(
        (a[4] == b[4]) or (a[4] != a[4] and b[4] != b[4])
        for a in rows for b in rows if a[1] < b[1]
    )
    many = tuple(similar("k", [0.9 - 0.01 * i for i in range(6)], name=f"k{i}") for i in range(9))
    got = M.compare_candidates(profiles, M.MatchSettings(comparisons=many, rules=(("k",),), equal=()))
    assert got.select("gamma_k0", "gamma_k8").distinct().collect() == [(7, 7)] and got.count() == 144
