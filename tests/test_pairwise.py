"""Whole batches of strings against the definition, pair by pair."""

import random

import numpy as np
import pyarrow as pa
import pytest

from kinfold.functions.pairwise import Column, Words, jaro_winkler
from kinfold.functions.similarity import jaro_winkler as measure
from kinfold.functions.similarity import letter_bits, similarity_level
from tests.test_similarity import by_hand


def words(letters, longest, n, seed=5):
    rng = random.Random(seed)
    found = []
    for _ in range(n):
        a = [rng.choice(letters) for _ in range(rng.randint(1, longest))]
        k = rng.randrange(len(a))
        found += ["".join(a), "".join(a[:k] + [rng.choice(letters)] + a[k + rng.randint(0, 1) :])]
    return found


@pytest.mark.parametrize(("letters", "longest"), [("abcde", 9), ("abé漢😀", 12), ("ab", 90), ("aeinrst", 30)])
def test_batches_equal_the_definition(letters, longest):
    some = words(letters, longest, 150)
    pairs = [(a, b) for a, b in zip(some, [*some[1:], some[0]], strict=True) if a != b]
    left, right = (Words(pa.array(side)) for side in zip(*pairs, strict=True))
    every = np.arange(len(pairs))
    got = jaro_winkler(left, right, every, every)
    assert got.tolist() == [by_hand(a, b) for a, b in pairs]


@pytest.mark.parametrize("cuts", [[0.9], [0.5, 0.75], [0.9, 0.95]])
def test_levels_of_a_column(cuts):
    some = [*words("abc", 8, 40), None, ""]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(some)), np.arange(len(some))))

    def level(a, b):
        if a is None or b is None:
            return -1
        return len(cuts) + 1 if a == b else sum(by_hand(a, b) >= t for t in cuts)

    want = [level(some[a], some[b]) for a, b in zip(i, j, strict=True)]
    for pairs in (0, 10**6):
        assert Column(pa.array(some), cuts, pairs).levels(i, j).tolist() == want


def test_measure_and_letters_take_whole_batches(spark):
    df = spark.createDataFrame([("a", "b")], "a string, b string")
    df = df.withColumns({"x": letter_bits("a"), "y": letter_bits("b")})
    level = similarity_level("a", "b", [0.5, 0.75], ("x", "y"))
    plan = df.select(measure("a", "b"), level)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan


def test_slices_and_nulls():
    found = Words(pa.array(["zz", None, "", "abba", "é"])[1:])
    assert found.length.tolist() == [0, 0, 4, 1]
    assert found.letter_bits().tolist() == [0, 0, 3 | 3 << 21, 0]


@pytest.mark.parametrize("longest", [12, 90])
def test_a_start_that_all_pairs_share(longest):
    """Names of one first name, as in a block, and starts that only look shared."""
    some = [f"anna {w}" for w in words("annab ", longest, 120)] + ["anna", "anna a", "anna annaanna"]
    pairs = [(a, b) for a, b in zip(some, [*some[1:], some[0]], strict=True) if a != b]
    left, right = (Words(pa.array(side)) for side in zip(*pairs, strict=True))
    every = np.arange(len(pairs))
    assert jaro_winkler(left, right, every, every).tolist() == [by_hand(a, b) for a, b in pairs]
