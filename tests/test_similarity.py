import random

import duckdb
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.functions.similarity import jaro_winkler, letter_bits, similarity_keys, similarity_level


def by_hand(a: str, b: str) -> float:
    """The textbook definition, character by character."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, hits = set(), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if j not in used and b[j] == ch:
                used.add(j)
                hits.append(ch)
                break
    m = len(hits)
    if not m:
        return 0.0
    moved = sum(x != b[j] for x, j in zip(hits, sorted(used), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def pairs_frame(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    return df.withColumns({"ba": letter_bits("a"), "bb": letter_bits("b")})


def test_published_values(spark):
    known = [("martha", "marhta", 0.9611), ("dixon", "dicksonx", 0.8133), ("dwayne", "duane", 0.84),
             ("", "", 0.0), ("a", "", 0.0), ("a", "a", 1.0), ("a", "b", 0.0), ("ab", "ba", 0.0)]
    got = pairs_frame(spark, [(a, b) for a, b, _ in known]).orderBy("i").select(jaro_winkler("a", "b"))
    assert [round(r[0], 4) for r in got.collect()] == [w for _, _, w in known]


def test_null(spark):
    df = pairs_frame(spark, [(None, "a"), ("a", None), (None, None)])
    assert [r[0] for r in df.select(jaro_winkler("a", "b")).collect()] == [None] * 3
    assert [r[0] for r in df.select(similarity_level("a", "b", [0.9])).collect()] == [-1] * 3


WORD = st.text("abcde", max_size=9)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(WORD, WORD), min_size=20, max_size=60))
def test_equals_definition(spark, pairs):
    df = pairs_frame(spark, pairs)
    levels = [0.6, 0.8, 0.92]
    got = df.orderBy("i").select(
        jaro_winkler("a", "b").alias("w"), similarity_level("a", "b", levels, ("ba", "bb")).alias("g"),
        similarity_level("a", "b", levels).alias("h"))
    for (a, b), r in zip(pairs, got.collect(), strict=True):
        want = by_hand(a, b)
        assert r["w"] == pytest.approx(want, abs=1e-12)
        level = 4 if a == b else sum(want >= t for t in levels)
        assert r["g"] == r["h"] == level, (a, b)


def test_equals_duckdb_on_mutated_words(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for i in range(20_000):
        a = "".join(rng.choice("aeinrstlodc") for _ in range(rng.randint(1, 20)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "z", "st"])
        rows.append((i, a, "".join(b)))
    path = str(tmp_path / "words.parquet")
    pd.DataFrame(rows, columns=["i", "a", "b"]).to_parquet(path)
    want = dict(duckdb.sql(f"SELECT i, jaro_winkler_similarity(a, b) FROM '{path}' WHERE b <> ''").fetchall())
    got = spark.read.parquet(path).where("b <> ''").select("i", jaro_winkler("a", "b").alias("w"))
    assert max(abs(r["w"] - want[r["i"]]) for r in got.collect()) < 1e-12


@pytest.mark.parametrize("threshold", [0.88, 0.92, 0.97])
def test_similar_words_share_a_key(spark, threshold):
    rng = random.Random(9)
    pairs = []
    for _ in range(6000):
        a = "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 18)))
        b = list(a)
        for _ in range(rng.randint(1, 3)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "x", "st"])
        pairs.append((a, "".join(b)))
    df = pairs_frame(spark, pairs).orderBy("i")
    meet = F.arrays_overlap(similarity_keys("a", threshold), similarity_keys("b", threshold))
    got = [r[0] for r in df.select(meet).collect()]
    near = [by_hand(a, b) >= threshold for a, b in pairs]
    starts = {a[:1] == b[:1] for (a, b), n in zip(pairs, near, strict=True) if n}
    assert sum(near) > 500 and starts == {True, False}
    assert all(g for g, n in zip(got, near, strict=True) if n)


@pytest.mark.parametrize("names", ["s i", "p o", "x b", "w m", "k c"])
def test_column_names_do_not_matter(spark, names):
    left, right = names.split()
    df = pairs_frame(spark, [("martha", "marhta")]).withColumnsRenamed({"i": "row", "a": left, "b": right})
    got = df.select(jaro_winkler(left, right), similarity_level(left, right, [0.9]),
                    F.arrays_overlap(similarity_keys(left, 0.9), similarity_keys(right, 0.9))).first()
    assert (round(got[0], 4), got[1], got[2]) == (0.9611, 1, True)
