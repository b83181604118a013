import math
import random
from datetime import datetime
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from kinfold.operators import blocking as B
from kinfold.operators.comparison import compare, exact, similar
from kinfold.operators.entities import idle_comparisons, similar_groups, twins_match
from kinfold.operators.scoring import predict, score
from kinfold.operators.training import (
    Model,
    Pattern,
    block_prior,
    estimate_prior,
    fit_m,
    held_out,
    start_m,
    start_u,
    train_u,
)
from kinfold.plans import match as M
from tests.test_similarity import by_hand

PEOPLE = (
    "unique_id string, first_name string, middle_name string, last_name string, "
    "gender_code string, birth_year string, county_desc string"
)


def make_people(n, seed=5, hot=0.35):
    """People with typos, nulls, copies, and one name that holds a third of all rows."""
    rng = random.Random(seed)
    first, last = ["ann", "anna", "bob", "carl", None], ["smith", "smyth", "jones", "lee", None]
    rows = []
    for i in range(n):
        if rng.random() < hot:
            who = ("mary", rng.choice(["", "x"]), "brown", "f", "1980")
        else:
            who = (rng.choice(first), rng.choice(["q", "r", None]), rng.choice(last),
                   rng.choice(["f", "m", None]), rng.choice(["1980", "1981", None]))
        rows.append((f"r_{i:04d}", *who, f"c{rng.randrange(4)}"))
    return rows


def brute_pairs(rows, test):
    """All record pairs of different sources that pass, smaller source first."""
    out = set()
    for a, b in combinations(rows, 2):
        if a[-1] != b[-1]:
            left, right = (a, b) if a[-1] < b[-1] else (b, a)
            if test(left, right):
                out.add((left[0], right[0]))
    return out


def agree(*columns):
    return lambda a, b: all(a[c] is not None and a[c] == b[c] for c in columns)


FIRST, MIDDLE, LAST, GENDER, YEAR = 1, 2, 3, 4, 5


@pytest.mark.parametrize("cell_rows", [5000, 3])
@pytest.mark.parametrize("fold", [True, False])
def test_pairs_equal_brute_force(spark, fold, cell_rows):
    rows = make_people(150)
    people = spark.createDataFrame(rows, PEOPLE)
    columns = ["first_name", "middle_name", "last_name", "gender_code", "birth_year"]
    profiles = B.fold_profiles(people, columns) if fold else B.single_profiles(people)
    rules = [("birth_year", "first_name", "last_name"), ("birth_year", "first_name"),
             ("last_name", "gender_code")]
    pairs = B.candidate_pairs(profiles, rules, cell_rows=cell_rows)
    tests = [agree(YEAR, FIRST, LAST), agree(YEAR, FIRST), agree(LAST, GENDER)]
    want = brute_pairs(rows, lambda a, b: any(t(a, b) for t in tests))
    if fold:
        assert pairs.agg(F.sum("n_pairs")).first()[0] == len(want)
        pairs = B.expand_pairs(pairs, people, profiles)
    ids = ["unique_id_l", "unique_id_r"]
    got = [(r[0], r[1], r[2]) for r in pairs.select(*ids, "match_key").collect()]
    assert len(got) == len(set(got)) == len(want)
    assert {(a, b) for a, b, _ in got} == want
    by_id = {r[0]: r for r in rows}
    for a, b, key in got:
        assert key == next(i for i, t in enumerate(tests) if t(by_id[a], by_id[b]))


def test_copies_fold_to_one_profile_per_source(spark):
    rows = [(f"r{i}", "mary", "x", "brown", "f", "1980", f"c{i % 3}") for i in range(300)]
    people = spark.createDataFrame(rows, PEOPLE)
    profiles = B.fold_profiles(people, ["first_name", "birth_year"])
    assert profiles.count() == 3
    pairs = B.candidate_pairs(profiles, [("birth_year", "first_name")])
    assert pairs.count() == 3
    assert pairs.agg(F.sum("n_pairs")).first()[0] == 3 * 100 * 100


def test_hot_blocks_are_cut_without_loss(spark):
    rows = [(f"r{i:03d}", "mary", f"m{i}", "brown", "f", "1980", f"c{i % 2}") for i in range(200)]
    profiles = B.single_profiles(spark.createDataFrame(rows, PEOPLE))
    whole = B.candidate_pairs(profiles, [("birth_year", "first_name")])
    cells = B.candidate_pairs(profiles, [("birth_year", "first_name")], cell_rows=20)
    assert whole.count() == cells.count() == 100 * 100
    pair = ["profile_id_l", "profile_id_r"]
    assert whole.select(pair).exceptAll(cells.select(pair)).isEmpty()


def test_prior_counts(spark):
    rows = make_people(120)
    people = spark.createDataFrame(rows, PEOPLE)
    found = estimate_prior(people, [("first_name", "birth_year"), ("last_name",)], 0.7).first()
    either = lambda a, b: agree(FIRST, YEAR)(a, b) or agree(LAST)(a, b)
    possible = len(brute_pairs(rows, lambda a, b: True))
    assert found["rule_pairs"] == len(brute_pairs(rows, either))
    assert found["possible_pairs"] == possible
    assert found["prior"] == pytest.approx(min(found["rule_pairs"] / 0.7 / possible, 1))
    one = spark.createDataFrame([r for r in rows if r[-1] == "c1"], PEOPLE)
    assert estimate_prior(one, [("last_name",)], 0.7).first()["prior"] == 0


def test_start_values():
    assert start_m(2) == pytest.approx([0.05, 0.95])
    for n in (2, 3, 4):
        u = start_u(n)
        assert sum(u) == pytest.approx(1) and sum(start_m(n)) == pytest.approx(1)
        steps = [math.log2(a / b) for a, b in zip(start_m(n), u, strict=True)]
        gaps = [b - a for a, b in zip(steps, steps[1:])]
        assert gaps == pytest.approx([15 / (n - 1)] * (n - 1))


COMPARISONS = (similar("a", [0.9]), exact("b"), exact("k"))


def test_em_likelihood_never_falls_and_finds_the_mixture():
    rng = random.Random(1)
    counts = {}
    for _ in range(20_000):
        match = rng.random() < 0.3
        a = rng.choices([0, 1, 2], [0.1, 0.2, 0.7] if match else [0.9, 0.07, 0.03])[0]
        b = rng.choices([-1, 0, 1], [0.1, 0.1, 0.8] if match else [0.1, 0.7, 0.2])[0]
        counts[a, b] = counts.get((a, b), 0) + 1
    patterns = [Pattern(levels, n) for levels, n in sorted(counts.items())]
    model = Model.start(COMPARISONS, 0.1)
    u = {**model.u, "gamma_a": [0.9, 0.07, 0.03], "gamma_b": [0.7 / 0.9, 0.2 / 0.9]}
    model = Model(COMPARISONS, 0.1, model.m, u)
    fitted, prior, history = fit_m(patterns, COMPARISONS[:2], model, 0.1, 100, 1e-7)
    assert all(b >= a - 1e-6 for a, b in zip(history, history[1:]))
    assert prior == pytest.approx(0.3, abs=0.02)
    assert fitted.m["gamma_a"] == pytest.approx([0.1, 0.2, 0.7], abs=0.03)
    assert fitted.m["gamma_k"] == model.m["gamma_k"]


def test_training_block_columns_are_held_out():
    skipped = held_out(M.PERSON_COMPARISONS, M.TRAINING_RULE)
    assert [c.gamma for c in skipped] == [
        "gamma_last_name_exact", "gamma_last_name", "gamma_birth_year"]
    model = Model.start(M.PERSON_COMPARISONS, 0.01)
    assert 0.01 < block_prior(model, M.TRAINING_RULE) < 1


def test_u_from_random_pairs(spark):
    rng = random.Random(2)
    rows = [(f"r{i}", rng.choice("ab"), f"c{i % 3}") for i in range(3000)]
    records = spark.createDataFrame(rows, "unique_id string, b string, county_desc string")
    model = train_u(records, Model.start([exact("b")], 0.1), 3000, 5)
    assert model.u["gamma_b"] == pytest.approx([0.5, 0.5], abs=0.03)


def test_probability_rises_with_every_level(spark):
    model = Model.start(COMPARISONS, 0.01)
    rows = [(a, b, 1) for a in (-1, 0, 1, 2) for b in (-1, 0, 1)]
    df = spark.createDataFrame(rows, "gamma_a int, gamma_b int, gamma_k int")
    got = {(r["gamma_a"], r["gamma_b"]): r for r in score(df, model).collect()}
    for b in (-1, 0, 1):
        assert got[0, b]["match_probability"] < got[1, b]["match_probability"] < got[2, b]["match_probability"]
    weight = model.prior_weight() + model.weights(COMPARISONS[2])[1]
    assert got[-1, -1]["match_weight"] == pytest.approx(weight)
    kept = predict(df, model, 0.5)
    assert {r["match_probability"] >= 0.5 for r in kept.collect()} == {True}


def test_comparison_names_must_differ(spark):
    df = spark.createDataFrame([("x", "y")], "a_l string, a_r string")
    with pytest.raises(ValueError):
        compare(df, [exact("a"), exact("a")], [])
    assert tuple(compare(df, [exact("a"), exact("a", "again")], []).first()) == (0, 0)


def test_scores_do_not_touch_python_and_keep_the_keys(spark):
    people = M.normalise_people(spark.createDataFrame(make_people(30), PEOPLE))
    settings = M.MatchSettings()
    gammas = M.compare_candidates(M.build_profiles(people, settings), settings)
    plan = predict(gammas, Model.start(M.PERSON_COMPARISONS, 0.01))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


TWO_RULES = (("birth_year", "first_name"), ("birth_year", "last_name"))


@pytest.mark.parametrize(
    ("empty_as_null", "cell_rows", "rules"),
    [
        (True, 5000, M.PERSON_RULES),
        (False, 5000, M.PERSON_RULES),
        (True, 2, M.PERSON_RULES),  # every block is hot: groups meet by similarity keys
        (True, 5000, TWO_RULES),  # compared profile by profile
    ],
)
def test_flow_equals_brute_force(spark, empty_as_null, cell_rows, rules):
    """Golden ids equal those from every single pair of records."""
    rows = make_people(160, seed=8)
    records = spark.createDataFrame(rows, PEOPLE)
    settings = M.MatchSettings(empty_as_null=empty_as_null, cell_rows=cell_rows, rules=rules)
    result = M.match_records(records, datetime(2024, 1, 1), settings)
    model = result.model

    def view(r):
        none = (lambda x: x or None) if empty_as_null else (lambda x: x)
        names = [none(r[i] or "") for i in (FIRST, MIDDLE, LAST)]
        full = " ".join(" ".join(x for x in names if x).split())
        return dict(zip(("first_name", "middle_name", "last_name"), names)) | {
            "full_name": none(full), "gender_code": r[GENDER], "birth_year": r[YEAR]}

    def level(c, a, b):
        x, y = a[c.column], b[c.column]
        if x is None or y is None:
            return -1
        return c.top if x == y else sum(by_hand(str(x), str(y)) >= t for t in c.thresholds)

    def matches(a, b):
        a, b = view(a), view(b)
        if not any(all(a[c] is not None and a[c] == b[c] for c in rule) for rule in rules):
            return False
        levels = {c.gamma: level(c, a, b) for c in model.comparisons}
        w = model.prior_weight() + sum(
            model.weights(c)[levels[c.gamma]] for c in model.comparisons if levels[c.gamma] >= 0)
        return (1 / (1 + 2**-w) >= 0.93 and a["gender_code"] is not None
                and a["gender_code"] == b["gender_code"] and levels["gamma_last_name"] > 0)

    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    want_pairs = brute_pairs(rows, matches)
    for a, b in want_pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    heads = sorted({find(r[0]) for r in rows})
    want = {r[0]: heads.index(find(r[0])) + 1 for r in rows}
    got = {r["unique_id"]: r["golden_id"] for r in result.golden.collect()}
    assert len(want_pairs) > 50 and got == want
    assert result.matches.agg(F.sum("n_pairs")).first()[0] == len(want_pairs)
    expanded = B.expand_pairs(result.matches, M.normalise_people(records, empty_as_null), result.profiles)
    assert {(r[0], r[1]) for r in expanded.select("unique_id_l", "unique_id_r").collect()} == want_pairs
    metrics = {r["metric"]: r["value"] for r in result.metrics.collect()}
    assert metrics["records"] == 160 and metrics["golden_ids"] == len(heads)


def test_idle_comparisons():
    alike = M.PERSON_COMPARISONS[3]
    block = ["birth_year", "first_name", "gender_code"]
    model = Model.start(M.PERSON_COMPARISONS, 0.01)
    idle = idle_comparisons(model, 0.93, block, alike)
    assert [c.gamma for c in idle] == ["gamma_middle_name", "gamma_full_name"]
    assert twins_match(model, 0.93, block, alike)
    # with a tiny prior the middle name decides, and twins without one do not match
    strict = Model.start(M.PERSON_COMPARISONS, 1e-9)
    low = idle_comparisons(strict, 1 - 1e-5, block, alike)
    assert [c.gamma for c in low] != ["gamma_middle_name", "gamma_full_name"]


def test_similar_groups_meet_in_hot_blocks(spark):
    """Every pair of similar names of a hot block is found, and none outside of its block."""
    rng = random.Random(6)
    names = set()
    for _ in range(80):
        word = "".join(rng.choice("aeinrstlodcm") for _ in range(rng.randint(4, 9)))
        names.add(word)
        for _ in range(4):
            k = rng.randrange(len(word))
            names.add(word[:k] + rng.choice(["", "x", word[k] * 2]) + word[k + 1 :])
    names = sorted(names)
    rng.shuffle(names)
    rows = [(n, f"b{i % 2}", f"g{i:04d}") for i, n in enumerate(names)]
    groups = spark.createDataFrame(rows, "last_name string, block string, profile_id string")
    alike = similar("last_name", [0.97, 0.92])
    got = similar_groups(groups, ["block"], alike, cell_rows=50)
    found = {(r["profile_id_l"], r["profile_id_r"]) for r in got.collect()}
    want = {
        (a[2], b[2]) for a, b in combinations(rows, 2) if a[1] == b[1] and by_hand(a[0], b[0]) >= 0.92
    }
    assert len(want) > 20 and want <= found
    assert len(found) < len(rows) ** 2 / 16
    whole = similar_groups(groups, ["block"], alike).select("profile_id_l", "profile_id_r")
    assert whole.count() == 2 * math.comb(len(rows) // 2, 2) + (len(rows) % 2) * (len(rows) // 2)


def test_load_records(spark):
    rows = make_people(20)
    frames = [spark.createDataFrame(rows[:10], PEOPLE), spark.createDataFrame([(None, *r[1:]) for r in rows[10:]], PEOPLE)]
    got = M.load_records(frames, datetime(2024, 1, 1))
    assert got.count() == 10 and got.columns[-1] == "pipeline_run_timestamp"
    assert M.load_records(frames, datetime(2024, 1, 1), M.MatchSettings(sample_size=4)).count() == 4
