import pytest
from pyspark.sql import functions as F

from kinfold.functions import text as T
from kinfold.operators.cleaning import VOTER_RULES, apply_cleaning, clean_voters
from kinfold.operators.mapping import (
    LINKAGE_COLUMNS,
    apply_mapping,
    drop_null_ids,
    mapping_problems,
    select_columns,
    union_all_by_name,
)


def each(frame, values, function):
    """Apply a text function to every value, in order."""
    df = frame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_strip(frame):
    assert each(frame, ["  a b ", "\ta\n", "\xa0x ", "\x1cx\x1f", "", None], T.strip) == [
        "a b", "a", "x", "x", "", None]


def test_null_tokens(frame):
    assert each(frame, ["", "na", "banana", "null", "nan", "none", "x", None], T.null_if_token) == [
        None, None, "banana", None, None, None, "x", None]


def test_titles(frame):
    assert each(frame, ["mr bob", "mrs. x", "dr dr z", "ms", "drake", "ms  ann"], T.remove_title) == [
        "bob", "mrs. x", "dr z", "ms", "drake", "ann"]


def test_alpha_only(frame):
    assert each(frame, ["o'brien", "josé", "anne-marie", "123", "a b", None], T.alpha_only) == [
        "obrien", "jos", "annemarie", None, "a b", None]


def test_numbers(frame):
    given = ["1e3", " 12 ", "0x1F", "-inf", "1_000", "12d", "nan", None, "-5", "1,000", ".5", "7.", "x"]
    assert each(frame, given, T.to_number) == [
        1000.0, 12.0, None, float("-inf"), None, None, None, None, -5.0, None, 0.5, 7.0, None]


def test_years(frame):
    given = ["1980", "99999", "1980.5", "-1", None]
    assert each(frame, given, lambda c: T.to_short_year(T.to_number(c))) == [
        1980, None, None, -1, None]
    assert each(frame, ["inf"], lambda c: T.to_short_year(T.to_number(c))) == [None]


def test_extract(frame):
    zip5 = lambda c: T.extract_first(c, r"([0-9]{5})")
    assert each(frame, ["x27601-1234y", "nope", None], zip5) == ["27601", None, None]


def test_names(frame):
    df = frame([("ann", None, " lee "), (None, None, None), ("a", "b  c", "d")],
               "f string, m string, l string")
    got = df.select(T.full_name(F.col("f"), F.col("m"), F.col("l")), T.first_initial(F.col("f")))
    assert [tuple(r) for r in got.collect()] == [("ann lee", "a"), ("", ""), ("a b c d", "a")]


def test_rules_in_order(frame):
    df = frame([("  MR Bob1 ", "N/A", " 42 ")], "name string, other string, n string")
    rules = {
        "global": {"strip": True, "lowercase": True, "null_values": ["n/a"]},
        "columns": {
            "name": {"remove_titles": True, "alpha_only": True},
            "n": {"type": "numeric", "extract_regex": r"(\d)\d"},
            "absent": {"alpha_only": True},
        },
    }
    assert tuple(apply_cleaning(df, rules).first()) == ("bob", None, 4.0)
    assert tuple(apply_cleaning(df, {"columns": {}}).first()) == ("  MR Bob1 ", "N/A", " 42 ")
    with pytest.raises(ValueError):
        apply_cleaning(df, {"global": {}})


def test_cleaning_is_one_narrow_stage(frame):
    plan = apply_cleaning(frame([("a",)], "first_name string"), VOTER_RULES)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text


def test_clean_voters(frame):
    df = frame([("Dr Ann", "null", "O'Neil", "F", "1980", " Town ", "NC 27601-1", "Wake")],
               ", ".join(f"{c} string" for c in LINKAGE_COLUMNS))
    assert tuple(clean_voters(df).first()) == (
        "ann", None, "oneil", "f", 1980.0, "town", "27601", "wake")
    with pytest.raises(ValueError, match="zip_code"):
        clean_voters(df.drop("zip_code"))


def test_mapping(frame):
    df = frame([(1, 2, 3)], "a int, b int, `c.d` int")
    assert apply_mapping(df, {"x": "a", "y": "a", "b": "c.d"}).columns == ["x", "y", "b"]
    assert tuple(apply_mapping(df, {"a": "b", "b": "a"}).first()) == (2, 1)
    assert tuple(apply_mapping(df).first()) == (1, 2, 3)
    with pytest.raises(ValueError, match="nope"):
        apply_mapping(df, {"x": "nope"})
    for wrong in ({}, [], {"a": 1}, {1: "a"}):
        assert len(mapping_problems(wrong, df.schema)) == 1
        with pytest.raises(ValueError):
            apply_mapping(df, wrong)
    assert mapping_problems({"x": "a", "y": "a"}, df.schema) == []
    several = mapping_problems({"x": "nope", "X": "b", "y": 1}, df.schema)
    assert len(several) == 4 and "nope" in several[0] and "case" in several[1]
    with pytest.raises(ValueError, match="zip_code"):
        select_columns(df)


def test_union_and_null_ids(frame):
    both = union_all_by_name([frame([("1", 2)], "unique_id string, b int"),
                              frame([(None, 4)], "unique_id string, c int")])
    assert both.columns == ["unique_id", "b", "c"]
    assert [tuple(r) for r in drop_null_ids(both).collect()] == [("1", 2, None)]
    with pytest.raises(ValueError):
        union_all_by_name([])
