"""Rule-driven cleaning of whole tables.

Rules are a plain dict::

    {"global": {"strip": True, "lowercase": True, "null_values": [...]},
     "columns": {"name": {"remove_titles": True, "alpha_only": True},
                 "year": {"type": "numeric"}, "zip": {"extract_regex": r"(\\d{5})"}}}

All rules compile to one ``select``, so cleaning is a single narrow stage without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions import text as T

NAME_COLUMNS = ("first_name", "middle_name", "last_name")

# The preset rules for voter files.
VOTER_RULES: dict[str, Any] = {
    "global": {"strip": True, "lowercase": True, "null_values": list(T.NULL_TOKENS)},
    "columns": {
        **{name: {"remove_titles": True, "alpha_only": True} for name in NAME_COLUMNS},
        "birth_year": {"type": "numeric"},
        "zip_code": {"extract_regex": r"([0-9]{5})"},
    },
}


def _for_all(value: Column, rules: Mapping[str, Any]) -> Column:
    value = value.cast("string")
    if rules.get("strip"):
        value = T.strip(value)
    if rules.get("lowercase"):
        value = F.lower(value)
    tokens = rules.get("null_values")
    if isinstance(tokens, str):
        tokens = [tokens]
    return T.null_if_token(value, list(tokens)) if tokens else value


def _for_one(value: Column, rules: Mapping[str, Any]) -> Column:
    if rules.get("remove_titles"):
        value = T.remove_title(value)
    if rules.get("alpha_only"):
        value = T.alpha_only(value)
    # the pattern needs the text, so it comes before the conversion
    if "extract_regex" in rules:
        value = T.extract_first(value, rules["extract_regex"])
    if rules.get("type") == "numeric":
        value = T.to_number(value)
    return value


def cleaning_columns(
    df: DataFrame, rules: Mapping[str, Any], columns: Sequence[str]
) -> list[Column]:
    """The cleaning of ``columns`` as expressions, to be selected beside others."""
    if not isinstance(rules, Mapping) or not isinstance(rules.get("columns"), Mapping):
        raise ValueError("cleaning rules need a 'columns' section")
    for_all, for_one = rules.get("global", {}), rules["columns"]
    return [
        _for_one(_for_all(df[f"`{name}`"], for_all), for_one.get(name, {})).alias(name)
        for name in columns
    ]


def apply_cleaning(df: DataFrame, rules: Mapping[str, Any]) -> DataFrame:
    """Clean every column by the global rules, then the listed columns by their own.

    Columns named in the rules but absent from ``df`` are ignored.
    """
    return df.select(*cleaning_columns(df, rules, df.columns))


def clean_voters(df: DataFrame) -> DataFrame:
    """The fixed voter cleaning; all three names, birth year and ZIP code must be there."""
    missing = [c for c in VOTER_RULES["columns"] if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for voter cleaning: {missing}")
    return apply_cleaning(df, VOTER_RULES)
