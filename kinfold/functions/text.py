"""Scalar cleaning functions; every one is a plain Column expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# Honorifics dropped from the start of a name.
TITLES = ("mr", "mrs", "ms", "dr")
# Tokens that stand for a missing value.
NULL_TOKENS = ("", "nan", "none", "null", "na")

_SPACE = f"[{WHITE_SPACE}]"
_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def strip(text: Column) -> Column:
    """Remove white space at both ends, Unicode spaces included."""
    return F.trim(text, F.lit(WHITE_SPACE))


def null_if_token(text: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null where the whole value is one of ``tokens``."""
    return F.when(~text.isin(list(tokens)), text) if tokens else text


def remove_title(text: Column) -> Column:
    """Drop one leading honorific followed by white space."""
    return F.regexp_replace(text, f"^({'|'.join(TITLES)}){_SPACE}+", "")


def alpha_only(text: Column) -> Column:
    """Keep lower-case ASCII letters and white space; null if nothing is left."""
    return F.nullif(F.regexp_replace(text, f"[^a-z{WHITE_SPACE}]", ""), F.lit(""))


def to_number(text: Column) -> Column:
    """Double, or null where the text is not a plain decimal number."""
    bare = strip(text)
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def to_short_year(number: Column) -> Column:
    """16-bit integer; null if out of range or with a fraction."""
    value = number.try_cast("double")
    return F.when(value == F.floor(value), value.try_cast("smallint"))


def extract_first(text: Column, pattern: str) -> Column:
    """Group 1 of the first match, else null."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def collapse_spaces(text: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return strip(F.regexp_replace(text, f"{_SPACE}+", " "))


def full_name(first: Column, middle: Column, last: Column) -> Column:
    """The given name parts in order, missing parts left out."""
    return collapse_spaces(F.concat_ws(" ", first, middle, last))


def first_initial(name: Column) -> Column:
    """First character, or an empty string."""
    return F.coalesce(F.substring(name, 1, 1), F.lit(""))


def null_to_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
