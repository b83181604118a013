"""Jaro-Winkler similarity as a column expression (Winkler 1990).

Where most pairs need it, the measure and the letter bits are taken from whole Arrow batches
(``pairwise``). For levels above 0.8 plain built-in functions bound the result first, so few pairs are left;
for these the loop over characters is a higher-order function and no Python worker sees the pairs. The
expressions are written as SQL text, which Spark parses in one call; they take column names. Lambda
variables start with an underscore so that they do not hide a column.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from kinfold.functions import pairwise
from kinfold.functions.measure import (
    BOOST_ABOVE,
    PREFIX_LENGTH,
    PREFIX_WEIGHT,
    SLACK,
)
from kinfold.functions.measure import needed as _needed

_USED = "'\\u0001'"  # marks a character of the second string that is already matched
_FAR_FROM = 0.8  # below, the edit distance rules out too few pairs
_SHARED_STARTS = (16, 12, 8, 6, 4, 3, 2, 1)


def _name(column: str) -> str:
    return ".".join(f"`{part}`" for part in column.split("."))


def _shared_start(a: str, b: str, choices: dict[int, object], other: object) -> str:
    """CASE over the length of the shared start of two different strings, longest first."""
    tests = " ".join(
        f"WHEN substr({a}, 1, {n}) = substr({b}, 1, {n}) THEN {value}"
        for n, value in sorted(choices.items(), reverse=True)
    )
    return f"CASE {tests} ELSE {other} END"


def _prefix(a: str, b: str) -> str:
    return _shared_start(a, b, {n: n for n in range(1, PREFIX_LENGTH + 1)}, 0)


def _jaro(a: str, b: str) -> str:
    """Jaro similarity of two different non-empty strings.

    Each character of a shared start matches its own position, so the loop begins behind it. Only
    the head of the second string is searched, which keeps a match inside the window.
    """
    skip = _shared_start(a, b, {n: n for n in _SHARED_STARTS}, 0)
    char = f"substr({a}, _i, 1)"
    at = f"locate({char}, substr(_s.rest, 1, _i + _p.reach), greatest(1, _i - _p.reach))"
    matched_in_b = (
        f"array_join(transform(sequence(_p.skip + 1, length({b})),"
        f" _i -> if(substr(_s.rest, _i, 1) = {_USED}, substr({b}, _i, 1), '')), '')"
    )
    moved = (
        "size(filter(sequence(1, length(_s.hits)),"
        " _i -> substr(_s.hits, _i, 1) <> substr(_o, _i, 1))) div 2"
    )
    m = "(_p.skip + length(_s.hits))"
    sides = f"{m} / length({a}) + {m} / length({b})"
    return f"""get(transform(
      array(struct({skip} AS skip,
        int(greatest(greatest(length({a}), length({b})) div 2 - 1, 0)) AS reach)),
      _p -> aggregate(
        if(_p.skip = length({a}), cast(array() AS array<int>), sequence(_p.skip + 1, length({a}))),
        struct(
          if(_p.skip = 0, {b}, concat(repeat({_USED}, _p.skip), substr({b}, _p.skip + 1))) AS rest,
          '' AS hits),
        (_s, _i) -> if({at} > 0,
          struct(overlay(_s.rest PLACING {_USED} FROM {at} FOR 1) AS rest,
                 concat(_s.hits, {char}) AS hits),
          _s),
        _s -> CASE
          WHEN {m} = 0 THEN 0D
          WHEN _s.hits = '' THEN ({sides} + 1D) / 3D
          ELSE get(transform(array({matched_in_b}),
            _o -> ({sides} + ({m} - if(_s.hits = _o, 0, {moved})) / {m}) / 3D), 0)
        END)), 0)"""


def _different(a: str, b: str) -> str:
    """Jaro-Winkler similarity of two different non-empty strings."""
    return (
        f"get(transform(array({_jaro(a, b)}), _j -> if(_j > {BOOST_ABOVE}D,"
        f" _j + ({_prefix(a, b)}) * {PREFIX_WEIGHT}D * (1D - _j), _j)), 0)"
    )


def _measured(left: pa.Array, right: pa.Array) -> pa.Array:
    """Similarity of different, non-empty strings; null if either is null."""
    known = left.is_valid().to_numpy(zero_copy_only=False)
    known &= right.is_valid().to_numpy(zero_copy_only=False)
    at, out = np.flatnonzero(known), np.zeros(len(known))
    out[at] = pairwise.jaro_winkler(pairwise.Words(left), pairwise.Words(right), at, at)
    return pa.array(out, mask=~known)


def _bits_of(texts: pa.Array) -> pa.Array:
    unknown = texts.is_null().to_numpy(zero_copy_only=False)
    return pa.array(pairwise.Words(texts).letter_bits(), mask=unknown)


_measure = F.arrow_udf(_measured, DoubleType())
_count_letters = F.arrow_udf(_bits_of, LongType())


def _measure_where(test: str, a: str, b: str) -> Column:
    """The measure of the pairs that pass ``test``, which must be different, non-empty strings.

    The texts of other pairs are not sent to the workers.
    """
    return _measure(*[F.expr(f"CASE WHEN {test} THEN {text} END") for text in (a, b)])


def jaro_winkler(left: str, right: str) -> Column:
    """Jaro-Winkler similarity in [0, 1]; null if either side is null, 0 if either is empty."""
    a, b = _name(left), _name(right)
    return (
        F.when(F.expr(f"{a} IS NULL OR {b} IS NULL"), None)
        .when(F.expr(f"{a} = '' OR {b} = ''"), 0.0)
        .when(F.expr(f"{a} = {b}"), 1.0)
        .otherwise(_measure_where(f"{a} <> '' AND {b} <> '' AND {a} <> {b}", a, b))
    )


def letter_bits(column: str) -> Column:
    """Which letters occur (bits 0-20), which twice or more (bits 21-41) and which three times or more.

    The last five letters count with the first five, so that all fit a long. Computed once per record,
    they let :func:`similarity_level` bound a pair by bit operations.
    """
    return _count_letters(F.expr(_name(column)))


def _share(a: str, b: str, threshold: float) -> str:
    """``_needed`` by the shared start of two different strings."""
    shares = {p: f"{_needed(threshold, p)!r}D" for p in range(PREFIX_LENGTH + 1)}
    return _shared_start(a, b, shares, shares.pop(0))


def _most(a: str, b: str, bits_a: str, bits_b: str) -> str:
    """An upper bound of the number of matches of two strings.

    A letter that the other string lacks, or has less often, stays unmatched.
    """
    return (
        f"least(length({a}) - bit_count({bits_a} & ~{bits_b}), length({b}) - bit_count({bits_b} & ~{bits_a}))"
    )


def _out_of_reach(a: str, b: str, most: str, share: str) -> str:
    """True only if two different strings with ``most`` matches certainly stay below a threshold."""
    return f"{most} * (length({a}) + length({b})) < ({share}) * length({a}) * length({b})"


def _too_far(a: str, b: str, most: str, share: str) -> str:
    """True only if the edit distance of two different strings keeps them below a threshold.

    Matches in their order in ``a`` and in ``b`` are an alignment: its cost is |a| + |b| - 2m and one for each
    of the at most 2t + 1 matches that differ there, t the transpositions. The similarity needs
    t <= m (m/|a| + m/|b| - share). The bound is convex in m, so the ends of m's range suffice; as t is
    whole, it is rounded down for the largest m, and the range ends at the next one.
    """
    la, lb = f"length({a})", f"length({b})"
    both = f"(1D / {la} + 1D / {lb})"
    moved = lambda m: f"{m} * ({m} * {both} - ({share}))"
    fewest = f"-2D * ({share}) / {both}"
    at_most = f"2D * floor({moved(most)} + {SLACK!r}D) - 2D * {most}"
    one_less = f"2D * {moved(f'({most} - 1)')} - 2D * ({most} - 1)"
    cap = f"int(floor({la} + {lb} + 1 + greatest({fewest}, {at_most}, {one_less}) + {SLACK!r}D))"
    return f"levenshtein({a}, {b}, {cap}) < 0"


def similarity_level(
    left: str,
    right: str,
    thresholds: Sequence[float],
    bits: tuple[str, str] | None = None,
) -> Column:
    """Comparison level: -1 null, 0 below every threshold, one more per threshold, top if equal.

    Equality is tested first and hopeless pairs are dismissed, by their letters and, from a threshold of 0.8
    on, by their edit distance, which is compiled code, so only the pairs in between pay for the full
    measure. Name ``letter_bits`` columns computed per record if they are at hand.
    """
    a, b = _name(left), _name(right)
    rising = sorted(thresholds)
    share = _share(a, b, rising[0])
    ranks = list(enumerate(rising, 1))[::-1]
    far = bits and rising[0] >= _FAR_FROM
    if not far:  # the measure is taken of most pairs; dearer bounds would cost more than they spare
        reach = f"{a} <> '' AND {b} <> '' AND {a} <> {b}"
        if bits:
            reach += f" AND NOT {_out_of_reach(a, b, _most(a, b, *map(_name, bits)), share)}"
        similarity = _measure_where(reach, a, b)
        graded = F.when(F.expr(f"{a} IS NULL OR {b} IS NULL"), -1).when(
            F.expr(f"{a} = {b}"), len(rising) + 1
        )
        for rank, cut in ranks:
            graded = graded.when(similarity >= cut, rank)
        return graded.otherwise(0)
    most = _most(a, b, *map(_name, bits))
    graded = " ".join(f"WHEN _w >= {cut!r}D THEN {rank}" for rank, cut in ranks)
    return F.expr(
        f"""CASE WHEN {a} IS NULL OR {b} IS NULL THEN -1
             WHEN {a} = {b} THEN {len(rising) + 1}
             WHEN {a} = '' OR {b} = '' THEN 0
             WHEN {_out_of_reach(a, b, most, share)} THEN 0
             WHEN {_too_far(a, b, most, share)} THEN 0
             ELSE get(transform(array({_different(a, b)}), _w -> CASE {graded} ELSE 0 END), 0)
            END"""
    )


def similarity_keys(column: str, threshold: float) -> Column:
    """Keys such that any two strings with at least this similarity share one, for equi-joins.

    Strings that share their first two characters meet there. Others get little or no boost for
    their start, so they have almost all characters in common: each names the selections of its
    sorted characters that a partner of a given length must contain too. Equal strings also meet.
    Where such selections would be too many, strings meet by the two lengths alone.
    """
    text = _name(column)

    def shorter(words: str) -> str:
        """All words with one more character left out."""
        return (
            f"array_distinct(flatten(transform({words}, _w -> transform(sequence(1, length(_w)),"
            " _i -> concat(substr(_w, 1, _i - 1), substr(_w, _i + 1))))))"
        )

    one = shorter("array(_x.letters)")
    two = shorter(one)
    few = f"CASE _x.n - _m WHEN 0 THEN array(_x.letters) WHEN 1 THEN {one} ELSE {two} END"
    classes = []
    for prefix in (0, 1):
        need = _needed(threshold, prefix)
        if need <= 1:
            raise ValueError(f"{threshold} is too low for similarity keys")
        start = f"concat_ws('|', 'p{prefix}', substr({text}, 1, {prefix}), least(_x.n, _b), greatest(_x.n, _b)"
        keys = f"""if(_m > least(_x.n, _b), cast(array() AS array<string>),
            if(greatest(_x.n, _b) - _m > 2, array({start})),
               transform({few}, _k -> {start}, _k))))"""
        classes.append(
            f"""flatten(transform(
              sequence(greatest(1, int(ceil(_x.n * {need - 1!r}D))), int(floor(_x.n / {need - 1!r}D))),
              _b -> get(transform(array(int(ceil({need!r}D * _x.n * _b / (_x.n + _b)))), _m -> {keys}), 0)))"""
        )
    sorted_letters = f"array_join(array_sort(filter(split({text}, ''), _c -> _c <> '')), '')"
    return F.expr(
        f"""CASE WHEN {text} IS NULL OR {text} = '' THEN cast(array() AS array<string>)
          ELSE get(transform(
            array(struct({sorted_letters} AS letters, length({text}) AS n)),
            _x -> concat(array(concat('p2|', substr({text}, 1, 2))), {", ".join(classes)})), 0) END"""
    )
