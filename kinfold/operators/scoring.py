"""Match weight and probability of compared pairs, and the strict match filter."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.training import Model


def match_weight(model: Model) -> Column:
    """log2 of the prior odds plus log2(m/u) per comparison; a null level adds nothing.

    The weights are literal arrays indexed by level, so each level column is read exactly once.
    """
    total = F.lit(model.prior_weight())
    for c in model.comparisons:
        steps = F.array(*[F.lit(w) for w in (0.0, *model.weights(c))])
        total = total + F.get(steps, F.col(c.gamma) + 1)
    return total


def score(gammas: DataFrame, model: Model) -> DataFrame:
    """Add ``match_weight`` and ``match_probability``."""
    weight = match_weight(model)
    return gammas.withColumn("match_weight", weight).withColumn(
        "match_probability", 1.0 / (1.0 + F.pow(F.lit(2.0), -F.col("match_weight")))
    )


def weight_of(probability: float) -> float:
    return math.log2(probability / (1.0 - probability))


def predict(gammas: DataFrame, model: Model, threshold: float = 0.92) -> DataFrame:
    """Scored pairs with at least the given match probability."""
    return score(gammas, model).where(F.col("match_probability") >= threshold)


def is_strict(
    threshold: float = 0.93,
    equal: tuple[str, ...] = ("gender_code", "birth_year"),
    positive: str = "gamma_last_name",
) -> Column:
    """Whether a pair may join one entity: likely, equal where it must be, alike in the last name.

    A null on either side fails the test.
    """
    keep = F.col("match_probability") >= threshold
    for c in equal:
        keep = keep & (F.col(f"{c}_l") == F.col(f"{c}_r"))
    return keep & (F.col(positive) > 0)


def strict_matches(
    predictions: DataFrame,
    threshold: float = 0.93,
    equal: tuple[str, ...] = ("gender_code", "birth_year"),
    positive: str = "gamma_last_name",
) -> DataFrame:
    """The pairs that are strict, see ``is_strict``."""
    return predictions.where(is_strict(threshold, equal, positive))
