"""Comparisons: which columns of a pair are compared, and how finely."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.similarity import letter_bits, similarity_level


@dataclass(frozen=True)
class Comparison:
    """One compared column; without thresholds only equality counts.

    Levels run from -1 (a side is null) over 0 (different) to ``top`` (equal).
    """

    column: str
    thresholds: tuple[float, ...] = ()
    name: str = ""

    @property
    def gamma(self) -> str:
        return f"gamma_{self.name or self.column}"

    @property
    def top(self) -> int:
        return len(self.thresholds) + 1

    @property
    def bits(self) -> str:
        return f"_bits_{self.column}"

    @property
    def known(self) -> str:
        """Name of the level where it was taken together with the pairs."""
        cuts = "".join(f"_{t!r}".replace(".", "p") for t in self.thresholds)
        return f"_known_{self.gamma}_of_{self.column}{cuts}"

    def level(self, pairs: DataFrame) -> Column:
        if self.known in pairs.columns:
            return F.col(self.known)
        left, right = f"{self.column}_l", f"{self.column}_r"
        if self.thresholds:
            bits = (f"{self.bits}_l", f"{self.bits}_r")
            known = bits[0] in pairs.columns
            return similarity_level(left, right, self.thresholds, bits if known else None)
        return F.expr(
            f"CASE WHEN `{left}` IS NULL OR `{right}` IS NULL THEN -1"
            f" WHEN `{left}` = `{right}` THEN 1 ELSE 0 END"
        )


def exact(column: str, name: str = "") -> Comparison:
    return Comparison(column, (), name)


def similar(column: str, thresholds: Sequence[float], name: str = "") -> Comparison:
    return Comparison(column, tuple(sorted(thresholds, reverse=True)), name)


def compared_columns(comparisons: Sequence[Comparison]) -> list[str]:
    return list(dict.fromkeys(c.column for c in comparisons))


def add_letter_bits(df: DataFrame, comparisons: Sequence[Comparison]) -> DataFrame:
    """Per-record letter bits that let most pairs be dismissed without a character loop."""
    fuzzy = dict.fromkeys((c.column, c.bits) for c in comparisons if c.thresholds)
    return df.select("*", *[letter_bits(column).alias(bits) for column, bits in fuzzy])


def compare(
    pairs: DataFrame, comparisons: Sequence[Comparison], keep: Sequence[str]
) -> DataFrame:
    """The ``keep`` columns and one level per comparison.

    Only integers and ids leave this step; the compared texts are pruned from what follows unless
    they are kept on purpose. The levels are produced as one inlined struct: a filter on them, such
    as a score threshold, is then not pushed below and does not compute them a second time, while
    filters on the kept columns still reach the join. They are computed by a projection below it, which
    Spark compiles; inside the generator they would be interpreted. Levels that came with the pairs are
    taken as they are.
    """
    names = [c.gamma for c in comparisons]
    if len(set(names)) != len(names):
        raise ValueError(f"two comparisons share a name: {names}")
    if all(c.known in pairs.columns for c in comparisons):
        return pairs.select(*keep, *[F.col(c.known).alias(c.gamma) for c in comparisons])
    found = pairs.select(*keep, *[c.level(pairs).alias(f"_{c.gamma}") for c in comparisons])
    levels = F.struct(*[F.col(f"_{c.gamma}").alias(c.gamma) for c in comparisons])
    return found.select(*keep, F.inline(F.array(levels)))
