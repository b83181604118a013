"""Entities without forming all pairs of a block.

The strict match filter fixes most of a pair: the blocking columns are equal, so are the columns
that must be equal, and the last names are alike. If the model then decides the same whatever the
remaining comparisons say, records that agree in the deciding columns match each other outright.
They are folded into one *group*, over all sources, by an aggregation. Only groups with different
but similar names still have to be compared, and hot blocks of those meet by similarity keys
instead of all with all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.similarity import similarity_keys
from kinfold.operators.blocking import CELL_ROWS, Rule, hot_blocks, join_block
from kinfold.operators.comparison import Comparison, add_letter_bits, compare
from kinfold.operators.scoring import score
from kinfold.operators.training import Model, pattern_bound


MAX_PATTERNS = 100_000


def can_enumerate(model: Model) -> bool:
    """Whether the level patterns of the model are few enough to look at each."""
    return pattern_bound(model.comparisons) <= MAX_PATTERNS


def _patterns(model: Model, equal: Sequence[str], alike: Comparison) -> list[tuple[int, ...]]:
    """Level patterns of pairs that pass the strict filter, but for the probability."""
    choices = []
    for c in model.comparisons:
        if c.column in equal:
            choices.append((c.top,))
        elif c is alike:
            choices.append(tuple(range(1, c.top + 1)))
        else:
            choices.append(tuple(range(-1, c.top + 1)))
    spot = model.comparisons.index(alike)
    return [
        levels
        for levels in product(*choices)
        # comparisons of one column see the same two values: equal for all or for none, never null
        if all(
            (levels[i] == c.top) == (levels[spot] == alike.top) and levels[i] >= 0
            for i, c in enumerate(model.comparisons)
            if c.column == alike.column
        )
    ]


def _matches(model: Model, levels: Sequence[int], threshold: float) -> bool:
    weight = model.prior_weight() + sum(
        model.weights(c)[g] for c, g in zip(model.comparisons, levels, strict=True) if g >= 0
    )
    return 1.0 / (1.0 + 2.0**-weight) >= threshold


def idle_comparisons(
    model: Model, threshold: float, equal: Sequence[str], alike: Comparison
) -> list[Comparison]:
    """Comparisons that cannot change whether a pair that passes the other tests is a match."""
    patterns = _patterns(model, equal, alike)
    decided = {p: _matches(model, p, threshold) for p in patterns}
    idle: list[int] = []
    for i, c in enumerate(model.comparisons):
        if c.column in equal or c.column == alike.column:
            continue
        trial = [*idle, i]
        rest: dict[tuple[int, ...], set[bool]] = {}
        for p, match in decided.items():
            rest.setdefault(tuple(g for j, g in enumerate(p) if j not in trial), set()).add(match)
        if all(len(outcomes) == 1 for outcomes in rest.values()):
            idle = trial
    return [model.comparisons[i] for i in idle]


def twins_match(model: Model, threshold: float, equal: Sequence[str], alike: Comparison) -> bool:
    """Whether two records that agree wherever they have values are always a match."""
    return all(
        _matches(model, p, threshold)
        for p in _patterns(model, equal, alike)
        if all(g in (-1, c.top) for g, c in zip(p, model.comparisons, strict=True))
    )


def fold_groups(
    records: DataFrame, columns: Sequence[str], required: Sequence[str], source: str, id_col: str
) -> DataFrame:
    """One row per combination of ``columns``: smallest id and whether it spans several sources.

    Rows that lack a required value can match nothing and are left out.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*required, source)])
    return (
        records.where(known)
        .groupBy(*columns)
        .agg(
            F.min(id_col).alias("profile_id"),
            F.min(source).alias("first_source"),
            F.max(source).alias("last_source"),
        )
    )


def similar_groups(
    groups: DataFrame,
    block: Rule,
    alike: Comparison,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Pairs of different groups in a block that may have similar values in ``alike``.

    A small block is joined as it is. In a hot block only groups that share a similarity key meet;
    a pair may come up several times there. Keys that are hot in turn are cut into cells.
    """
    hot = hot_blocks(groups, block, cell_rows)
    if hot is None:
        return join_block(groups, block, "profile_id", None)
    keys = list(block)
    small = groups.join(hot.select(*keys), keys, "left_anti")
    large = groups.join(hot.select(*keys), keys, "left_semi").withColumn(
        "_key", F.explode(similarity_keys(alike.column, alike.thresholds[-1]))
    )
    by_key = join_block(large, [*keys, "_key"], "profile_id", cell_rows).drop("_key_l", "_key_r")
    return join_block(small, block, "profile_id", None).unionByName(by_key)


def group_edges(
    groups: DataFrame,
    block: Rule,
    model: Model,
    threshold: float,
    alike: Comparison,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Edges ``src``, ``dst`` between groups that hold matching records of different sources."""
    pairs = similar_groups(add_letter_bits(groups, model.comparisons), block, alike, cell_rows)
    one_source = (
        (F.col("first_source_l") == F.col("last_source_l"))
        & (F.col("first_source_r") == F.col("last_source_r"))
        & (F.col("first_source_l") == F.col("first_source_r"))
    )
    # few names are alike, so this test goes into the join and the rest follows for what is left
    near = pairs.where(~one_source & (alike.level(pairs) > 0))
    gammas = compare(near, model.comparisons, ["profile_id_l", "profile_id_r"])
    scored = score(gammas, model).where(F.col("match_probability") >= threshold)
    return scored.select(
        F.col("profile_id_l").alias("src"), F.col("profile_id_r").alias("dst")
    )


def spread_groups(
    records: DataFrame,
    groups: DataFrame,
    components: DataFrame,
    columns: Sequence[str],
    id_col: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``component`` of every record, beside its id and the ``keep`` columns.

    A group that spans sources or has an edge is one entity, or part of one. Records of any other
    group stay alone: nothing in another source matches them.
    """
    labels = components.withColumnRenamed("vertex", "profile_id")
    spans = F.when(F.col("first_source") < F.col("last_source"), F.col("profile_id"))
    marked = (
        groups.join(labels, "profile_id", "left")
        .select(
            F.coalesce("component", spans).alias("component"),
            *[F.col(c).alias(f"_g_{c}") for c in columns],
        )
        .where(F.col("component").isNotNull())
    )
    on = reduce(lambda a, b: a & b, [records[c].eqNullSafe(marked[f"_g_{c}"]) for c in columns])
    return records.join(marked, on, "left").select(
        id_col, *keep, F.coalesce("component", id_col).alias("component")
    )
