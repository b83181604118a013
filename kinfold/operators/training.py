"""Parameters of the Fellegi-Sunter model: prior, m and u.

Fellegi & Sunter 1969; EM after Dempster, Laird & Rubin 1977 and Winkler 1988. Spark reduces the
pairs to counts per level pattern. The number of patterns is bounded by the levels of the
comparisons, not by the data, so the iterations run over that small table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.blocking import CELL_ROWS, Rule, join_block
from kinfold.operators.comparison import Comparison, add_letter_bits, compare, compared_columns
from kinfold.operators.identity import number_in_order, sample_exactly
from kinfold.operators.pattern_counts import pattern_counts
from kinfold.session import materialize

# Start values of the model for levels that no training has touched.
START_M_EXACT = 0.95
START_WEIGHTS = (-5.0, 10.0)
FLOOR = 1e-10
TUPLE_CELL_ROWS = 1000  # of a block whose pairs are all compared
MAX_PATTERNS = 100_000  # that a task counts


def start_m(levels: int) -> list[float]:
    """m per level, lowest first: the exact level has 0.95, the others share the rest."""
    rest = (1.0 - START_M_EXACT) / (levels - 1)
    return [rest] * (levels - 1) + [START_M_EXACT]


def start_u(levels: int) -> list[float]:
    """u per level such that the match weights rise evenly from -5 to 10, scaled to sum to 1."""
    low, high = START_WEIGHTS
    step = (high - low) / (levels - 1)
    raw = [m / 2 ** (low + i * step) for i, m in enumerate(start_m(levels))]
    return [u / sum(raw) for u in raw]


@dataclass(frozen=True)
class Model:
    """Prior and, per comparison, m and u for the levels 0..top."""

    comparisons: tuple[Comparison, ...]
    prior: float
    m: Mapping[str, Sequence[float]] = field(default_factory=dict)
    u: Mapping[str, Sequence[float]] = field(default_factory=dict)

    @classmethod
    def start(cls, comparisons: Sequence[Comparison], prior: float) -> Model:
        return cls(
            tuple(comparisons),
            prior,
            {c.gamma: start_m(c.top + 1) for c in comparisons},
            {c.gamma: start_u(c.top + 1) for c in comparisons},
        )

    def weights(self, comparison: Comparison) -> list[float]:
        """log2(m/u) per level."""
        m, u = self.m[comparison.gamma], self.u[comparison.gamma]
        return [math.log2(max(a, FLOOR) / max(b, FLOOR)) for a, b in zip(m, u, strict=True)]

    def prior_weight(self) -> float:
        p = min(max(self.prior, FLOOR), 1 - FLOOR)
        return math.log2(p / (1 - p))


def estimate_prior(
    records: DataFrame,
    rules: Sequence[Rule],
    recall: float,
    source: str = "county_desc",
) -> DataFrame:
    """One row: pairs found by any rule, all pairs across sources, and the prior they imply.

    The union of the rules is counted by inclusion and exclusion over their key sets. Each count
    comes from group sizes alone, (n² - Σ nₛ²) / 2 per block, so no pair is ever formed, and one
    scan with grouping sets serves all of them. Profiles may be passed instead of records.
    """
    signs: dict[frozenset[str], int] = {frozenset(): 0}
    for size in range(1, len(rules) + 1):
        for some in combinations(rules, size):
            keys = frozenset(c for rule in some for c in rule)
            signs[keys] = signs.get(keys, 0) + (1 if size % 2 else -1)
    sets = [keys for keys, sign in signs.items() if sign or not keys]
    columns = sorted(frozenset().union(*sets))
    rows = F.sum("n_records") if "n_records" in records.columns else F.count("*")
    per_source = (
        records.where(F.col(source).isNotNull())
        .groupingSets(
            [[F.col(c) for c in [*sorted(keys), source]] for keys in sets],
            *[F.col(c) for c in [*columns, source]],
        )
        .agg(F.grouping_id().alias("_set"), rows.cast("decimal(38,0)").alias("_n"))
    )

    def set_number(keys: frozenset[str]) -> int:
        """grouping_id: one bit per column, the last column lowest, set if left out."""
        order = [*columns, source]
        return sum(
            1 << (len(order) - 1 - i) for i, c in enumerate(order) if c not in {*keys, source}
        )

    usable = F.lit(False)
    for keys in sets:
        known = F.col("_set") == set_number(keys)
        for c in sorted(keys):
            known = known & F.col(c).isNotNull()
        usable = usable | known
    per_block = (
        per_source.where(usable)
        .groupBy("_set", *columns)
        .agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") * F.col("_n")).alias("_nn"))
    )
    pairs = (F.col("_n") * F.col("_n") - F.col("_nn")).cast("double") / 2
    sign = F.lit(0)
    for keys in sets:
        if keys:
            sign = F.when(F.col("_set") == set_number(keys), signs[keys]).otherwise(sign)
    whole = F.col("_set") == set_number(frozenset())
    none = F.lit(0.0)
    return per_block.agg(
        F.coalesce(F.sum(sign * pairs), none).alias("rule_pairs"),
        F.coalesce(F.sum(F.when(whole, pairs)), none).alias("possible_pairs"),
    ).withColumn(
        "prior",
        F.when(
            F.col("possible_pairs") > 0,
            F.least(F.col("rule_pairs") / recall / F.col("possible_pairs"), F.lit(1.0)),
        ).otherwise(0.0),
    )


def count_patterns(gammas: DataFrame, comparisons: Sequence[Comparison]) -> DataFrame:
    """Record pairs per combination of levels."""
    return gammas.groupBy(*[c.gamma for c in comparisons]).agg(F.sum("n_pairs").alias("n_pairs"))


def value_tuples(
    profiles: DataFrame, rule: Rule, comparisons: Sequence[Comparison], source: str = "county_desc"
) -> DataFrame:
    """A row per combination of compared values that has a block: its records, ``_n``, and how many of them
    each source has, ``_sources`` and ``_counts``."""
    keys = list(dict.fromkeys([*rule, *compared_columns(comparisons)]))
    known = profiles.where(F.col(source).isNotNull())
    for c in rule:
        known = known.where(F.col(c).isNotNull())
    # One shuffle for both steps; a profile is a row per source, so no combination is hot.
    per_source = (
        known.repartition(*keys)
        .groupBy(*keys, source)
        .agg(F.sum("n_records").alias("_n"), F.min("profile_id").alias("_first"))
    )
    own = F.collect_list(F.struct(F.col(source).alias("name"), "_n"))
    tuples = per_source.groupBy(*keys).agg(
        F.min("_first").alias("profile_id"), F.sum("_n").alias("_n"), own.alias("_own")
    )
    return tuples.select(
        *keys,
        "profile_id",
        "_n",
        F.col("_own.name").alias("_sources"),
        F.col("_own._n").alias("_counts"),
    )


def block_patterns(
    profiles: DataFrame,
    rule: Rule,
    comparisons: Sequence[Comparison],
    source: str = "county_desc",
    cell_rows: int = TUPLE_CELL_ROWS,
) -> DataFrame:
    """Record pairs per combination of levels inside the blocks of ``rule``.

    The same as counting ``tuple_pairs``, but no pair becomes a row: tasks compare the cells of a block and
    give their counts. With too many patterns to hold, pairs are formed after all.
    """
    if pattern_bound(comparisons) > MAX_PATTERNS:
        pairs = tuple_pairs(profiles, rule, comparisons, source, cell_rows)
        return count_patterns(compare(pairs, comparisons, ["n_pairs"]), comparisons)
    tuples = materialize(value_tuples(profiles, rule, comparisons, source), "tuples")
    return count_patterns(pattern_counts(tuples, rule, comparisons, cell_rows), comparisons)


def tuple_pairs(
    profiles: DataFrame,
    rule: Rule,
    comparisons: Sequence[Comparison],
    source: str = "county_desc",
    cell_rows: int = TUPLE_CELL_ROWS,
) -> DataFrame:
    """Pairs of different values inside the blocks of ``rule``, with the record pairs they stand for.

    Levels depend on values alone. A row per combination of compared values carries its records and how
    many of them each source has; of two combinations with n and m records, n·m minus the sum over
    the sources of nₛ·mₛ are pairs across sources, and (n² - Σ nₛ²) / 2 of one with itself. So neither
    copies nor the number of sources add to the pairs that are formed, and pairs that stand for none
    are not compared.
    """
    tuples = value_tuples(profiles, rule, comparisons, source)
    tuples = tuples.withColumn("_by_source", F.map_from_arrays("_sources", "_counts"))
    tuples = tuples.drop("_sources", "_counts")
    tuples = materialize(add_letter_bits(tuples, comparisons), "tuples")
    within = F.aggregate(
        F.map_entries("_by_source_l"),
        F.lit(0).cast("long"),
        lambda total, own: total
        + own["value"] * F.coalesce(F.try_element_at("_by_source_r", own["key"]), F.lit(0)),
    )
    several = join_block(tuples, rule, "profile_id", cell_rows)
    several = several.withColumn("n_pairs", F.col("_n_l") * F.col("_n_r") - within)
    alone = tuples.select(
        *[F.col(c).alias(f"{c}_{side}") for side in ("l", "r") for c in tuples.columns]
    ).withColumn("n_pairs", F.shiftright(F.col("_n_l") * F.col("_n_r") - within, 1))
    pairs = several.unionByName(alone.select(*several.columns))
    return pairs.where("n_pairs > 0")


def pattern_bound(comparisons: Sequence[Comparison]) -> int:
    return math.prod(c.top + 2 for c in comparisons)


class Pattern(NamedTuple):
    levels: tuple[int, ...]
    n: float


def _read_patterns(counts: DataFrame, comparisons: Sequence[Comparison]) -> list[Pattern]:
    rows = counts.limit(pattern_bound(comparisons)).collect()  # the bound is exact, nothing is cut
    found = [
        Pattern(tuple(r[c.gamma] for c in comparisons), float(r["n_pairs"])) for r in rows
    ]
    return sorted(found)


def held_out(comparisons: Sequence[Comparison], rule: Rule) -> list[Comparison]:
    """Comparisons on a column of the training block: always equal there, so they learn nothing."""
    return [c for c in comparisons if c.column in rule]


def block_prior(model: Model, rule: Rule) -> float:
    """The prior inside a training block, which already agrees on the columns of ``rule``.

    Each column counts once, through the first comparison listed for it.
    """
    weight = model.prior_weight()
    for column in rule:
        first = next((c for c in model.comparisons if c.column == column), None)
        if first is not None:
            weight += model.weights(first)[-1]
    return 1.0 / (1.0 + 2.0**-weight)


def fit_m(
    patterns: Sequence[Pattern],
    comparisons: Sequence[Comparison],
    model: Model,
    prior: float,
    max_iterations: int = 25,
    tolerance: float = 1e-4,
) -> tuple[Model, float, list[float]]:
    """EM over pattern counts with u held fixed; null levels carry no evidence.

    Returns the model with new m, the prior inside the block, and the log-likelihood per iteration.
    """
    m = {c.gamma: list(model.m[c.gamma]) for c in comparisons}
    history: list[float] = []
    for _ in range(max_iterations):
        total = matched = likelihood = 0.0
        sums = {c.gamma: [0.0] * (c.top + 1) for c in comparisons}
        for levels, n in patterns:
            yes, no = prior, 1.0 - prior
            for c, g in zip(comparisons, levels, strict=True):
                if g >= 0:
                    yes *= max(m[c.gamma][g], FLOOR)
                    no *= max(model.u[c.gamma][g], FLOOR)
            share = yes / (yes + no)
            total += n
            matched += n * share
            likelihood += n * math.log(yes + no)
            for c, g in zip(comparisons, levels, strict=True):
                if g >= 0:
                    sums[c.gamma][g] += n * share
        history.append(likelihood)
        if not total:
            break
        shift = abs(matched / total - prior)
        prior = matched / total
        for c in comparisons:
            weight = sum(sums[c.gamma])
            if weight > 0:
                new = [s / weight for s in sums[c.gamma]]
                shift = max(shift, *(abs(a - b) for a, b in zip(new, m[c.gamma], strict=True)))
                m[c.gamma] = new
        if shift < tolerance:
            break
    return replace(model, m={**model.m, **m}), prior, history


def train_m(
    profiles: DataFrame,
    model: Model,
    rule: Rule,
    source: str = "county_desc",
    max_iterations: int = 25,
    tolerance: float = 1e-4,
    cell_rows: int = CELL_ROWS,
) -> Model:
    """Learn m inside one training block; comparisons on the block's own columns keep theirs."""
    skipped = held_out(model.comparisons, rule)
    trained = [c for c in model.comparisons if c not in skipped]
    counts = block_patterns(profiles, rule, trained, source, min(cell_rows, TUPLE_CELL_ROWS))
    patterns = _read_patterns(counts, trained)
    fitted, _, _ = fit_m(
        patterns, trained, model, block_prior(model, rule), max_iterations, tolerance
    )
    return fitted


def random_pairs(
    records: DataFrame,
    sample_size: int | None,
    partners: int,
    columns: Sequence[str],
    source: str = "county_desc",
    id_col: str = "unique_id",
    seed: int = 42,
) -> DataFrame:
    """Random cross-source pairs: records in hash order, each with the next ``partners``.

    ``sample_size`` takes that many records of the smallest hashes instead of all of them.

    The hash order is random with respect to the data, so neighbours in it are random pairs; the
    pairing is an equi-join on the position.
    """
    sample = records
    if sample_size is not None:
        sample = sample_exactly(records, sample_size, seed, id_col)
    hashed = sample.withColumn(
        "_hash", F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")).cast("binary"))
    )
    ranked = number_in_order(hashed, ["_hash", id_col], "_rank")
    wanted = list(dict.fromkeys([id_col, source, *columns]))
    left = ranked.select(
        *[F.col(c).alias(f"{c}_l") for c in wanted],
        F.explode(F.sequence(F.col("_rank") + 1, F.col("_rank") + partners)).alias("_rank"),
    )
    right = ranked.select("_rank", *[F.col(c).alias(f"{c}_r") for c in wanted])
    return left.join(right, "_rank").where(F.col(f"{source}_l") != F.col(f"{source}_r"))


def train_u(
    records: DataFrame,
    model: Model,
    sample_size: int | None = None,
    partners: int = 10,
    source: str = "county_desc",
    id_col: str = "unique_id",
) -> Model:
    """u from random cross-source pairs; a level that never occurs keeps a small share."""
    columns = [c.column for c in model.comparisons]
    pairs = random_pairs(records, sample_size, partners, columns, source, id_col)
    gammas = compare(pairs.withColumn("n_pairs", F.lit(1)), model.comparisons, ["n_pairs"])
    levels = gammas.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c.gamma).alias("gamma"), F.col(c.gamma).alias("level"))
                    for c in model.comparisons
                ]
            )
        ).alias("x")
    )
    counts = levels.groupBy("x.gamma", "x.level").count()  # at most one row per level
    seen = {(r["gamma"], r["level"]): r["count"] for r in counts.collect()}
    u = {}
    for c in model.comparisons:
        found = [max(seen.get((c.gamma, g), 0), 0.5) for g in range(c.top + 1)]
        u[c.gamma] = [x / sum(found) for x in found]
    return replace(model, u=u)


def model_table(spark, model: Model) -> DataFrame:
    """The parameters as a table: comparison, level, m, u."""
    rows = [
        (c.gamma, g, float(model.m[c.gamma][g]), float(model.u[c.gamma][g]))
        for c in model.comparisons
        for g in range(c.top + 1)
    ]
    return spark.createDataFrame(rows, "comparison string, level int, m double, u double")
