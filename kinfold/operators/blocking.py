"""Candidate pairs by blocking keys, between different sources only.

Two things keep blocks from exploding, and both are exact:

* Records of one source that agree in every compared column behave alike in every pair, so they
  are first folded into one *profile* with a record count. A group of copies, however large,
  becomes one profile per source, and Spark folds most of it before the shuffle.
* A block with more profiles than ``cell_rows`` is split into cells (Kolb, Thor & Rahm 2012): the
  left side is cut in k parts, the right side in k parts, and every task joins one part with one
  part. No pair is lost and no task holds the whole block. Rows are copied once per part, so small cells are
  only made while the copies stay few; the cells of larger blocks have more rows, up to ``CELL_ROWS``. The number of tasks follows the pairs to be
  looked at; by the bytes of the profiles, which adaptive execution goes by, a few tasks would get all.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_ROWS = 1_000
MAX_HOT_BLOCKS = 10_000
FEW_COPIES = 8  # of a row, which cells of fewer than CELL_ROWS rows may cost
TASK_PAIRS = 1_000_000  # looked at by a task of a block join, about
MAX_TASKS = 20_000  # of a block join; tasks grow beyond

Rule = Sequence[str]


def fold_profiles(
    records: DataFrame,
    columns: Sequence[str],
    source: str = "county_desc",
    id_col: str = "unique_id",
) -> DataFrame:
    """One row per source and combination of ``columns``: smallest record id and record count."""
    keys = list(dict.fromkeys([source, *columns]))
    return records.groupBy(*keys).agg(
        F.min(id_col).alias("profile_id"), F.count("*").alias("n_records")
    )


def single_profiles(records: DataFrame, id_col: str = "unique_id") -> DataFrame:
    """Every record its own profile, for callers who need pairs of records."""
    return records.withColumn("profile_id", F.col(id_col)).withColumn(
        "n_records", F.lit(1).cast("bigint")
    )


def _known(rule: Rule, suffix: str = "") -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{c}{suffix}").isNotNull() for c in rule])


def _agrees(rule: Rule, known: Rule = ()) -> Column:
    """True if the pair satisfies the rule, false (never null) otherwise; it agrees on ``known`` anyway."""
    same = [F.col(f"{c}_l") == F.col(f"{c}_r") for c in rule if c not in known]
    return F.coalesce(reduce(lambda a, b: a & b, same), F.lit(False))


def hot_blocks(rows: DataFrame, rule: Rule, cell_rows: int) -> DataFrame | None:
    """Blocks with more than ``cell_rows`` rows and the number of parts to cut them in.

    None if there are none. They are broadcast only if they are few. Parts have ``cell_rows`` rows, or more
    where the block would otherwise be copied more than ``FEW_COPIES`` times, but never more than both
    ``cell_rows`` and ``CELL_ROWS``: copies grow with the block over ``cell_rows`` otherwise.
    """
    wanted = F.ceil(F.col("_rows") / cell_rows)
    needed = F.greatest(F.lit(FEW_COPIES), F.ceil(F.col("_rows") / CELL_ROWS))
    hot = (
        rows.groupBy(*rule)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > cell_rows)
        .select(*rule, F.least(wanted, needed).cast("int").alias("_parts"))
    )
    few = hot.limit(MAX_HOT_BLOCKS + 1).collect()
    if not few:
        return None
    if len(few) <= MAX_HOT_BLOCKS:
        return F.broadcast(rows.sparkSession.createDataFrame(few, hot.schema))
    return hot  # too many to broadcast: joined like any other table


def block_tasks(rows: DataFrame, rule: Rule, task_pairs: int | None = None) -> int:
    """How many tasks the pairs of all blocks are worth, from the block sizes; 0 if one is enough."""
    task_pairs = task_pairs or TASK_PAIRS
    sizes = rows.groupBy(*rule).agg(F.count("*").cast("double").alias("_rows"))
    pairs = sizes.agg(F.sum(F.col("_rows") * F.col("_rows"))).first()[0] or 0.0
    if pairs <= task_pairs:
        return 0
    wanted = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, min(math.ceil(pairs / task_pairs), MAX_TASKS))


def join_block(
    rows: DataFrame, rule: Rule, once: str, cell_rows: int | None = CELL_ROWS
) -> DataFrame:
    """Pairs of ``rows`` that agree on ``rule``, as columns with ``_l`` and ``_r``.

    ``once`` names the column that must be smaller on the left, so that a pair comes up once.
    Rows need a ``profile_id``. Without ``cell_rows`` the caller knows that no block is hot.
    """
    known = rows.where(_known(rule))
    hot = None if cell_rows is None else hot_blocks(known, rule, cell_rows)
    keys = list(rule)
    if hot is None:
        left = right = known
    else:
        parts = known.join(hot, keys, "left").withColumn(
            "_parts", F.coalesce("_parts", F.lit(1))
        )
        mine = F.pmod(F.xxhash64("profile_id"), F.col("_parts")).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
        left = parts.withColumn("_row", mine).withColumn("_col", others).drop("_parts")
        right = parts.withColumn("_col", mine).withColumn("_row", others).drop("_parts")
        keys += ["_row", "_col"]
    if tasks := block_tasks(known, rule):
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    left = left.select(*[F.col(c).alias(f"{c}_l") for c in left.columns])
    right = right.select(*[F.col(c).alias(f"{c}_r") for c in right.columns])
    on = [left[f"{c}_l"] == right[f"{c}_r"] for c in keys]
    on.append(left[f"{once}_l"] < right[f"{once}_r"])
    return left.join(right, reduce(lambda a, b: a & b, on)).drop(
        "_row_l", "_row_r", "_col_l", "_col_r"
    )


def widest_rules(rules: Sequence[Rule]) -> list[Rule]:
    """The rules that are not merely a narrower form of another one."""
    return [
        r
        for i, r in enumerate(rules)
        if not any(
            set(o) < set(r) or (set(o) == set(r) and j < i)
            for j, o in enumerate(rules)
            if j != i
        )
    ]


def first_rule(rules: Sequence[Rule], wide: Sequence[Rule], i: int) -> Column:
    """Position of the first rule that fires, for pairs of ``wide[i]`` that no earlier one of ``wide`` found.

    Only what can still fire is compared: not the columns of ``wide[i]``, nor narrower forms of an earlier one.
    """
    at = list(rules).index(wide[i])
    key = F.lit(at)
    for k in reversed(range(at)):
        if not any(set(earlier) <= set(rules[k]) for earlier in wide[:i]):
            key = F.when(_agrees(rules[k], wide[i]), F.lit(k)).otherwise(key)
    return key


def candidate_pairs(
    profiles: DataFrame,
    rules: Sequence[Rule],
    source: str = "county_desc",
    cell_rows: int = CELL_ROWS,
    pairs_of: Callable[[DataFrame, Rule, str, int], DataFrame] = join_block,
) -> DataFrame:
    """All profile pairs of different sources that satisfy a rule, each pair once.

    ``match_key`` is the position of the first rule that fires. ``n_pairs`` is the number of
    record pairs the profile pair stands for. A rule that only narrows another one adds no pairs,
    so it costs no join; the remaining joins exclude what an earlier one already found, which
    needs no de-duplicating shuffle. ``pairs_of`` may add columns to the pairs of a block.
    """
    wide = widest_rules(rules)
    found = []
    for i, rule in enumerate(wide):
        pairs = pairs_of(profiles, rule, source, cell_rows)
        for earlier in wide[:i]:
            pairs = pairs.where(~_agrees(earlier, rule))
        found.append(pairs.withColumn("match_key", first_rule(rules, wide, i)))
    pairs = reduce(lambda a, b: a.unionByName(b), found)
    return pairs.withColumn("n_pairs", F.col("n_records_l") * F.col("n_records_r"))


def expand_pairs(
    pairs: DataFrame, records: DataFrame, profiles: DataFrame, id_col: str = "unique_id"
) -> DataFrame:
    """Record-level pairs of scored profile pairs: ``{id_col}_l``, ``{id_col}_r`` and the rest.

    The output has one row per record pair, so use it on pairs that passed a threshold.
    """
    columns = [c for c in profiles.columns if c in records.columns and not c.startswith("_")]
    on = reduce(lambda a, b: a & b, [records[c].eqNullSafe(profiles[c]) for c in columns])
    members = records.join(profiles, on).select(profiles["profile_id"], records[id_col])
    rest = [c for c in pairs.columns if c not in ("profile_id_l", "profile_id_r")]
    for side in ("l", "r"):
        named = members.select(
            F.col("profile_id").alias(f"profile_id_{side}"), F.col(id_col).alias(f"{id_col}_{side}")
        )
        pairs = pairs.join(named, f"profile_id_{side}")
    return pairs.select(f"{id_col}_l", f"{id_col}_r", *rest)
