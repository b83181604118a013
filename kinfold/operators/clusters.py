"""Entities: connected components of match edges, golden ids and the reports over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kinfold.operators.identity import number_in_order
from kinfold.session import materialize


def _edge_set(df: DataFrame) -> DataFrame:
    return df.where(F.col("a") != F.col("b")).dropDuplicates(["a", "b"])


def _lowest(edges: DataFrame, *more: Column) -> DataFrame:
    """Per vertex ``a`` its smallest neighbour ``_low``, as a table of its own.

    A join with that table is planned by its true size: small ones are broadcast, and otherwise both
    sides are plain shuffles, whose large partitions (the edges of a hub) adaptive execution splits.
    """
    return materialize(edges.groupBy("a").agg(F.min("b").alias("_low"), *more), "lowest")


def _lead_to_lowest(edges: DataFrame, low: DataFrame) -> DataFrame:
    """Every neighbour ``b`` of a vertex, linked to the smallest vertex around that one."""
    return edges.join(low, "a").select(F.col("b").alias("a"), F.least("a", "_low").alias("b"))


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("b").alias("a"), F.col("a").alias("b"))


def _large_star(edges: DataFrame, low: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex to the smallest vertex around it.

    One row per edge is enough, as only its larger end is linked anew.
    """
    return _lead_to_lowest(_turned(edges), low)


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a vertex and all its smaller neighbours to the smallest of them.

    Every edge leads to a smaller vertex already, which a large star leaves behind.
    """
    low = _lowest(edges)
    others = _lead_to_lowest(edges, low)
    return _edge_set(others.unionByName(low.select("a", F.col("_low").alias("b"))))


def connected_components(
    edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100
) -> DataFrame:
    """``vertex``, ``component`` for every vertex that has an edge; the smallest id is the name.

    Alternates large-star and small-star (Kiveris et al. 2014): every step is a grouped minimum,
    pre-aggregated in the map tasks, and a join with the table of these minima, which does not keep
    the edges of a hub together. Each step is written to the scratch folder. A round's minima also
    tell whether every vertex has one link and no link leads to a vertex that links on.
    """
    current = materialize(
        _edge_set(
            edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b"))
        ),
        "edges",
    )
    up = F.count_if(F.col("b") < F.col("a")).alias("_up")
    down = F.count_if(F.col("b") > F.col("a")).alias("_down")
    for _ in range(max_rounds):
        low = _lowest(current.unionByName(_turned(current)), up, down)
        if low.where("_up > 1 OR (_up > 0 AND _down > 0)").isEmpty():
            break
        current = materialize(_small_star(materialize(_large_star(current, low), "edges")), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return low.select(F.col("a").alias("vertex"), F.least("a", "_low").alias("component"))


def label_vertices(vertices: DataFrame, components: DataFrame, id_col: str) -> DataFrame:
    """Every vertex with its component; a vertex without edges is its own."""
    labels = components.withColumnRenamed("vertex", id_col)
    return vertices.join(labels, id_col, "left").withColumn(
        "component", F.coalesce("component", F.col(id_col))
    )


def spread_components(
    records: DataFrame,
    profiles: DataFrame,
    components: DataFrame,
    columns: Sequence[str],
    id_col: str = "unique_id",
) -> DataFrame:
    """Carry components of profiles over to their records.

    A profile with an edge draws all its records into the component: each of them has that edge.
    A record whose profile has none stays alone.
    """
    marked = components.join(
        profiles.select(F.col("profile_id").alias("vertex"), *columns), "vertex"
    ).select("component", *[F.col(c).alias(f"_p_{c}") for c in columns])
    on = reduce(lambda a, b: a & b, [records[c].eqNullSafe(marked[f"_p_{c}"]) for c in columns])
    return records.join(marked, on, "left").select(
        *records.columns, F.coalesce("component", id_col).alias("component")
    )


def assign_golden_ids(labelled: DataFrame, id_col: str = "unique_id") -> DataFrame:
    """``golden_id`` 1..K as first column, numbered by the smallest record id of the entity."""
    heads = labelled.where(F.col(id_col) == F.col("component")).select("component")
    numbers = number_in_order(heads, ["component"], "golden_id")
    columns = [c for c in labelled.columns if c != "component"]
    return labelled.join(numbers, "component").select("golden_id", *columns)


def golden_table(
    labelled: DataFrame, id_col: str = "unique_id", source: str = "county_desc"
) -> tuple[DataFrame, dict[str, int]]:
    """The golden ids written once, and what the write has counted on its way.

    Columns ``golden_id``, ``id_col``, ``source`` and ``county_count``, the distinct sources of the entity,
    so that reports only filter. ``records``, ``golden_ids`` and ``multi_source_ids`` are observed in
    the last stage of the write, whose rows count once even if tasks run again.
    """
    entities = labelled.groupBy("component").agg(F.count_distinct(source).alias("county_count"))
    numbered = number_in_order(entities, ["component"], "golden_id")
    seen = Observation("golden ids")
    head = F.col(id_col) == F.col("component")
    rows = labelled.select(id_col, source, "component").join(numbered, "component").observe(
        seen,
        F.count("*").alias("records"),
        F.count_if(head).alias("golden_ids"),
        F.count_if(head & (F.col("county_count") > 1)).alias("multi_source_ids"),
    )
    golden = materialize(rows.select("golden_id", id_col, source, "county_count"), "golden")
    return golden, seen.get


def attach_records(
    golden: DataFrame, records: DataFrame, id_col: str = "unique_id"
) -> DataFrame:
    """Golden rows with all columns of their records; golden rows are never lost."""
    return golden.join(records, id_col, "left").select(
        "golden_id", id_col, *[c for c in records.columns if c != id_col]
    )


def count_sources(golden: DataFrame, source: str = "county_desc") -> DataFrame:
    """Distinct non-null sources per golden id as ``county_count``."""
    return golden.groupBy("golden_id").agg(F.countDistinct(source).alias("county_count"))


def multi_source_ids(golden: DataFrame, source: str = "county_desc") -> DataFrame:
    return count_sources(golden, source).where(F.col("county_count") > 1)


def multi_source_report(golden: DataFrame, source: str = "county_desc") -> DataFrame:
    """All member rows of the entities that occur in more than one source.

    The ids are a table of their own, so that a giant entity can be split in the join.
    """
    wide = materialize(multi_source_ids(golden, source), "wide")
    return wide.join(golden, "golden_id", "left").select("golden_id", "county_count", *[
        c for c in golden.columns if c != "golden_id"
    ])


def run_metrics(counted: Mapping[str, int], predictions: DataFrame, strict: Column) -> DataFrame:
    """The counts a run reports, one row per ``metric`` with its ``value``.

    ``counted`` comes from ``golden_table``. One pass over the predictions counts them and those that
    are ``strict`` matches, as record pairs, whatever number of profiles they were folded into.
    """
    pairs = predictions.agg(
        F.coalesce(F.sum("n_pairs"), F.lit(0)).cast("bigint").alias("candidate_pairs"),
        F.coalesce(F.sum(F.when(strict, F.col("n_pairs"))), F.lit(0)).cast("bigint").alias("matched_pairs"),
    )
    names = ["records", "candidate_pairs", "matched_pairs", "golden_ids", "multi_source_ids"]
    rows = pairs.select("*", *[F.lit(counted[n]).cast("bigint").alias(n) for n in names if n in counted])
    return rows.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])).alias("x")
    ).select("x.metric", "x.value")
