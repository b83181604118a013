"""Embedding near-dedup: p-stable hashing into buckets, then exact cosines.

Normalised vectors within cosine c are within Euclidean distance sqrt(2 - 2c). Each of ``TABLES`` tables
quantises ``PROJECTIONS`` random projections of a vector (Datar et al. 2004: normal projections are
2-stable) into a bucket key, together with the label. Vectors of one bucket are compared exactly, in
double precision and block pairs of bounded size. A pair counts in the first table that brings it
together, so pairs need not be shuffled to be counted once. Tasks return link counts per vector
and a spanning forest of the links, never all pairs.

Equal vectors of one label are one vertex with a multiplicity from the start. Defined results: a vector
that is null, zero or has null or non-finite components, or a null label, links with nothing; rows with
one ``vec_id`` and different vectors are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm.blocks import block_pairs, units
from kinfold.operators.clusters import connected_components
from kinfold.session import materialize

COSINE = 0.93
TABLES = 24
PROJECTIONS = 8
WIDTH = 1.5  # of a quantisation step, four times the distance at the threshold
SEED = 11


@F.pandas_udf(T.BinaryType())
def _binary(values: pd.Series) -> pd.Series:
    return pd.Series([np.asarray(v, np.float64).tobytes() for v in values], dtype=object)


def _hash_keys(tables: int, projections: int, width: float, seed: int):
    """Bucket keys of every vector, one per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.frombuffer(v, np.float64) for v in batch.column("vector").to_pylist()]
            sizes = np.array([len(v) for v in raw], np.int64)
            keys = np.zeros((len(raw), tables), np.int64)
            for dims in set(sizes.tolist()):
                rng = np.random.default_rng([seed, dims])
                lines = rng.standard_normal((dims, tables * projections))
                shifts = rng.uniform(0, width, tables * projections)
                odd = rng.integers(1, 1 << 62, (tables, projections), dtype=np.int64) * 2 + 1
                at = np.flatnonzero(sizes == dims)
                x = np.stack([raw[i] for i in at])
                x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                steps = np.floor((x @ lines + shifts) / width).astype(np.int64)
                steps = steps.reshape(len(at), tables, projections)
                with np.errstate(over="ignore"):
                    keys[at] = (steps * odd).sum(axis=2)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), tables)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists.cast(pa.list_(pa.int64()))],
                names=[*batch.schema.names, "keys"],
            )

    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For every vertex, the smallest vertex of its component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(cosine: float):
    def matrix(side: pa.Table) -> tuple[np.ndarray, ...]:
        x = np.stack([np.frombuffer(v, np.float64) for v in side.column("vector").to_pylist()])
        x = x / np.abs(x).max(axis=1, keepdims=True)
        keys = np.array(side.column("keys").to_pylist(), np.int64)
        vertex, copies = (side.column(c).to_numpy() for c in ("vertex", "copies"))
        return x, np.linalg.norm(x, axis=1), keys, vertex, copies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right in units(batches, "bucket"):
            if len(set(left.column("dims").to_pylist() + right.column("dims").to_pylist())) > 1:
                continue  # a hash of buckets, not a bucket
            x, norm_x, keys_x, vertex_x, copies_x = matrix(left)
            y, norm_y, keys_y, vertex_y, copies_y = matrix(right)
            i, j = np.nonzero((x @ y.T) / np.outer(norm_x, norm_y) >= cosine)
            if left is right:
                i, j = i[i < j], j[i < j]
            table = left.column("table")[0].as_py()
            first = (keys_x[i] == keys_y[j]).argmax(axis=1) == table
            i, j = i[first], j[first]
            n, shift = len(x) + len(y), 0 if left is right else len(x)
            counts = np.zeros(n, np.int64)
            np.add.at(counts, i, copies_y[j])
            np.add.at(counts, j + shift, copies_x[i])
            vertex = np.r_[vertex_x, vertex_y]
            at = np.flatnonzero(counts)
            root = _forest(i, j + shift, n)[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(vertex[at]), pa.array(vertex[root]), pa.array(counts[at])],
                names=["vertex", "root", "n"],
            )

    return run


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id, embedding, label``).

    Vectors of one label link if their cosine is at least ``cosine``; ``component_id`` is the smallest
    ``vec_id`` reachable by links. More tables find more of the links near the threshold.
    """
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = finite & F.exists(values, lambda v: v != 0) & F.col("label").isNotNull()
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(usable, F.xxhash64(F.lit(1), "label", values)).alias("vertex"),
        F.col("label").cast("string").alias("label"),
        values.alias("values"),
    )
    rows = materialize(rows, "vectors")
    good = rows.where("vertex IS NOT NULL")
    folded = good.groupBy("vertex").agg(
        F.count("*").alias("copies"),
        F.first("label").alias("label"),
        F.first("values").alias("values"),
    )
    packed = folded.select(
        "vertex", "copies", "label", F.size("values").alias("dims"), _binary("values").alias("vector")
    )
    kinds = "vertex long, copies long, label string, dims int, vector binary, keys array<long>"
    hashed = materialize(
        packed.mapInArrow(_hash_keys(tables, projections, width, seed), kinds), "hashed"
    )
    dealt = hashed.select("*", F.posexplode("keys").alias("table", "key")).select(
        "vertex", "copies", "dims", "vector", "keys", "table",
        F.xxhash64("label", "dims", "table", "key").alias("bucket"),
    )
    found = materialize(
        block_pairs(dealt, "bucket", "vertex").mapInArrow(
            _compare(cosine), "vertex long, root long, n long"
        ),
        "found",
    )
    links = found.groupBy("vertex").agg(F.sum("n").alias("links"))
    parts = connected_components(found.where("vertex != root"), "vertex", "root")
    folds = materialize(
        folded.select("vertex", F.col("copies") - 1).toDF("vertex", "more")
        .join(links, "vertex", "left")
        .join(parts, "vertex", "left")
        .select(
            "vertex",
            (F.coalesce("links", F.lit(0)) + F.col("more")).alias("n_links"),
            F.coalesce("component", "vertex").alias("component"),
        ),
        "folds",
    )
    members = materialize(good.select("vec_id", "vertex").join(folds, "vertex"), "members")
    names = materialize(
        members.groupBy("component").agg(F.min("vec_id").alias("component_id")), "names"
    )
    columns = ["vec_id", "n_links", "component_id"]
    alone = rows.where("vertex IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    every = members.join(names, "component").select(*columns).unionByName(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
