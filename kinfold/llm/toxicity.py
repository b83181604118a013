"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features are the distinct words, word pairs and pairs that skip one word of a whole text, hashed to
``BITS`` bits. Training uses per-coordinate learning rates and L1 sparsity (McMahan et al. 2013). It
runs on at most ``MAX_LABELLED`` labelled rows, chosen by hashed id; that bound also bounds the
weights. In each round, tasks continue from the shared state over their part of the rows, and emit what
they changed of every coordinate they touched. A coordinate moves by the sum of that over the root of
the number of its tasks: what one task alone has seen counts in full, and what all have seen, such as the
bias, is not moved too far. The result is a sparse vector of at most 2^BITS weights, which
is broadcast for scoring.

Defined results: null and empty texts have no feature and get the score of the bias alone; rows with
a null or other label than 0 and 1, and labels of unknown documents, are not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm import words as wd
from kinfold.session import materialize

BITS = 20
ROUNDS = 4  # merges of the state
PASSES = 1  # over the rows of a task, in every round
MAX_LABELLED = 40_000
PARTS = 6  # tasks of a round; fixed, so that the weights do not depend on the cluster
ALPHA, BETA, L1, L2 = 2.0, 1.0, 3.0, 1.0


class Model(NamedTuple):
    """Weights that are not zero, by feature; ``bias`` is the score of a text without words."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int


def features(batch: pa.RecordBatch, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature), distinct and in row order, of the texts of a batch."""
    data, offsets = wd.text_bytes(batch.column("text"))
    found = wd.split_words(data, offsets, wd.ALPHANUMERIC, lower=True)
    h, row = found.hash, found.row
    rows, hashes = [row], [wd.mix(h)]
    for apart, salt in ((1, 0x51ED270B), (2, 0x2C1B3C6D)):  # neighbours, and one word skipped
        if len(h) > apart:
            same = row[:-apart] == row[apart:]
            pair = wd.mix(h[:-apart] * np.uint64(3) + wd.mix(h[apart:]) + np.uint64(salt))
            rows.append(row[:-apart][same])
            hashes.append(pair[same])
    feature = np.concatenate(hashes) >> np.uint64(64 - bits)
    key = wd.distinct((np.concatenate(rows).astype(np.uint64) << np.uint64(bits)) | feature)
    mask = np.uint64((1 << bits) - 1)
    return (key >> np.uint64(bits)).astype(np.int64), (key & mask).astype(np.int64)


def _weights(z: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Weights from the linear terms and the roots of the summed squared gradients."""
    return (np.clip(z, -L1, L1) - z) / ((BETA + root) / ALPHA + L2)


def _bias(z: float, root: float) -> float:
    return float(-z / ((BETA + root) / ALPHA))


def _sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _round(shared, bits: int, passes: int):
    """Continue FTRL from the shared state over one part of the rows; emit all changes.

    They leave the task as single-precision numbers, which halves what is shuffled.
    """

    def learn(z: np.ndarray, n: np.ndarray, f: np.ndarray, label: int) -> None:
        zf, nf = z[f], n[f]
        root = np.sqrt(nf)
        w = _weights(zf, root)
        w[-1] = _bias(zf[-1], root[-1])
        g = _sigmoid(float(w.sum())) - label  # every feature of a text has the value 1
        nf += g * g
        z[f] = zf + g - (np.sqrt(nf) - root) / ALPHA * w
        n[f] = nf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, z0, n0 = shared.value
        bias = 1 << bits
        z, n = np.zeros(bias + 1), np.zeros(bias + 1)
        z[index], n[index] = z0, n0
        touched = np.zeros(bias + 1, bool)
        rows: list[tuple[np.ndarray, int]] = []  # bounded by the number of labelled rows
        for whole in batches:
            for batch in wd.slices(whole, "text"):
                row, feature = features(batch, bits)
                first, after = wd.row_spans(row, batch.num_rows)
                for r, label in enumerate(batch.column("toxic").to_pylist()):
                    own = np.append(feature[first[r] : after[r]], bias).astype(np.int32)
                    rows.append((own, label))
                    touched[own] = True
        for _ in range(passes):
            for own, label in rows:
                learn(z, n, own, label)
        z[index] -= z0
        n[index] -= n0
        at, dz, dn = np.flatnonzero(touched), z, n
        for a in range(0, len(at), 1 << 16):
            own = at[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (own.astype(np.int32), dz[own].astype("f4"), dn[own].astype("f4"))],
                names=["feature", "z", "n"],
            )

    return run


def _training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """``text, toxic`` of at most ``max_labelled`` labelled documents, in parts of fixed content."""
    agreed = (
        labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int"))
        .where("_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
        .where("toxic = _most")
        .select("_id", "toxic", F.xxhash64("_id").alias("_at"))
    )
    chosen = agreed.orderBy("_at", "_id").limit(max_labelled)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string"))
    rows = texts.where("text IS NOT NULL").join(F.broadcast(chosen), "_id")  # max_labelled rows
    part = F.pmod("_at", F.lit(PARTS))
    return (
        rows.repartition(PARTS, part)
        .sortWithinPartitions(F.xxhash64("_at"), F.xxhash64("text"))
        .select("text", "toxic")
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    bits: int = BITS,
    rounds: int = ROUNDS,
    passes: int = PASSES,
    max_labelled: int = MAX_LABELLED,
) -> Model:
    """Train on the documents of ``labels`` (``doc_id, toxic``); conflicting labels are left out."""
    spark = docs.sparkSession
    rows = materialize(_training_rows(docs, labels, max_labelled), "toxicity")
    whole_z, whole_n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    state = (np.zeros(0, "i4"), np.zeros(0, "f4"), np.zeros(0, "f4"))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(state)
        changed = (
            rows.mapInArrow(_round(shared, bits, passes), "feature int, z float, n float")
            .groupBy("feature")
            .agg(*[(F.sum(c) / F.sqrt(F.count("*"))).alias(c) for c in ("z", "n")])
            .toArrow()  # a row per coordinate, 2^bits + 1 at most
        )
        at = changed.column("feature").to_numpy()
        whole_z[at] += changed.column("z").to_numpy()
        whole_n[at] += changed.column("n").to_numpy()
        index = np.flatnonzero(whole_n)  # squared gradients: positive where there is evidence
        state = (index.astype("i4"), whole_z[index].astype("f4"), whole_n[index].astype("f4"))
    index, z, n = np.flatnonzero(whole_n), whole_z[whole_n > 0], whole_n[whole_n > 0]
    root = np.sqrt(n)
    weight = _weights(z, root)
    is_bias = index == 1 << bits
    bias = _bias(z[is_bias][0], root[is_bias][0]) if is_bias.any() else 0.0
    used = (weight != 0) & ~is_bias
    return Model(index[used].astype(np.int64), weight[used], bias, bits)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        dense = np.zeros(1 << model.bits)
        dense[model.index] = model.weight
        for whole in batches:
            for batch in wd.slices(whole, "text"):
                row, feature = features(batch, model.bits)
                total = np.bincount(row, dense[feature], batch.num_rows) + model.bias
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(_sigmoid(total))], names=[*batch.schema.names, "score"]
                )

    return run


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1); an input column of that name is replaced."""
    own = [f"`{c}`" for c in docs.columns if c != "score"]
    texts = docs.select(*own).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*texts.schema, T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^bits weights at most
    return texts.mapInArrow(_score(shared), schema)
