"""Sharding: a uniform shuffle into shards of exact sizes, with DataFrame functions only.

1. Rows are counted per input partition.
2. A communication matrix says how many rows each partition sends to each shard. Its rows are drawn
   one after the other from the multivariate hypergeometric distribution, so the shard sizes come
   out exactly and every assignment of rows to shards is equally likely.
3. Each partition permutes its rows by a random key; the matrix cuts the permutation into ranges.
4. Rows are exchanged and permuted again inside their shard by a second key. Slots are numbered by a
   range sort with one offset per range, so no shard has to fit into one task.

Places are found for row numbers alone; the rows themselves travel once, when they get theirs. Keys hash
a row's place in a written table with the seed: a task that runs again draws the same.

Defined results: nulls, ties and repeated rows are rows like others; an empty table stays empty;
input columns named ``shard`` or ``slot`` are replaced, all others come back whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinfold.operators.identity import number_in_order
from kinfold.session import materialize

SHARDS = 8
SEED = 20240229
_GROUPS = 4096  # rows of the matrix at most; more partitions share them
_SAMPLER_LIMIT = 10**9  # numpy draws from smaller populations only


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart; which shards get one more does not depend on the rows."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` rows drawn from ``good + bad`` are good ones, for numbers of any size.

    Large populations are drawn by inversion. Probabilities relative to that of the middle come from
    sums of log ratios; 12 standard deviations and 64 values to both sides leave out less than doubles
    resolve.
    """
    if max(good, bad) < _SAMPLER_LIMIT:
        return int(rng.hypergeometric(good, bad, sample))
    low, high = max(0, sample - bad), min(good, sample)
    total = good + bad
    share = good / total
    middle = min(max(round(sample * share), low), high)
    spread = math.sqrt(sample * share * (1 - share) * (total - sample) / max(total - 1, 1))
    reach = math.ceil(12 * spread) + 64
    low, high = max(low, middle - reach), min(high, middle + reach)
    k = np.arange(low, high, dtype=np.float64)  # whole numbers below 2**53 are exact
    ratios = np.log(good - k) + np.log(sample - k) - np.log(k + 1) - np.log(bad - sample + k + 1)
    logs = np.r_[0.0, np.cumsum(ratios)]
    weights = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(weights, rng.random() * weights[-1], "right"))


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows each partition sends to each shard: partition and shard totals hold exactly."""
    rng = np.random.default_rng(seed)
    left, matrix = list(sizes), []
    for count in counts:
        row = []
        rest, population = count, sum(left)
        for open_slots in left[:-1]:
            others = population - open_slots
            drawn = draw_hypergeometric(rng, open_slots, others, rest) if rest and open_slots else 0
            row.append(drawn)
            rest, population = rest - drawn, others
        row.append(rest)
        left = [a - b for a, b in zip(left, row, strict=True)]
        matrix.append(row)
    return matrix


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard)."""
    spark = df.sparkSession
    columns = [c for c in df.columns if c not in ("shard", "slot")]
    inputs = F.struct(*[f"`{c}`" for c in columns]) if columns else F.lit(None).cast("int")
    part = F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).cast("int").alias("_part")
    placed = materialize(
        df.select(inputs.alias("inputs"), part, F.monotonically_increasing_id().alias("_row")),
        "sharding",
    )
    counts = [tuple(r) for r in placed.groupBy("_part").count().orderBy("_part").collect()]
    sizes = shard_sizes(sum(n for _, n in counts), shards)
    ranges = []
    for (name, _), row in zip(
        counts, communication_matrix([n for _, n in counts], sizes, seed), strict=True
    ):
        at = 0
        for shard, n in enumerate(row):
            if n:
                ranges.append((name, shard, at, at + n))
            at += n
    matrix = spark.createDataFrame(ranges, "_p int, shard int, _from long, _to long")
    local = W.partitionBy("_part").orderBy(F.xxhash64(F.lit(seed), "_row"), "_row")
    ranked = placed.select("_part", "_row").withColumn("_rank", F.row_number().over(local) - 1)
    inside = (
        (ranked["_part"] == matrix["_p"])
        & (ranked["_rank"] >= matrix["_from"])
        & (ranked["_rank"] < matrix["_to"])
    )
    sent = ranked.join(F.broadcast(matrix), inside)  # _GROUPS x shards rows at most
    keyed = sent.select("shard", F.xxhash64(F.lit(seed + 1), "_row").alias("_key"), "_row")
    numbered = number_in_order(keyed, ["_key", "_row"], "_slot", within=["shard"])
    places = numbered.select("_row", "shard", (F.col("_slot") - 1).cast("long").alias("slot"))
    return placed.join(places, "_row").select(
        *[F.col("inputs").getField(c).alias(c) for c in columns], "shard", "slot"
    )
