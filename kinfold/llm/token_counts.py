"""Token counts kept up to date by signed deltas.

A store has two tables per committed batch. ``ledger``: what the batch changed, per document and
tokenizer version, +1 for a count that became valid and -1 for one that no longer is. ``delta``: the
ledger summed by source, language and tokenizer version. Totals are sums of deltas, so a batch costs
what it changes, and deltas can be summed in any order.

A batch is committed when Spark's committer has marked its delta as complete, which is the last thing
written. Committing a batch again does nothing; one that broke off is written anew. Batches are named
by the caller and must be committed in the order of their names.

Defined results: null source or language is a group of its own; a null text has no token; a document
without id is ignored, as nothing could revise it; of several changes of one document in a batch
the one with the largest ``seq`` counts, then the one with the largest values. Deleting what is
not there changes nothing, inserting what is there revises it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm import words as wd
from kinfold.llm.tokens import encoder

GROUP = ("source", "lang", "tokenizer")
_LEDGER = "doc_id long, source string, lang string, tokenizer string, tokens long, sign int"
_DELTA = "source string, lang string, tokenizer string, documents long, tokens long"


def count_tokens(docs: DataFrame, tokenizer: str, path: str) -> DataFrame:
    """``docs`` (with ``text``) with ``tokens`` instead of ``text`` and the ``tokenizer`` version."""
    own = [c for c in docs.columns if c not in ("text", "tokens", "tokenizer")]
    texts = docs.select(*[f"`{c}`" for c in own], F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for whole in batches:
            for batch in wd.slices(whole, "text"):
                _, counts = encode(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in own), pa.array(counts, pa.int64())],
                    names=[*own, "tokens"],
                )

    fields = [f for f in texts.schema if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("tokens", T.LongType())])
    return texts.mapInArrow(run, schema).withColumn("tokenizer", F.lit(tokenizer))


class TokenCounts:
    """A store of token counts below ``root``, a folder all executors can reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._root = spark, root.rstrip("/")

    def _path(self, table: str, batch: str = "") -> str:
        return f"{self._root}/{table}" + (f"/batch={batch}" if batch else "")

    def _committed(self, batch: str) -> bool:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._path("delta", batch) + "/_SUCCESS")
        return path.getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def batches(self) -> list[str]:
        """Names of the committed batches, in order."""
        jvm = self._spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._path("delta"))
        fs = path.getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(path):
            return []
        names = [s.getPath().getName().removeprefix("batch=") for s in fs.listStatus(path)]
        return sorted(n for n in names if self._committed(n))

    def _tables(self, table: str, schema: str, batches: list[str]) -> DataFrame:
        paths = [self._path(table, b) for b in batches]
        if not paths:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(*paths)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply ``changes``: ``doc_id, source, lang, tokenizer, tokens, op, seq``.

        ``op`` is ``insert``, ``revise`` (both: the given values hold from now on) or ``delete``. False
        if the batch is committed already.
        """
        if self._committed(batch):
            return False
        earlier = self.batches()
        if earlier and batch < earlier[-1]:
            raise ValueError(f"batch {batch} comes after {earlier[-1]}")
        key = ["doc_id", "tokenizer"]
        rank = F.struct("seq", "op", "tokens", "source", "lang")
        values = F.struct("op", "source", "lang", "tokens")
        latest = (
            changes.where("doc_id IS NOT NULL")
            .groupBy(*key)
            .agg(F.max_by(values, rank).alias("new"))
        )
        valid = self._tables("ledger", _LEDGER, earlier)
        valid = valid.groupBy(*key, "source", "lang", "tokens").agg(F.sum("sign").alias("n"))
        old = F.struct(F.lit(-1).alias("sign"), "source", "lang", "tokens").alias("old")
        joined = latest.join(valid.where("n > 0").select(*key, old), key, "left")
        kept = F.when(
            F.col("new.op") != "delete",
            F.struct(F.lit(1).alias("sign"), "new.source", "new.lang", "new.tokens"),
        )
        rows = joined.select(*key, F.explode(F.array("old", kept)).alias("row")).where(
            "row IS NOT NULL"
        )
        columns = ["doc_id", "row.source", "row.lang", "tokenizer", "row.tokens", "row.sign"]
        rows.select(*columns).write.mode("overwrite").parquet(self._path("ledger", batch))
        written = self._tables("ledger", _LEDGER, [batch])
        delta = written.groupBy(*GROUP).agg(
            F.sum("sign").cast("long").alias("documents"),
            F.sum(F.col("sign") * F.col("tokens")).alias("tokens"),
        )
        delta.write.mode("overwrite").parquet(self._path("delta", batch))
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens`` of the groups that have documents."""
        deltas = self._tables("delta", _DELTA, self.batches())
        sums = deltas.groupBy(*GROUP).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")
        )
        return sums.where("documents > 0")
