"""What the operators read from their input tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id, text, row``: extra columns go, so none can clash with a working column.

    ``row`` is a hash of the text. Rows that agree in both id and text count as one document;
    rows with one id and different texts are told apart by it.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    ).withColumn("row", F.xxhash64("text"))


def with_text(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``documents(docs)`` with the columns of ``found`` (one row per ``doc_id, row``) or null."""
    keyed = found.withColumnsRenamed({"doc_id": "_id", "row": "_row"})
    base = documents(docs)
    joined = base.join(
        keyed, base["doc_id"].eqNullSafe(keyed["_id"]) & (base["row"] == keyed["_row"]), "left"
    )
    return joined.drop("_id", "_row")


def sha256(text) -> object:
    """Lower-case hex SHA-256 of a string column's UTF-8; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def bucketed(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` as a table bucketed by ``columns`` in the shared scratch folder.

    Later joins on these columns do not move its rows again.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"scratch_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *columns)
        .write.bucketBy(buckets, *columns)
        .option("path", scratch_path(spark, name))
        .saveAsTable(name)
    )
    return spark.table(name)
