"""Incremental preparation: only files that arrived since the last run are read.

Ids are numbers in the order of arrival, as for files that are prepared at once, or hashes of the
values. Numbers need what was numbered before: a ledger has one row per batch and dataset with the
rows that the batch numbered. A batch draws the numbers behind those of the batches before it, so a batch
that is run again, after a failure at any point, draws the same ones and overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kinfold.operators.cleaning import VOTER_RULES, cleaning_columns
from kinfold.operators.identity import add_hash_ids, number_in_file_order, with_ids
from kinfold.operators.mapping import LINKAGE_COLUMNS, select_columns
from kinfold.sources.files import file_stem

SPLIT = ("_file", "_block")  # where a streamed row was read
_LEDGER = "batch long, dataset string, rows long"


def cleaned_rows(rows: DataFrame, extra: Sequence[str] = ("dataset",)) -> DataFrame:
    """The linkage columns, selected and cleaned, behind the ``extra`` ones. Stateless."""
    kept = select_columns(rows, [*extra, *LINKAGE_COLUMNS])
    return kept.select(*extra, *cleaning_columns(kept, VOTER_RULES, LINKAGE_COLUMNS))


def prepare_stream(rows: DataFrame, extra: tuple[str, ...] = ("dataset",)) -> DataFrame:
    """Select, clean and give hashed ids. Stateless, so it works on streams and tables alike.

    The id covers the dataset and the cleaned values: rows that agree in all of them share it. Linkage
    wants an id per row, which ``start_numbered`` gives.
    """
    return add_hash_ids(cleaned_rows(rows, extra))


def with_split(rows: DataFrame) -> DataFrame:
    """Rows of a file source with the file and split they come from."""
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias(SPLIT[0]),
        F.col("_metadata.file_block_start").alias(SPLIT[1]),
    )


def run_incremental(
    spark: SparkSession,
    landing: str,
    schema: str,
    out_dir: str,
    checkpoint: str,
    fmt: str = "csv",
    max_files: int | None = None,
    ledger: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Prepare what is new in ``landing`` and stop; the checkpoint remembers what was read.

    With a ``ledger`` (a folder) rows are numbered, else they get hashed ids.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    dataset = file_stem(F.col("_metadata.file_name"))
    rows = reader.load(landing).withColumn("dataset", dataset)
    if ledger is None:
        return start_incremental(prepare_stream(rows), out_dir, checkpoint)
    return start_numbered(cleaned_rows(with_split(rows), ("dataset", *SPLIT)), out_dir, ledger, checkpoint)


def start_incremental(prepared: DataFrame, out_dir: str, checkpoint: str) -> StreamingQuery:
    return (
        prepared.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """``batch, dataset, rows``: what every batch has numbered."""
    schema = T._parse_datatype_string(_LEDGER)
    try:
        return spark.read.schema(schema).parquet(ledger)
    except AnalysisException:  # no batch has been written yet
        return spark.createDataFrame([], schema)


def numbered_batch(out_dir: str, ledger: str) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` does: number a batch of cleaned rows (with ``SPLIT``) and write it.

    The rows go to the batch's own folder, then its counts to the ledger, both replacing what an
    earlier attempt has left. A file must be of one dataset; files of a dataset follow one another by
    batch, then by path.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = read_ledger(spark, ledger).where(F.col("batch") < number)
        before = before.groupBy("dataset").agg(F.sum("rows").alias("_before"))
        numbered = number_in_file_order(batch, SPLIT, "_n", ["dataset"], before)
        prepared = with_ids(numbered.drop(*SPLIT), "dataset")
        path = f"{out_dir.rstrip('/')}/batch={number}"
        prepared.write.mode("overwrite").parquet(path)
        written = spark.read.schema(prepared.schema).parquet(path)
        counts = written.groupBy("dataset").agg(F.count("*").alias("rows"))
        counts.write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/batch={number}")

    return write


def start_numbered(
    cleaned: DataFrame, out_dir: str, ledger: str, checkpoint: str
) -> StreamingQuery:
    """Number a stream of cleaned rows (``dataset``, ``SPLIT`` and the rest) batch by batch.

    The output has ``unique_id`` (``dataset_1``, ``dataset_2``, …) and a partition column ``batch``.
    """
    return (
        cleaned.writeStream.foreachBatch(numbered_batch(out_dir, ledger))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
