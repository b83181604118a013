"""From raw documents to packed token sequences: five stages, each written and read again.

Every stage works on all rows its predecessor kept. All but the last return the columns of
``documents``; ``n_chars`` follows the text. Null and empty texts pass all stages, null ids are ids of
their own, repeated rows are scored, cut and packed one by one except that near copies keep one; columns
beside those of ``documents`` are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import decontaminate as dc
from kinfold.llm import jaccard, line_dedup, packing, toxicity
from kinfold.llm.queries import REJECT_AT, tokenizer_file, toxicity_model
from kinfold.llm.tables import read
from kinfold.session import materialize, remove_scratch, scratch_mark

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NEAR_WORDS, NEAR_PERCENT = 5, 80  # near copies; op5's contract (4, 85) binds that query alone


def _with_text(docs: DataFrame, text) -> DataFrame:
    changed = docs.withColumn("text", text)
    chars = F.when(F.col("text").isNotNull(), F.length("text").cast("long"))
    return changed.withColumn("n_chars", F.coalesce(chars, "n_chars")).select(*COLUMNS)


_last: dict[str, tuple[int, str, int, int]] = {}


def _stage(number: int):
    """Lets a stage delete what the one before it wrote to scratch, once that is not needed.

    That is so when the stage before was the last one called on this folder, and ``docs`` does not read
    its scratch tables, as its result has been written and read again.
    """

    def wrap(function):
        @wraps(function)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            app = spark.sparkContext.applicationId
            last = _last.pop(app, None)
            if last and last[:2] == (number - 1, sf_dir):
                remove_scratch(spark, *last[2:], kept=docs.inputFiles())
            begun = scratch_mark()
            result = function(spark, docs, sf_dir)
            _last[app] = (number, sf_dir, begun, scratch_mark())
            return result

        return run_stage

    return wrap


@_stage(0)
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    model = toxicity_model(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs.select(*COLUMNS), model)
    return scored.where(F.col("score") < REJECT_AT).select(*COLUMNS)


@_stage(1)
def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that many documents share stay in one of them; every document stays."""
    bitmaps = line_dedup.line_bitmaps(docs).withColumnsRenamed({"doc_id": "_id", "row": "_row"})
    same = (docs["doc_id"] == bitmaps["_id"]) & (F.xxhash64(docs["text"]) == bitmaps["_row"])
    joined = docs.join(bitmaps, same, "left")
    return _with_text(joined, line_dedup.kept_text(F.col("text"), F.col("keep_bitmap")))


@_stage(2)
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are similar, directly or by others, one row stays.

    Similar means that 80 percent of the shingles of five words are shared. The row with the smallest
    ``doc_id`` stays, of several with it the one with the smallest hash of the text, then one of the rows
    that agree in both; null ids come last. Texts without words are not similar to anything.
    """
    found = jaccard.similar_documents(docs, shingle=NEAR_WORDS, percent=NEAR_PERCENT)
    found = materialize(found, "similar")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    groups = found.where("component IS NOT NULL").groupBy("component").agg(
        least.alias("keeper"), F.count("*").alias("n")
    )
    members = found.join(groups.where("n > 1"), "component").select(
        F.col("doc_id").alias("_id"),
        F.col("row").alias("_row"),
        (F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("row") == F.col("keeper.row"))).alias("_keeps"),
    )
    members = materialize(members.distinct(), "copies")
    same = docs["doc_id"].eqNullSafe(members["_id"]) & (F.xxhash64(docs["text"]) == members["_row"])
    marked = docs.select(*COLUMNS).join(members, same, "left")
    alone = marked.where("_keeps IS NULL").select(*COLUMNS)
    keepers = marked.where("_keeps").dropDuplicates(["_id", "_row"]).select(*COLUMNS)
    return alone.unionByName(keepers)


@_stage(3)
def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the documents."""
    marked = dc.decontaminate(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))
    return _with_text(marked, F.col("clean"))


@_stage(4)
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and places in sequences."""
    return packing.pack(packing.token_pieces(docs, tokenizer_file()))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", remove_benchmark),
    ("packing", pack_sequences),
]

# Classifier and tokenizer are out of SQL's reach; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; of a stage's scratch and output nothing is left once the next one is written."""
    docs, written = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        begun = scratch_mark()
        docs = materialize(result, name)
        if written:
            remove_scratch(spark, *written, kept=docs.inputFiles())
        written = (begun, scratch_mark())
    return STAGES[-1][1](spark, docs, sf_dir)
