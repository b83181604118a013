"""People seen in the ``documents`` table: the record fixture, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.cleaning import clean_voters
from kinfold.plans.match import normalise_people

SPLIT = "[ \\t\\n\\r\\f]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_voters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw voter rows, all strings, as they would stand in a county file."""
    return voters_of(table(spark, sf_dir, "documents"))


def voters_of(documents: DataFrame) -> DataFrame:
    """Names are the first, the longest and the last word of the whole text."""
    words = F.split(F.trim("text"), SPLIT)
    longest = F.array_max(
        F.transform("_words", lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))
    )
    return (
        documents.withColumn("_words", words)
        .select(
            "doc_id",
            F.col("source").alias("dataset"),
            F.element_at("_words", 1).alias("first_name"),
            longest["w"].alias("middle_name"),
            F.element_at("_words", -1).alias("last_name"),
            F.upper("lang").alias("gender_code"),
            (F.lit(1900) + F.least(F.floor(F.col("n_chars") / 500), F.lit(100)))
            .cast("string")
            .alias("birth_year"),
            F.concat(F.lit(" City "), (F.col("doc_id") % 50).cast("string")).alias("res_city_desc"),
            F.concat(F.lit("NC "), F.lpad(F.col("doc_id").cast("string"), 5, "0"), F.lit("-1")).alias(
                "zip_code"
            ),
            F.col("source").alias("county_desc"),
        )
    )


RAW_SQL = """
raw AS (
  SELECT doc_id, source AS dataset,
         w[1] AS first_name, w[-1] AS last_name,
         list_max(list_transform(w, lambda x: {'n': length(x), 'w': x})).w AS middle_name,
         upper(lang) AS gender_code,
         CAST(1900 + least(floor(n_chars / 500), 100) AS INT)::VARCHAR AS birth_year,
         ' City ' || (doc_id % 50) AS res_city_desc,
         'NC ' || lpad(doc_id::VARCHAR, 5, '0') || '-1' AS zip_code,
         source AS county_desc
  FROM (SELECT *, string_split_regex(trim(text), '[ \\t\\n\\r\\f]+') AS w FROM documents)
)"""


def _token(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) NOT IN ('', 'nan', 'none', 'null', 'na') THEN lower(trim({c})) END"


def _name(c: str) -> str:
    titled = f"regexp_replace({_token(c)}, '^(mr|mrs|ms|dr)[ \\t\\n\\r\\f]+', '')"
    return f"nullif(regexp_replace({titled}, '[^a-z \\t\\n\\r\\f]', '', 'g'), '')"


CLEAN_SQL = (
    RAW_SQL
    + f""",
clean AS (
  SELECT doc_id, dataset,
         {_name('first_name')} AS first_name, {_name('middle_name')} AS middle_name,
         {_name('last_name')} AS last_name, {_token('gender_code')} AS gender_code,
         try_cast({_token('birth_year')} AS DOUBLE) AS birth_year,
         {_token('res_city_desc')} AS res_city_desc,
         nullif(regexp_extract({_token('zip_code')}, '([0-9]{{5}})', 1), '') AS zip_code,
         {_token('county_desc')} AS county_desc
  FROM raw
)"""
)

RECORDS_SQL = (
    CLEAN_SQL
    + """,
records AS (
  SELECT dataset || '_' || doc_id AS unique_id, first_name, middle_name, last_name, gender_code,
         birth_year, res_city_desc, zip_code, county_desc
  FROM clean
)"""
)

PEOPLE_SQL = (
    RECORDS_SQL
    + """,
people AS (
  SELECT unique_id, first_name, middle_name, last_name,
         nullif(trim(regexp_replace(concat_ws(' ', first_name, middle_name, last_name),
                '[ \\t\\n\\r\\f]+', ' ', 'g')), '') AS full_name,
         coalesce(first_name[1], '') AS first_initial,
         gender_code, CAST(birth_year AS SMALLINT) AS birth_year, county_desc
  FROM records
)"""
)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned records with the id ``{dataset}_{doc_id}``."""
    raw = raw_voters(spark, sf_dir)
    keyed = raw.select(F.concat_ws("_", "dataset", "doc_id").alias("unique_id"), *raw.columns[2:])
    return clean_voters(keyed)


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_people(records(spark, sf_dir)).select(
        "unique_id",
        "first_name",
        "middle_name",
        "last_name",
        "full_name",
        "first_initial",
        "gender_code",
        "birth_year",
        "county_desc",
    )
