"""Column mapping, column selection and run stamps."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns that record linkage works on.
LINKAGE_COLUMNS = (
    "first_name",
    "middle_name",
    "last_name",
    "gender_code",
    "birth_year",
    "res_city_desc",
    "zip_code",
    "county_desc",
)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def mapping_problems(mapping: Mapping[str, str], schema: T.StructType) -> list[str]:
    """All that keeps ``mapping`` (source by target) from being applied to rows of ``schema``.

    Decided from names alone, before any job; without problems the list is empty.
    """
    if not isinstance(mapping, Mapping) or not mapping:
        return [f"{mapping!r} names no target column with its source"]
    sources = Counter(schema.names)
    spellings = Counter(str(target).lower() for target in mapping)

    def of(target: object, source: object) -> Iterator[str]:
        if not isinstance(target, str) or not isinstance(source, str):
            yield "a name is a string"
        elif sources[source] != 1:
            yield "several columns have that name" if sources[source] else "no column has that name"
        if spellings[str(target).lower()] > 1:
            yield "another target differs only in case"

    return [
        f"{target!r} from {source!r}: {problem}"
        for target, source in mapping.items()
        for problem in of(target, source)
    ]


def apply_mapping(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """The mapped columns in mapping order, under their target names; without a mapping all, as is.

    One error tells all problems of a mapping.
    """
    if mapping is None:
        return df.select("*")
    if problems := mapping_problems(mapping, df.schema):
        raise ValueError("this mapping does not fit: " + "; ".join(problems))
    return df.select(*[F.col(_quoted(source)).alias(target) for target, source in mapping.items()])


def select_columns(df: DataFrame, columns: Sequence[str] = LINKAGE_COLUMNS) -> DataFrame:
    """Exactly these columns, in this order; an error names those that are missing."""
    return apply_mapping(df, {name: name for name in columns})


def drop_null_ids(df: DataFrame, id_col: str = "unique_id") -> DataFrame:
    return df.dropna(subset=[id_col])


def stamp_run(df: DataFrame, run_at: datetime, name: str = "pipeline_run_timestamp") -> DataFrame:
    """Add the run time, which the caller passes in so that a rerun gives the same rows."""
    return df.withColumn(name, F.lit(run_at).cast("timestamp"))


def union_all_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns that a frame lacks are null."""
    if not dfs:
        raise ValueError("nothing to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
