"""Records in landed API responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys that may hold the records, in the order they are tried.
RECORD_KEYS = ("results", "data", "items")


def _list_at(page: Column, key: str | None = None) -> Column:
    path = "$" if key is None else f"$['{key}']"
    return F.try_variant_get(page, path, "array<variant>")


def api_records(body: Column, data_key: str | None = None) -> Column:
    """Array of records in one response body.

    With ``data_key`` the records are the list under that key, and none if the key is absent.
    Without, they are the body itself if it is a list, else the list under the first usual key
    that holds one, else the whole object as a single record.
    """
    page = F.try_parse_json(body)
    kind = F.schema_of_variant(page)
    if data_key is not None:
        there = F.variant_get(page, f"$['{data_key}']", "variant")
        return F.when(
            kind.startswith("OBJECT") & there.isNull(), F.array().cast("array<variant>")
        ).otherwise(
            F.coalesce(
                _list_at(page, data_key),
                F.raise_error(F.lit(f"API records under {data_key} are not a list")).cast(
                    "array<variant>"
                ),
            )
        )
    nested = F.coalesce(_list_at(page), *[_list_at(page, k) for k in RECORD_KEYS])
    return F.coalesce(
        nested,
        F.when(kind.startswith("OBJECT"), F.array(page)),
        F.raise_error(F.lit("unsupported API response")).cast("array<variant>"),
    )


def explode_api_records(
    pages: DataFrame, body: str = "body", data_key: str | None = None, record: str = "record"
) -> DataFrame:
    """One row per record, as JSON text in ``record``; the other page columns are repeated."""
    rest = [c for c in pages.columns if c != body]
    return pages.select(
        *rest, F.explode(api_records(F.col(body), data_key)).alias("_record")
    ).select(*rest, F.to_json("_record").alias(record))
