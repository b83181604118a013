"""Stage outputs that are written once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "ignore") -> DataFrame:
    """Write ``df`` unless ``path`` already has data, and return what is there.

    The skip works per path, so give every dataset its own.
    """
    writer = df.write.mode(mode).format(fmt)
    reader = df.sparkSession.read.schema(df.schema).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
        reader = reader.option("header", True).option("escape", '"')
    writer.save(path)
    return reader.load(path)
