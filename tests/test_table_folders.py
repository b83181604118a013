"""Tables that are folders of files, as larger ones are."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("files", [1, 3])
def test_hashed_preparation_reads_every_file_of_a_folder(spark, tmp_path, files):
    rows = [(i, f"ann m{i} lee", "en", f"src{i % 2}", 12) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    docs.repartition(files).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["hashed_preparation"](spark, str(tmp_path))
    assert got.count() == 30
    assert got.select(F.countDistinct("unique_id")).first()[0] == 30
