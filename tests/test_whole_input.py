"""Queries that take every record, on a table larger than the sample sizes of the tests."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"  # 1,000 documents


@pytest.mark.parametrize("name", ["random_pair_levels", "random_pair_levels_of_all", "train_u"])
def test_every_record_is_paired(spark, name):
    assert compare(queries()[name](spark, SF), connect(SF), oracle_sql()[name]) is None


def test_pairs_grow_with_the_input(spark):
    def pairs(name):
        return queries()[name](spark, SF).agg({"n_pairs": "sum"}).first()[0]

    assert min(pairs("random_pair_levels_of_all"), pairs("random_pair_levels")) > 3000
