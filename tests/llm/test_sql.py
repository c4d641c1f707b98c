"""Registered queries of the training-data operators against their SQL."""

import pytest
from compare import connect, differences, duckdb_result, spark_result

from __spark_entry__ import oracle_sql, queries
from twinshelf.llm.queries import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf_dir, name):
    assert oracle_sql()[name] == ORACLES[name]
    got = spark_result(queries()[name](spark, sf_dir))
    assert differences(got, duckdb_result(connect(sf_dir), ORACLES[name])) == ""
