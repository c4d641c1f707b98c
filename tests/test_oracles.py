"""Every registered query against its SQL."""

import pytest
from compare import connect, differences, duckdb_result, spark_result

from __spark_entry__ import entry, oracle_sql, queries
from twinshelf.checks.oracles import ORACLES
from twinshelf.checks.queries import QUERIES as FUNCTIONS

# those of the training-data operators are in tests/llm
QUERIES = {f.__name__: queries()[f.__name__] for f in FUNCTIONS}
# k-means and principal components have no SQL; see test_ann.py
WITHOUT_SQL = {"ivf_cells", "pca_knn"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_all_but_the_known_have_an_oracle():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, sf_dir, name):
    got = spark_result(QUERIES[name](spark, sf_dir))
    assert differences(got, duckdb_result(con, ORACLES[name])) == ""


def test_entry(spark):
    assert entry(spark).columns == ["category", "q_id", "db_id", "score", "rank"]
