import pytest

from __spark_entry__ import entry, oracle_sql, queries
from flowscope.plans.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

ROWS_ONLY = {"shed_bernoulli"}


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"window_start", "window_end", "protocol", "bytes", "total_bytes", "share"}


def test_every_query_has_a_twin_or_is_rows_only():
    # the corpus operators, where present, state their own twins in tests/llm
    assert set(QUERIES) - set(oracle_sql()) == ROWS_ONLY
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROWS_ONLY))
def test_query_matches_sql_twin(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["cols_match"] and r["spark_rows"] == r["duck_rows"] and r["exact"], r
