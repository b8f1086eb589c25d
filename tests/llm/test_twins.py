import pytest

from __spark_entry__ import queries
from flowscope.llm.oracle import ORACLE
from flowscope.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

# no SQL: held against brute force, round trips or held-out rows in this folder
NO_SQL = {"op2_language_id", "op3_quality", "op4_lm_score", "op6_binary_output", "op8_pack", "op9_jaccard_join", "op10_shard", "op12_variants"}


def test_all_are_registered():
    assert set(QUERIES) == set(ORACLE) | NO_SQL
    assert set(QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql_twin(spark, name):
    r = compare(spark, name, SF_SMALL, duck(SF_SMALL))
    assert r["cols_match"] and r["spark_rows"] == r["duck_rows"] and r["exact"], r
