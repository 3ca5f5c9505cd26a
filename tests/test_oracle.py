"""Every registered query with an oracle, against DuckDB on sf0.001."""

import pytest

from conftest import SF_SMALL
from oracle.sql import ALL_SQL
from oracle_check import compare, duck
from tidemark.queries import ALL_QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ALL_SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(ALL_QUERIES[name](spark, SF_SMALL), con, ALL_SQL[name])
    assert r["match"], r


def test_every_query_has_a_callable():
    assert set(ALL_SQL) <= set(ALL_QUERIES)
    rows_only = set(ALL_QUERIES) - set(ALL_SQL)
    assert rows_only == {"churn_scores", "churn_explanations", "prediction_report",
                         "prediction_table"}
