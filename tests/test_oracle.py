"""Every registered query with an oracle SQL text matches DuckDB on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(spark, name, QUERIES[name], SQL[name], SF, con)
    assert not problems, problems


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "count", "avg_magnitude", "max_magnitude", "avg_depth"]
    assert df.count() > 0
