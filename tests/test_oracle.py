"""Every registered query with oracle SQL equals DuckDB on the sf0.01 tables."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"
SQL = E.oracle_sql()
NAMES = sorted(n for n in SQL if not n.startswith("op"))   # those of the training-data operators: tests/llm


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    status, n, _, msg = compare(spark, con, name, E.queries()[name], SQL[name], SF)
    assert status == "ok", msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["username", "similarity_score"]
    assert 0 < len(rows) <= 15
