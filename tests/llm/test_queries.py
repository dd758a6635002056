"""Every query that SQL can express equals its DuckDB SQL."""

import pytest

from creatorlens.llm.queries import QUERIES, SQL
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(SQL))
def test_equals_sql(spark, name):
    status, rows, _, message = compare(spark, duck(SF), name, QUERIES[name], SQL[name], SF)
    assert status == "ok" and rows, message


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
