"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import pytest
from check_queries import compare, oracle

import __spark_entry__ as entry

BUILDERS, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return oracle(small)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0].avg_arr_delay_min >= rows[-1].avg_arr_delay_min


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(BUILDERS)


@pytest.mark.parametrize("name", list(BUILDERS))
def test_query(spark, con, small, name):
    result = compare(spark, con, name, BUILDERS[name], SQL.get(name), small)
    assert not result.startswith("FAIL"), result
