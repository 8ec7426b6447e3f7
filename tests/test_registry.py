"""Every registered query against its DuckDB statement on the smallest data folder."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from check import compare, duck
from registry.base import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_each_query_has_a_statement_and_each_operator_a_query():
    names = set(QUERIES)
    assert names == set(ORACLES)
    assert names <= set(driver.queries()) and names <= set(driver.oracle_sql())
    ids = {name.split("_")[0] for name in names}
    wanted = {f"{group}{i}" for group, n in {"l": 9, "j": 13, "a": 5, "c": 29, "t": 8, "d": 18}.items() for i in range(1, n + 1)}
    assert wanted <= ids


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_duckdb(spark, con, name):
    same, note = compare(spark, con, SF, driver.queries()[name], driver.oracle_sql()[name])
    assert same, note


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
