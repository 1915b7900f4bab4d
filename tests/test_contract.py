"""The registered queries against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tidemark.workload import all_queries
from tools.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


NAMES = sorted(all_queries())


def test_every_query_has_its_sql():
    assert set(NAMES) <= set(contract.queries())
    assert set(NAMES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns == ["month", "Month-Year", "Sales", "rolling_avg_3m", "mom_growth", "deviation_pct"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    problem, _ = compare(spark, con, name, FOLDER)
    assert problem in ("", "both empty")
