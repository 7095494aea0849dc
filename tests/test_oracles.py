"""Every registered query equals its SQL oracle (DuckDB) on the driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck

from shelfwise.plans.registry import ORACLE_SQL as SQL
from shelfwise.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["zone", "rack", "shelf", "is_active", "equipment_count",
                          "working", "in_repair", "in_reserve"]
    assert df.count() > 0
