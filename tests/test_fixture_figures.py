"""Figures stated for the adapter views at sf0.01 (FIXTURES.md §3)."""

from __future__ import annotations

import pytest

from conftest import SF_MID
from shelfwise.plans import marts
from shelfwise.sources import adapters
from shelfwise.vocab import ADAPTER_VOCAB as V


@pytest.fixture(scope="module")
def t(spark):
    return adapters.source_tables(spark, SF_MID)


def test_health_figures(t):
    rows = marts.equipment_health(t["equipment"], t["storage_locations"], t["employees"],
                                  "2001-12-31").groupBy("maintenance_overdue").count().collect()
    counts = {r.maintenance_overdue: r["count"] for r in rows}
    assert sum(counts.values()) == 15000
    assert counts[True] == 9983 and counts[None] == 300


def test_accuracy_figures(t):
    acc = marts.inventory_accuracy(t["inventory_results"], t["inventory_sessions"],
                                   t["storage_locations"])
    assert acc.count() == 57171
    assert acc.filter("session_date IS NULL").count() == 1431


def test_utilization_figures(t):
    rows = marts.location_utilization(t["equipment"], t["storage_locations"], V).collect()
    assert len(rows) == 59
    (null_place,) = [r for r in rows if r.zone is None]
    assert (null_place.equipment_count, null_place.working, null_place.in_repair,
            null_place.in_reserve) == (2500, 784, 790, 826)


def test_summary_and_load_figures(t):
    assert marts.maintenance_summary(t["maintenance_logs"], t["equipment"], V).count() == 14743
    load = marts.responsible_load(t["equipment"], t["employees"], V)
    assert load.count() == 2455
    assert load.filter("full_name IS NULL").count() == 955


def test_nothing_is_cut_and_orphan_shares_hold(spark, t):
    """Every customer, order and line is kept; misses come from moved foreign keys."""
    for sf_dir in (SF_MID, "/root/testdata/sf0.1"):
        own = adapters.source_tables(spark, sf_dir)
        for name, base in (("employees", "customer"), ("inventory_sessions", "orders"), ("equipment", "orders"),
                           ("storage_locations", "supplier"), ("inventory_results", "lineitem")):
            assert own[name].count() == adapters.driver_table(spark, sf_dir, base).count()
        health = marts.equipment_health(own["equipment"], own["storage_locations"], own["employees"], "2001-12-31")
        shares = health.selectExpr("avg(int(zone IS NULL)) AS place", "avg(int(full_name IS NULL)) AS person").first()
        assert abs(shares.place - 1 / 6) < 0.002 and abs(shares.person - 0.1) < 0.002
