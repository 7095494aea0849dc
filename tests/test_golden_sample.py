"""Golden totals of the original feed's sample (FIXTURES.md §2).

Point ``SHELFWISE_SAMPLE_DIR`` at the folder holding the six sample CSVs
(``equipment.csv`` ...); they are read as data only.  The full pipeline runs
on them with the original vocabulary and ``as_of = 2025-12-15``.
"""

from __future__ import annotations

import datetime as dt
import os

import pytest

from shelfwise import SOURCE_VOCAB
from shelfwise.config import LayerPaths
from shelfwise.plans import pipeline
from shelfwise.sources.landing import land_raw

SAMPLE = os.environ.get("SHELFWISE_SAMPLE_DIR", "")
pytestmark = pytest.mark.skipif(not os.path.isdir(SAMPLE) if SAMPLE else True,
                                reason="SHELFWISE_SAMPLE_DIR not set")


@pytest.fixture(scope="module")
def dm(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('golden')}"
    paths = LayerPaths.under(root)
    status = land_raw(spark, f"file://{SAMPLE}", paths.raw)
    assert set(status.values()) == {"landed"}
    out = pipeline.run(spark, paths, as_of="2025-12-15", vocab=SOURCE_VOCAB)
    return {k: v.collect() for k, v in out["dm"].items()}


def test_equipment_health(dm):
    rows = dm["equipment_health"]
    assert len(rows) == 110
    assert sum(r.maintenance_overdue for r in rows) == 85
    assert sum(r.warranty_days_left < 0 for r in rows) == 49
    assert sum(r.age_days for r in rows) == 122745
    assert sum(r.warranty_days_left for r in rows) == 14495
    assert sum(r.days_since_last_maintenance for r in rows) == 58805
    assert sum(r.days_to_next_maintenance for r in rows) == -42161
    eq1 = next(r for r in rows if r.equipment_id == "EQ0001")
    assert (eq1.age_days, eq1.warranty_days_left, eq1.days_since_last_maintenance,
            eq1.days_to_next_maintenance, eq1.maintenance_overdue) == (1398, -303, 1294, -1199, True)
    assert eq1.created_at == dt.datetime(2022, 2, 16, 11, 0)


def test_inventory_accuracy(dm):
    rows = dm["inventory_accuracy"]
    assert len(rows) == 10
    by_id: dict[str, list] = {}
    for r in rows:
        by_id.setdefault(r.inventory_id, []).append(
            (r.checked_equipment, r.discrepancies, r.actual_presence_sum, r.inventory_accuracy))
    assert by_id["INV-0902-02"] == [(2, 1, 3, 0.5)]
    assert by_id["INV-1208-06"] == [(2, 1, 1, 0.5)]
    assert by_id["INV-1213-08"] == [(1, 0, 1, 1.0)] * 3
    others = [v for k, vs in by_id.items() if k not in ("INV-0902-02", "INV-1208-06") for v in vs]
    assert all(v[3] == 1.0 for v in others)


def test_location_utilization(dm):
    rows = dm["location_utilization"]
    assert len(rows) == 42
    totals = [sum(getattr(r, c) for r in rows)
              for c in ("equipment_count", "working", "in_repair", "in_reserve")]
    assert totals == [110, 86, 8, 12]


def test_maintenance_summary(dm):
    rows = dm["maintenance_summary"]
    assert len(rows) == 110
    assert sum(r.maintenance_events for r in rows) == 227
    assert sum(r.overdue_events for r in rows) == 23
    assert round(sum(r.total_duration_hours for r in rows), 2) == 854.8
    assert round(sum(r.total_cost for r in rows), 2) == 3026160.33
    eq3 = next(r for r in rows if r.equipment_id == "EQ0003")
    assert (eq3.maintenance_events, eq3.overdue_events, round(eq3.total_duration_hours, 2),
            round(eq3.total_cost, 2), eq3.last_maintenance_date) == (3, 2, 9.7, 54355.03, dt.date(2025, 7, 10))


def test_responsible_load(dm):
    rows = {r.responsible_person_id: r for r in dm["responsible_load"]}
    assert len(rows) == 12
    assert (rows[10].assigned_equipment, rows[10].working, rows[10].in_repair) == (17, 13, 1)
    assert (rows[1].assigned_equipment, rows[1].working, rows[1].in_repair) == (5, 3, 2)
