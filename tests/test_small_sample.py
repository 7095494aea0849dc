"""Hand-made source files through the whole daily run, with the original vocabulary."""

from __future__ import annotations

import pytest

from shelfwise import SOURCE_VOCAB as SV
from shelfwise import schemas
from shelfwise.config import LayerPaths
from shelfwise.plans import pipeline

ROWS = {
    "storage_locations": [("10", "A", "r1", "s1", "True"), ("20", "B", "r2", "s2", "False")],
    "employees": [("1", "Ann, the \"chief\"", "role", "dep", "+1", "day")],
    "equipment": [
        ("EQ1", "I1", "n1", "cat", "m", "s", SV.working, "10", "2020-01-01", "2025-12-14", "2025-01-01", "2025-12-14",
         "1", "2020-01-01 00:00:00"),
        ("EQ2", "I2", "two\nlines", "cat", "m", "s", SV.in_repair, "99", "2020-01-01", "2026-01-01", "2025-01-01",
         "2025-12-15", "7", "2020-01-01 00:00:00"),
        ("EQ3", "I3", "n3", "cat", "m", "s", SV.working, "abc", "2024-13-01", "", "", "", "1", "")],
    "inventory_sessions": [("S1", "2025-12-01", "20", "1", "closed", "1", " padded ")],
    "inventory_results": [("R1", "S1", "EQ1", "10", "1", "0", "c", "True", "t", ""),
                          ("R2", "S1", "EQ2", "10", "1", "1", "c", "False", "t", "x"),
                          ("R3", "S9", "EQ3", "20", "1", "1", "c", "True", "t", "x")],
    "maintenance_logs": [("M1", "EQ1", "2025-01-01", "t", "1.5", "done", "1", "10.25"),
                         ("M2", "EQ1", "2025-02-01", "t", "2.0", SV.maint_overdue, "1", "1.0")],
}


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("small")
    (top / "src").mkdir()
    for name, rows in ROWS.items():
        lines = [",".join(schemas.RAW_SCHEMAS[name].fieldNames())]
        lines += [",".join('"' + v.replace('"', '""') + '"' if v else "" for v in r) for r in rows]
        (top / "src" / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    paths = LayerPaths.under(f"file://{top}/layers")
    out = pipeline.run(spark, paths, as_of="2025-12-15", source_root=f"file://{top}/src", checks=True)
    rejects = {(r.table_name, r.column_name): r.rejected_values
               for r in spark.read.parquet(f"{paths.dds}/_rejects").collect()}
    return {k: v.collect() for k, v in out["dm"].items()}, rejects, {k: v.collect() for k, v in out["dds"].items()}


def test_marts(layers):
    dm, _, dds = layers
    health = {r.equipment_id: r for r in dm["equipment_health"]}
    assert (health["EQ1"].zone, health["EQ1"].maintenance_overdue, health["EQ1"].warranty_days_left) == ("A", True, -1)
    assert health["EQ2"].zone is None and health["EQ2"].name == "two\nlines" and not health["EQ2"].maintenance_overdue
    accuracy = {(r.inventory_id, r.zone): r for r in dm["inventory_accuracy"]}
    assert accuracy["S1", "A"].inventory_accuracy == 0.5 and accuracy["S9", "B"].session_date is None
    places = {r.zone: (r.equipment_count, r.working, r.in_repair) for r in dm["location_utilization"]}
    assert places == {"A": (1, 1, 0), None: (2, 1, 1)}
    (summary,) = dm["maintenance_summary"]
    assert (summary.maintenance_events, summary.overdue_events, summary.total_cost) == (2, 1, 11.25)
    load = {r.responsible_person_id: (r.assigned_equipment, r.full_name) for r in dm["responsible_load"]}
    assert load == {1: (2, 'Ann, the "chief"'), 7: (1, None)}
    assert dds["inventory_sessions"][0].notes == " padded "


def test_checks_and_rejects(layers):
    dm, rejects, _ = layers
    checks = {r.rule: r.rows_flagged for r in dm["_checks"]}
    assert checks["flagged_without_session"] == 1 and checks["inactive_locations"] == 1
    assert checks["sessions_unreconciled"] == 0
    assert rejects["equipment", "location_id"] == 1 and rejects["equipment", "purchase_date"] == 1
    assert rejects["equipment", "_corrupt_record"] == 0
