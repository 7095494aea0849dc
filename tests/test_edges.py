"""Edge semantics on hand-made frames of a few rows (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

import pytest

from shelfwise import SOURCE_VOCAB as SV
from shelfwise import schemas
from shelfwise.operators import rules
from shelfwise.operators.conform import conform, conform_observed, reject_counts
from shelfwise.plans import marts

AS_OF = dt.date(2025, 12, 15)
D = dt.date


def frame(spark, schema, rows):
    """Rows given as dicts; missing columns are NULL."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def asset(eid, **kw):
    base = {"equipment_id": eid, "category": "c", "status": SV.working, "location_id": 10,
            "responsible_person_id": 1, "purchase_date": D(2020, 1, 1),
            "warranty_end_date": D(2026, 1, 1), "last_maintenance_date": D(2025, 1, 1),
            "next_maintenance_date": D(2026, 1, 1)}
    base.update(kw)
    return base


@pytest.fixture
def places(spark):
    return frame(spark, schemas.STORAGE_LOCATIONS, [
        {"location_id": 10, "zone": "Z1", "rack": "RA", "shelf": "S1", "is_active": True},
        {"location_id": 20, "zone": "Z2", "rack": "RB", "shelf": "S2", "is_active": False},
        {"location_id": 30, "zone": "Z3", "rack": "RC", "shelf": "S3", "is_active": None},
    ])


@pytest.fixture
def people(spark):
    return frame(spark, schemas.EMPLOYEES, [
        {"responsible_person_id": 1, "full_name": "A", "role": "r", "department": "d",
         "contact": "+1", "shift": "day"},
        {"responsible_person_id": 2, "full_name": "B", "role": "r", "department": "d",
         "contact": "+2", "shift": "night"},
    ])


def session(iid, loc, count=0):
    return {"inventory_id": iid, "session_date": D(2025, 11, 1), "location_id": loc,
            "responsible_person_id": 1, "status": "s", "discrepancy_count": count}


def result(rid, iid, eid, loc, flag=False, actual=1, dtype=None):
    return {"result_id": rid, "inventory_id": iid, "equipment_id": eid, "location_id": loc,
            "expected_presence": 1, "actual_presence": actual, "discrepancy_flag": flag,
            "discrepancy_type": dtype}


def test_result_place_wins_over_session_place(spark, places):
    sessions = frame(spark, schemas.INVENTORY_SESSIONS, [session("I1", 20)])
    results = frame(spark, schemas.INVENTORY_RESULTS, [result("R1", "I1", "E1", 10)])
    rows = marts.inventory_accuracy(results, sessions, places).collect()
    assert [(r.zone, r.checked_equipment) for r in rows] == [("Z1", 1)]


def test_split_session_gives_one_row_per_place(spark, places):
    sessions = frame(spark, schemas.INVENTORY_SESSIONS, [session("I1", 10)])
    results = frame(spark, schemas.INVENTORY_RESULTS, [
        result("R1", "I1", "E1", 10), result("R2", "I1", "E2", 20), result("R3", "I1", "E3", 20)])
    rows = {r.zone: r.checked_equipment for r in
            marts.inventory_accuracy(results, sessions, places).collect()}
    assert rows == {"Z1": 1, "Z2": 2}


def test_null_flag_counts_zero(spark, places):
    sessions = frame(spark, schemas.INVENTORY_SESSIONS, [session("I1", 10)])
    results = frame(spark, schemas.INVENTORY_RESULTS, [
        result("R1", "I1", "E1", 10, flag=True), result("R2", "I1", "E2", 10, flag=None),
        result("R3", "I1", "E3", 10, flag=False)])
    (row,) = marts.inventory_accuracy(results, sessions, places).collect()
    assert (row.checked_equipment, row.discrepancies) == (3, 1)
    assert row.inventory_accuracy == pytest.approx(2 / 3)


def test_orphan_keys_are_kept(spark, places, people):
    eq = frame(spark, schemas.EQUIPMENT, [
        asset("E1", location_id=99, responsible_person_id=None), asset("E2")])
    health = {r.equipment_id: r for r in marts.equipment_health(eq, places, people, AS_OF).collect()}
    assert len(health) == 2
    assert health["E1"].zone is None and health["E1"].full_name is None
    assert health["E2"].zone == "Z1" and health["E2"].full_name == "A"
    util = {r.zone: r.equipment_count for r in marts.location_utilization(eq, places, SV).collect()}
    assert util == {None: 1, "Z1": 1}
    load = {r.responsible_person_id: (r.assigned_equipment, r.full_name)
            for r in marts.responsible_load(eq, people, SV).collect()}
    assert load == {None: (1, None), 1: (1, "A")}


def test_written_off_only_in_totals(spark, places, people):
    eq = frame(spark, schemas.EQUIPMENT, [
        asset("E1", status=SV.working), asset("E2", status=SV.in_repair),
        asset("E3", status=SV.written_off), asset("E4", status=SV.reserve)])
    (u,) = marts.location_utilization(eq, places, SV).collect()
    assert (u.equipment_count, u.working, u.in_repair, u.in_reserve) == (4, 1, 1, 1)
    (p,) = marts.responsible_load(eq, people, SV).collect()
    assert (p.assigned_equipment, p.working, p.in_repair) == (4, 1, 1)


def test_dates_against_as_of(spark, places, people):
    eq = frame(spark, schemas.EQUIPMENT, [
        asset("ON", next_maintenance_date=AS_OF),
        asset("NULL", next_maintenance_date=None),
        asset("EXP", warranty_end_date=AS_OF - dt.timedelta(days=1)),
        asset("AGE", purchase_date=AS_OF - dt.timedelta(days=1398))])
    r = {x.equipment_id: x for x in marts.equipment_health(eq, places, people, AS_OF).collect()}
    assert r["ON"].maintenance_overdue is False and r["ON"].days_to_next_maintenance == 0
    assert r["NULL"].maintenance_overdue is None and r["NULL"].days_to_next_maintenance is None
    assert r["EXP"].warranty_days_left == -1
    assert (r["AGE"].age_days, r["AGE"].age_years) == (1398, 3.83)


def test_assets_without_logs_absent(spark, people):
    eq = frame(spark, schemas.EQUIPMENT, [asset("E1"), asset("E2", responsible_person_id=1)])
    logs = frame(spark, schemas.MAINTENANCE_LOGS, [
        {"maintenance_id": "M1", "equipment_id": "E1", "maintenance_date": D(2025, 1, 1),
         "duration_hours": 2.5, "maintenance_status": SV.maint_overdue, "cost": 10.0},
        {"maintenance_id": "M2", "equipment_id": "E1", "maintenance_date": D(2025, 3, 1),
         "duration_hours": 1.0, "maintenance_status": SV.maint_done, "cost": 5.5}])
    (m,) = marts.maintenance_summary(logs, eq, SV).collect()
    assert (m.equipment_id, m.maintenance_events, m.overdue_events) == ("E1", 2, 1)
    assert (m.total_duration_hours, m.total_cost, m.last_maintenance_date) == (3.5, 15.5, D(2025, 3, 1))
    persons = {r.responsible_person_id for r in marts.responsible_load(eq, people, SV).collect()}
    assert persons == {1}


def test_duplicate_dimension_keys_match_join_first(spark, people):
    """Pre-aggregation before the join equals join-then-aggregate."""
    eq = frame(spark, schemas.EQUIPMENT, [asset("E1", category="a"), asset("E1", category="a"),
                                          asset("E1", category="b")])
    logs = frame(spark, schemas.MAINTENANCE_LOGS, [
        {"maintenance_id": "M1", "equipment_id": "E1", "maintenance_status": "x", "cost": 1.0},
        {"maintenance_id": "M2", "equipment_id": "E1", "maintenance_status": "x", "cost": 2.0}])
    got = {r.category: (r.maintenance_events, r.total_cost)
           for r in marts.maintenance_summary(logs, eq, SV).collect()}
    assert got == {"a": (4, 6.0), "b": (2, 3.0)}


def test_bad_text_becomes_null_and_counts_as_reject(spark):
    text = spark.createDataFrame(
        [("E1", "abc", "2024-13-01", "True", "2022-02-16T11:00:00.000"),
         ("E2", "7", "2024-01-02", "", "")],
        "equipment_id string, location_id string, purchase_date string, x string, created_at string")
    raw = text.selectExpr(*[f"CAST(NULL AS STRING) AS `{c}`" if c not in text.columns else f"`{c}`"
                            for c in schemas.EQUIPMENT.fieldNames()])
    rows = {r.equipment_id: r for r in conform("equipment", raw).collect()}
    assert rows["E1"].location_id is None and rows["E1"].purchase_date is None
    assert rows["E1"].created_at == dt.datetime(2022, 2, 16, 11, 0)
    assert rows["E2"].location_id == 7 and rows["E2"].purchase_date == D(2024, 1, 2)
    assert rows["E2"].created_at is None
    rej = {r.column_name: r.rejected_values for r in reject_counts("equipment", raw).collect()}
    assert rej["location_id"] == 1 and rej["purchase_date"] == 1 and rej["created_at"] == 0


def test_maintenance_status_renamed_in_place(spark):
    text = spark.createDataFrame([tuple(["M1", "E1", "2025-01-01", "t", "1.5", "s", "3", "9.9"])],
                                 schemas.all_strings(schemas.MAINTENANCE_LOGS_RAW))
    out = conform("maintenance_logs", text)
    assert out.schema == schemas.MAINTENANCE_LOGS
    assert out.first().maintenance_status == "s"


def test_d1_flag_rule(spark):
    eq = frame(spark, schemas.EQUIPMENT, [asset("E1", location_id=10)])
    res = frame(spark, schemas.INVENTORY_RESULTS, [
        result("R1", "I1", "E1", 10, flag=False, actual=2),
        result("R2", "I1", "E1", 10, flag=True, actual=2),
        result("R3", "I1", "E1", 20, flag=None, actual=1),
        result("R4", "I1", "E9", 20, flag=False, actual=1)])
    got = {r.result_id: (r.flag_required, r.flag_violation)
           for r in rules.check_discrepancy_flags(res, eq).collect()}
    assert got == {"R1": (True, True), "R2": (True, False), "R3": (True, True), "R4": (False, False)}


def test_d2_moved(spark):
    eq = frame(spark, schemas.EQUIPMENT, [asset("E1", location_id=10)])
    res = frame(spark, schemas.INVENTORY_RESULTS, [
        result("R1", "I1", "E1", 20), result("R2", "I1", "E1", 10), result("R3", "I1", "E9", 20)])
    got = {r.result_id: r.item_moved for r in rules.item_moved(res, eq).collect()}
    assert got == {"R1": True, "R2": False, "R3": None}


def test_d3_reconcile(spark):
    sessions = frame(spark, schemas.INVENTORY_SESSIONS, [session("I1", 10, 2), session("I2", 10, 0)])
    res = frame(spark, schemas.INVENTORY_RESULTS, [
        result("R1", "I1", "E1", 10, flag=True), result("R2", "I1", "E2", 10, flag=False)])
    got = {r.inventory_id: (r.flagged_results, r.count_difference, r.is_reconciled)
           for r in rules.reconcile_sessions(sessions, res).collect()}
    assert got == {"I1": (1, 1, False), "I2": (0, 0, True)}


def test_d4_active_locations(places):
    assert [r.location_id for r in rules.active_locations(places).collect()] == [10]


def test_d5_followup(spark):
    res = frame(spark, schemas.INVENTORY_RESULTS, [
        result("R1", "I", "E", 1, flag=True, dtype=SV.type_surplus),
        result("R2", "I", "E", 1, flag=True, dtype=SV.type_moved),
        result("R3", "I", "E", 1, flag=True, dtype=SV.type_missing),
        result("R4", "I", "E", 1, flag=False, dtype=SV.type_none)])
    got = {r.result_id: r.followup_action for r in rules.with_followup_action(res, SV).collect()}
    assert got == {"R1": SV.action_recount, "R2": SV.action_recount,
                   "R3": SV.action_write_off, "R4": ""}


def test_conforming_while_counting_converts_each_value_once(spark):
    raw = spark.createDataFrame([("1", "a"), ("x", "b"), (" ", "c"), (None, "d"), (" 7 ", "e")], "location_id string, zone string")
    raw = raw.selectExpr("location_id", "zone", "zone AS rack", "zone AS shelf", "'true' AS is_active", "zone AS _corrupt_record")
    made, seen = conform_observed("storage_locations", raw)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("try_cast(trim(location_id") == 1 or \
        made._jdf.queryExecution().optimizedPlan().toString().lower().count("as int)") == 1
    assert made.schema == conform("storage_locations", raw).schema
    assert sorted(map(str, made.collect())) == sorted(map(str, conform("storage_locations", raw).collect()))
    assert seen.get == {"location_id": 1, "is_active": 0, "_corrupt_record": 5}
