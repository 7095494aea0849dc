"""Explicit schemas for the six source tables and the five marts.

Column order is the warehouse DDL order; loads bind by position, so the
order here is part of the contract.  ``created_at`` is a wall-clock
timestamp (SQL ``TIMESTAMP`` without zone), hence ``TimestampNTZType``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B, DT, TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.DateType(),
    T.TimestampNTZType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


EQUIPMENT = _struct(
    ("equipment_id", S),
    ("inventory_number", S),
    ("name", S),
    ("category", S),
    ("model", S),
    ("serial_number", S),
    ("status", S),
    ("location_id", I),
    ("purchase_date", DT),
    ("warranty_end_date", DT),
    ("last_maintenance_date", DT),
    ("next_maintenance_date", DT),
    ("responsible_person_id", I),
    ("created_at", TS),
)

STORAGE_LOCATIONS = _struct(
    ("location_id", I),
    ("zone", S),
    ("rack", S),
    ("shelf", S),
    ("is_active", B),
)

EMPLOYEES = _struct(
    ("responsible_person_id", I),
    ("full_name", S),
    ("role", S),
    ("department", S),
    ("contact", S),
    ("shift", S),
)

INVENTORY_SESSIONS = _struct(
    ("inventory_id", S),
    ("session_date", DT),
    ("location_id", I),
    ("responsible_person_id", I),
    ("status", S),
    ("discrepancy_count", I),
    ("notes", S),
)

INVENTORY_RESULTS = _struct(
    ("result_id", S),
    ("inventory_id", S),
    ("equipment_id", S),
    ("location_id", I),
    ("expected_presence", I),
    ("actual_presence", I),
    ("condition", S),
    ("discrepancy_flag", B),
    ("discrepancy_type", S),
    ("comment", S),
)

# Raw maintenance logs carry ``status``; the conformed table renames it to
# ``maintenance_status`` (same position).
MAINTENANCE_LOGS_RAW = _struct(
    ("maintenance_id", S),
    ("equipment_id", S),
    ("maintenance_date", DT),
    ("maintenance_type", S),
    ("duration_hours", D),
    ("status", S),
    ("responsible_person_id", I),
    ("cost", D),
)
MAINTENANCE_LOGS = _struct(
    *[
        (("maintenance_status" if f.name == "status" else f.name), f.dataType)
        for f in MAINTENANCE_LOGS_RAW.fields
    ]
)

# Raw (source-zone) layout, keyed by table name.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "equipment": EQUIPMENT,
    "storage_locations": STORAGE_LOCATIONS,
    "employees": EMPLOYEES,
    "inventory_sessions": INVENTORY_SESSIONS,
    "inventory_results": INVENTORY_RESULTS,
    "maintenance_logs": MAINTENANCE_LOGS_RAW,
}

# Conformed (dds) layout.
CONFORMED_SCHEMAS: dict[str, T.StructType] = {
    **RAW_SCHEMAS,
    "maintenance_logs": MAINTENANCE_LOGS,
}

SOURCE_TABLES: tuple[str, ...] = tuple(RAW_SCHEMAS)

EQUIPMENT_HEALTH = _struct(
    ("responsible_person_id", I),
    ("location_id", I),
    *[(f.name, f.dataType) for f in EQUIPMENT.fields
      if f.name not in ("location_id", "responsible_person_id")],
    ("zone", S),
    ("rack", S),
    ("shelf", S),
    ("is_active", B),
    ("full_name", S),
    ("department", S),
    ("shift", S),
    ("age_days", I),
    ("age_years", D),
    ("warranty_days_left", I),
    ("days_since_last_maintenance", I),
    ("days_to_next_maintenance", I),
    ("maintenance_overdue", B),
)

INVENTORY_ACCURACY = _struct(
    ("inventory_id", S),
    ("session_date", DT),
    ("zone", S),
    ("rack", S),
    ("shelf", S),
    ("checked_equipment", L),
    ("discrepancies", L),
    ("actual_presence_sum", L),
    ("inventory_accuracy", D),
)

LOCATION_UTILIZATION = _struct(
    ("zone", S),
    ("rack", S),
    ("shelf", S),
    ("is_active", B),
    ("equipment_count", L),
    ("working", L),
    ("in_repair", L),
    ("in_reserve", L),
)

MAINTENANCE_SUMMARY = _struct(
    ("equipment_id", S),
    ("category", S),
    ("maintenance_events", L),
    ("overdue_events", L),
    ("total_duration_hours", D),
    ("total_cost", D),
    ("last_maintenance_date", DT),
)

RESPONSIBLE_LOAD = _struct(
    ("responsible_person_id", I),
    ("assigned_equipment", L),
    ("working", L),
    ("in_repair", L),
    ("full_name", S),
    ("role", S),
    ("department", S),
    ("contact", S),
    ("shift", S),
)

MART_SCHEMAS: dict[str, T.StructType] = {
    "equipment_health": EQUIPMENT_HEALTH,
    "inventory_accuracy": INVENTORY_ACCURACY,
    "location_utilization": LOCATION_UTILIZATION,
    "maintenance_summary": MAINTENANCE_SUMMARY,
    "responsible_load": RESPONSIBLE_LOAD,
}

MART_NAMES: tuple[str, ...] = tuple(MART_SCHEMAS)


def all_strings(schema: T.StructType) -> T.StructType:
    """Same column names, every column read as text (for try-cast conform)."""
    return T.StructType([T.StructField(f.name, S, True) for f in schema.fields])


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE ... (ddl)`` in Spark SQL."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
