"""SQL oracles: for each registered query, an independent SQL text that
DuckDB (and Spark SQL) can run over the driver's tables.

Every text starts with the same six adapter CTEs (the six-table shape over
the driver tables) and then states the operator's semantics in plain
joins and GROUP BYs, without any of the library's plan rewrites.  DuckDB
types are pinned with casts (``SUM(int)`` is HUGEINT there, ``date_diff``
is BIGINT) so schemas compare equal.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .. import schemas

AS_OF_SQL = "DATE '2001-12-31'"

ADAPTER_CTES = """
storage_locations AS (
  SELECT CAST(s_suppkey AS INT) AS location_id, r_name AS zone, n_name AS rack,
         CONCAT('S', CAST(s_suppkey % 3 + 1 AS STRING)) AS shelf, s_acctbal >= 0 AS is_active
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
employees AS (
  SELECT CAST(c_custkey AS INT) AS responsible_person_id, c_name AS full_name, c_mktsegment AS role,
         n_name AS department, CONCAT('+', CAST(c_custkey AS STRING)) AS contact,
         CASE WHEN c_custkey % 2 = 0 THEN 'day' ELSE 'night' END AS shift
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
equipment AS (
  SELECT CONCAT('EQ', CAST(o_orderkey AS STRING)) AS equipment_id,
         CONCAT('INV-', CAST(o_orderkey AS STRING)) AS inventory_number,
         CONCAT(o_orderpriority, ' #', CAST(o_orderkey AS STRING)) AS name,
         o_orderpriority AS category, CONCAT('M', CAST(o_orderkey % 18 AS STRING)) AS model,
         CONCAT('SN-', CAST(o_orderkey AS STRING)) AS serial_number,
         CASE WHEN o_orderkey % 25 = 0 THEN 'retired' WHEN o_orderstatus = 'F' THEN 'working'
              WHEN o_orderstatus = 'O' THEN 'in_repair' ELSE 'reserve' END AS status,
         CAST(CASE WHEN o_orderkey % 6 = 5 THEN -1 - o_custkey // 15 ELSE o_custkey // 15 END AS INT) AS location_id,
         CAST(o_orderdate AS DATE) AS purchase_date,
         CAST(o_orderdate AS DATE) + CAST(365 * (2 + o_orderkey % 4) AS INT) AS warranty_end_date,
         CAST(o_orderdate AS DATE) + CAST(90 + o_orderkey % 400 AS INT) AS last_maintenance_date,
         CASE WHEN o_orderkey % 50 = 7 THEN NULL
              ELSE CAST(o_orderdate AS DATE) + CAST(170 + o_orderkey % 1500 AS INT) END AS next_maintenance_date,
         CAST(CASE WHEN o_orderkey % 10 = 9 THEN -1 - o_custkey ELSE o_custkey END AS INT) AS responsible_person_id,
         o_orderdate AS created_at
  FROM orders
),
inventory_sessions AS (
  SELECT CONCAT('INV-', CAST(o_orderkey AS STRING)) AS inventory_id, CAST(o_orderdate AS DATE) AS session_date,
         CAST(CASE WHEN o_orderkey % 6 = 5 THEN -1 - o_custkey // 15 ELSE o_custkey // 15 END AS INT) AS location_id,
         CAST(CASE WHEN o_orderkey % 10 = 9 THEN -1 - o_custkey ELSE o_custkey END AS INT) AS responsible_person_id,
         o_orderstatus AS status, CAST(o_orderkey % 4 AS INT) AS discrepancy_count,
         CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'said "hi", then left'
              WHEN 3 THEN 'two' || chr(10) || 'lines' WHEN 4 THEN '  padded  ' WHEN 5 THEN '"' ELSE 'plain' END AS notes
  FROM orders
),
inventory_results AS (
  SELECT CONCAT('RES', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS result_id,
         CONCAT(CASE WHEN l_orderkey % 40 = 3 THEN 'LOST-' ELSE 'INV-' END, CAST(l_orderkey AS STRING)) AS inventory_id,
         CONCAT('EQ', CAST(l_partkey AS STRING)) AS equipment_id, CAST(l_suppkey AS INT) AS location_id,
         CASE WHEN l_linenumber = 5 THEN 0 ELSE 1 END AS expected_presence,
         CASE WHEN l_linenumber = 7 THEN 2 WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS actual_presence,
         l_linestatus AS condition,
         CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE (l_linenumber = 7 OR l_returnflag = 'R') END AS discrepancy_flag,
         l_returnflag AS discrepancy_type, CASE (l_orderkey + l_linenumber) % 7 WHEN 0 THEN NULL WHEN 1 THEN ''
              WHEN 2 THEN 'said "hi", then left' WHEN 3 THEN 'two' || chr(10) || 'lines' WHEN 4 THEN '  padded  '
              WHEN 5 THEN '"' ELSE 'plain' END AS comment
  FROM lineitem
),
maintenance_logs AS (
  SELECT CONCAT('MNT', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS maintenance_id,
         CONCAT('EQ', CAST(l_orderkey AS STRING)) AS equipment_id, CAST(l_shipdate AS DATE) AS maintenance_date,
         l_linestatus AS maintenance_type, l_quantity AS duration_hours,
         CASE l_returnflag WHEN 'A' THEN 'done' WHEN 'N' THEN 'planned' ELSE 'overdue' END AS maintenance_status,
         CAST(l_suppkey AS INT) AS responsible_person_id, l_extendedprice AS cost
  FROM lineitem
)"""

def with_ctes(body: str, extra_ctes: str = "") -> str:
    ctes = ADAPTER_CTES + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body.strip()}"


def days_sql(start: str, end: str) -> str:
    """``end - start`` in days as INTEGER."""
    return f"CAST(date_diff('day', {start}, {end}) AS INTEGER)"


def exact_sum(expr: str) -> str:
    """The sum of doubles without rounding on the way: whole numbers of 2^-60, and
    one conversion of their digits."""
    return f"CAST(CAST(SUM(CAST({expr} * {2.0 ** 60!r} AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {2.0 ** 60!r}"


A = AS_OF_SQL

# Mart bodies as CTEs, reused by the digests of layers.
MART_CTES = f"""
m_equipment_health AS (
  SELECT e.responsible_person_id, e.location_id, e.equipment_id, e.inventory_number, e.name,
         e.category, e.model, e.serial_number, e.status, e.purchase_date, e.warranty_end_date,
         e.last_maintenance_date, e.next_maintenance_date, e.created_at,
         l.zone, l.rack, l.shelf, l.is_active, p.full_name, p.department, p.shift,
         {days_sql('e.purchase_date', A)} AS age_days,
         ROUND({days_sql('e.purchase_date', A)} / 365.0, 2) AS age_years,
         {days_sql(A, 'e.warranty_end_date')} AS warranty_days_left,
         {days_sql('e.last_maintenance_date', A)} AS days_since_last_maintenance,
         {days_sql(A, 'e.next_maintenance_date')} AS days_to_next_maintenance,
         e.next_maintenance_date < {A} AS maintenance_overdue
  FROM equipment e
  LEFT JOIN storage_locations l ON e.location_id = l.location_id
  LEFT JOIN employees p ON e.responsible_person_id = p.responsible_person_id
),
m_inventory_accuracy AS (
  SELECT r.inventory_id, s.session_date, l.zone, l.rack, l.shelf,
         COUNT(*) AS checked_equipment,
         CAST(SUM(CASE WHEN r.discrepancy_flag THEN 1 ELSE 0 END) AS BIGINT) AS discrepancies,
         CAST(SUM(r.actual_presence) AS BIGINT) AS actual_presence_sum,
         CASE WHEN COUNT(*) > 0
              THEN 1 - SUM(CASE WHEN r.discrepancy_flag THEN 1 ELSE 0 END) / COUNT(*) END
           AS inventory_accuracy
  FROM inventory_results r
  LEFT JOIN inventory_sessions s ON r.inventory_id = s.inventory_id
  LEFT JOIN storage_locations l ON r.location_id = l.location_id
  GROUP BY r.inventory_id, s.session_date, l.zone, l.rack, l.shelf
),
m_location_utilization AS (
  SELECT l.zone, l.rack, l.shelf, l.is_active, COUNT(*) AS equipment_count,
         CAST(SUM(CASE WHEN e.status = 'working' THEN 1 ELSE 0 END) AS BIGINT) AS working,
         CAST(SUM(CASE WHEN e.status = 'in_repair' THEN 1 ELSE 0 END) AS BIGINT) AS in_repair,
         CAST(SUM(CASE WHEN e.status = 'reserve' THEN 1 ELSE 0 END) AS BIGINT) AS in_reserve
  FROM equipment e LEFT JOIN storage_locations l ON e.location_id = l.location_id
  GROUP BY l.zone, l.rack, l.shelf, l.is_active
),
m_maintenance_summary AS (
  SELECT m.equipment_id, q.category, COUNT(*) AS maintenance_events,
         CAST(SUM(CASE WHEN m.maintenance_status = 'overdue' THEN 1 ELSE 0 END) AS BIGINT) AS overdue_events,
         {exact_sum('m.duration_hours')} AS total_duration_hours, {exact_sum('m.cost')} AS total_cost,
         MAX(m.maintenance_date) AS last_maintenance_date
  FROM maintenance_logs m
  LEFT JOIN (SELECT equipment_id, category FROM equipment) q ON m.equipment_id = q.equipment_id
  GROUP BY m.equipment_id, q.category
),
m_responsible_load AS (
  SELECT a.responsible_person_id, a.assigned_equipment, a.working, a.in_repair,
         p.full_name, p.role, p.department, p.contact, p.shift
  FROM (SELECT responsible_person_id, COUNT(*) AS assigned_equipment,
               CAST(SUM(CASE WHEN status = 'working' THEN 1 ELSE 0 END) AS BIGINT) AS working,
               CAST(SUM(CASE WHEN status = 'in_repair' THEN 1 ELSE 0 END) AS BIGINT) AS in_repair
        FROM equipment GROUP BY responsible_person_id) a
  LEFT JOIN employees p ON a.responsible_person_id = p.responsible_person_id
)"""

MART_NAMES = ("equipment_health", "inventory_accuracy", "location_utilization",
              "maintenance_summary", "responsible_load")
TABLE_NAMES = ("equipment", "storage_locations", "employees",
               "inventory_sessions", "inventory_results", "maintenance_logs")

RAW_MAINTENANCE = ("SELECT maintenance_id, equipment_id, maintenance_date, maintenance_type, "
                   "duration_hours, maintenance_status AS status, responsible_person_id, cost "
                   "FROM maintenance_logs")


def mart(name: str) -> str:
    return with_ctes(f"SELECT * FROM m_{name}", MART_CTES)


def table(name: str, raw: bool = False) -> str:
    if raw and name == "maintenance_logs":
        return with_ctes(RAW_MAINTENANCE)
    return with_ctes(f"SELECT * FROM {name}")


def _column_digest(no: int, name: str, kind: T.DataType) -> str:
    """One column's entry of ``digest_row`` as a DuckDB struct."""
    c, nothing = f'"{name}"', "CAST(NULL AS VARCHAR)"
    low = f"CAST(MIN({c}) AS VARCHAR)", f"CAST(MAX({c}) AS VARCHAR)"
    if kind == schemas.S:
        unit = f"LENGTH({c})"
    elif kind == schemas.B:
        unit, low = f"CAST({c} AS INT)", (nothing, nothing)
    elif kind == schemas.D:
        unit, low = f"ROUND({c} * 10000)", (nothing, nothing)
    elif isinstance(kind, T.NumericType):
        unit, low = c, (nothing, nothing)
    else:
        unit = None
    total = f"CAST(SUM(CAST({unit} AS DECIMAL(20,0))) AS VARCHAR)" if unit else nothing
    return (f"{{'column_no': {no}, 'n_values': COUNT({c}), 'total': {total}, "
            f"'low': {low[0]}, 'high': {low[1]}}}")


def digest(source: str, labels: dict[str, str], schema: T.StructType) -> str:
    """Every column of a table in schema order: counts, sum, least and greatest."""
    fixed = "".join(f"'{v}' AS {k}, " for k, v in labels.items())
    entries = ", ".join(_column_digest(i, f.name, f.dataType) for i, f in enumerate(schema.fields))
    return (f"SELECT {fixed}n_rows, UNNEST(entries, recursive := true) "
            f"FROM (SELECT COUNT(*) AS n_rows, [{entries}] AS entries FROM {source} s) d")


def raw_digests(label: str, **fixed: str) -> str:
    return "\nUNION ALL\n".join(
        digest(f"({RAW_MAINTENANCE})" if n == "maintenance_logs" else n, {**fixed, label: n}, s)
        for n, s in schemas.RAW_SCHEMAS.items())


def dds_digests(label: str, **fixed: str) -> str:
    return "\nUNION ALL\n".join(digest(n, {**fixed, label: n}, s) for n, s in schemas.CONFORMED_SCHEMAS.items())


def mart_digests(label: str, **fixed: str) -> str:
    return "\nUNION ALL\n".join(digest(f"m_{n}", {**fixed, label: n}, s) for n, s in schemas.MART_SCHEMAS.items())
