"""The six source tables derived from the driver's TPC-H-shaped tables.

The derivation is the adapter-view contract of ``FIXTURES.md`` §3, written
as ``selectExpr`` projections over Spark reads of the driver tables, so
Spark and the SQL oracle see the same rows.  Every customer, order and line
is kept.  Misses are deliberate and made by moving foreign keys: every sixth
asset or session names a place that does not exist, every tenth an unknown
person, every fortieth result an unknown session, so every left join keeps
orphan rows, in the same share at any scale.  Places follow customers (15 to a
supplier), so their number grows with the data.  Free text holds quotes,
commas, newlines, padding and empty strings.

``nation`` and ``region`` are joined without a hint: they are file scans
whose size the planner reads from file metadata, and Spark broadcasts them
only under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks the
measured size at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the driver tables that the adapters read, with their Parquet
# types.  Reading with a declared schema skips the footer-inference job of
# every scan; the scan reads only these columns.
DRIVER_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}
DRIVER_TABLES = tuple(DRIVER_SCHEMAS)


# Keys are INT as in the warehouse DDL: the adapters fit driver tables whose
# customer and supplier keys stay below 2**31.
_PLACE = "CAST(CASE WHEN o_orderkey % 6 = 5 THEN -1 - o_custkey div 15 ELSE o_custkey div 15 END AS INT)"
_PERSON = "CAST(CASE WHEN o_orderkey % 10 = 9 THEN -1 - o_custkey ELSE o_custkey END AS INT)"


def _text(key: str) -> str:
    return (f"CASE ({key}) % 7 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN 'said \"hi\", then left' "
            f"WHEN 3 THEN CONCAT('two', chr(10), 'lines') WHEN 4 THEN '  padded  ' WHEN 5 THEN '\"' ELSE 'plain' END")


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def storage_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = driver_table(spark, sf_dir, "supplier")
    nation = driver_table(spark, sf_dir, "nation")
    region = driver_table(spark, sf_dir, "region")
    joined = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
              .join(region, nation.n_regionkey == region.r_regionkey))
    return joined.selectExpr(
        "CAST(s_suppkey AS INT) AS location_id",
        "r_name AS zone",
        "n_name AS rack",
        "CONCAT('S', CAST(s_suppkey % 3 + 1 AS STRING)) AS shelf",
        "s_acctbal >= 0 AS is_active",
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = driver_table(spark, sf_dir, "customer")
    nation = driver_table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "CAST(c_custkey AS INT) AS responsible_person_id",
        "c_name AS full_name",
        "c_mktsegment AS role",
        "n_name AS department",
        "CONCAT('+', CAST(c_custkey AS STRING)) AS contact",
        "CASE WHEN c_custkey % 2 = 0 THEN 'day' ELSE 'night' END AS shift",
    )


def equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "orders").selectExpr(
        "CONCAT('EQ', CAST(o_orderkey AS STRING)) AS equipment_id",
        "CONCAT('INV-', CAST(o_orderkey AS STRING)) AS inventory_number",
        "CONCAT(o_orderpriority, ' #', CAST(o_orderkey AS STRING)) AS name",
        "o_orderpriority AS category",
        "CONCAT('M', CAST(o_orderkey % 18 AS STRING)) AS model",
        "CONCAT('SN-', CAST(o_orderkey AS STRING)) AS serial_number",
        "CASE WHEN o_orderkey % 25 = 0 THEN 'retired' WHEN o_orderstatus = 'F' THEN 'working' "
        "WHEN o_orderstatus = 'O' THEN 'in_repair' ELSE 'reserve' END AS status",
        f"{_PLACE} AS location_id",
        "CAST(o_orderdate AS DATE) AS purchase_date",
        "date_add(CAST(o_orderdate AS DATE), CAST(365 * (2 + o_orderkey % 4) AS INT)) AS warranty_end_date",
        "date_add(CAST(o_orderdate AS DATE), CAST(90 + o_orderkey % 400 AS INT)) AS last_maintenance_date",
        "CASE WHEN o_orderkey % 50 = 7 THEN CAST(NULL AS DATE) "
        "ELSE date_add(CAST(o_orderdate AS DATE), CAST(170 + o_orderkey % 1500 AS INT)) END "
        "AS next_maintenance_date",
        f"{_PERSON} AS responsible_person_id",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) AS created_at",
    )


def inventory_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "orders").selectExpr(
        "CONCAT('INV-', CAST(o_orderkey AS STRING)) AS inventory_id",
        "CAST(o_orderdate AS DATE) AS session_date",
        f"{_PLACE} AS location_id",
        f"{_PERSON} AS responsible_person_id",
        "o_orderstatus AS status",
        "CAST(o_orderkey % 4 AS INT) AS discrepancy_count",
        f"{_text('o_orderkey')} AS notes",
    )


def inventory_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "lineitem").selectExpr(
        "CONCAT('RES', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS result_id",
        "CONCAT(CASE WHEN l_orderkey % 40 = 3 THEN 'LOST-' ELSE 'INV-' END, CAST(l_orderkey AS STRING)) "
        "AS inventory_id",
        "CONCAT('EQ', CAST(l_partkey AS STRING)) AS equipment_id",
        "CAST(l_suppkey AS INT) AS location_id",
        "CAST(CASE WHEN l_linenumber = 5 THEN 0 ELSE 1 END AS INT) AS expected_presence",
        "CAST(CASE WHEN l_linenumber = 7 THEN 2 WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS INT) "
        "AS actual_presence",
        "l_linestatus AS condition",
        "CASE WHEN l_partkey % 31 = 0 THEN CAST(NULL AS BOOLEAN) "
        "ELSE (l_linenumber = 7 OR l_returnflag = 'R') END AS discrepancy_flag",
        "l_returnflag AS discrepancy_type",
        f"{_text('l_orderkey + l_linenumber')} AS comment",
    )


def maintenance_logs(spark: SparkSession, sf_dir: str, conformed: bool = True) -> DataFrame:
    status = "maintenance_status" if conformed else "status"
    return driver_table(spark, sf_dir, "lineitem").selectExpr(
        "CONCAT('MNT', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS maintenance_id",
        "CONCAT('EQ', CAST(l_orderkey AS STRING)) AS equipment_id",
        "CAST(l_shipdate AS DATE) AS maintenance_date",
        "l_linestatus AS maintenance_type",
        "CAST(l_quantity AS DOUBLE) AS duration_hours",
        f"CASE l_returnflag WHEN 'A' THEN 'done' WHEN 'N' THEN 'planned' ELSE 'overdue' END AS {status}",
        "CAST(l_suppkey AS INT) AS responsible_person_id",
        "CAST(l_extendedprice AS DOUBLE) AS cost",
    )


_BUILDERS = {
    "equipment": equipment,
    "storage_locations": storage_locations,
    "employees": employees,
    "inventory_sessions": inventory_sessions,
    "inventory_results": inventory_results,
}


def source_table(spark: SparkSession, sf_dir: str, name: str, conformed: bool = True) -> DataFrame:
    """One of the six tables; ``conformed=False`` gives the raw layout."""
    if name == "maintenance_logs":
        return maintenance_logs(spark, sf_dir, conformed=conformed)
    return _BUILDERS[name](spark, sf_dir)


def source_tables(spark: SparkSession, sf_dir: str, conformed: bool = True) -> dict[str, DataFrame]:
    names = ("equipment", "storage_locations", "employees",
             "inventory_sessions", "inventory_results", "maintenance_logs")
    return {n: source_table(spark, sf_dir, n, conformed) for n in names}
