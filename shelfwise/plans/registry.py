"""Every implemented operator as a query over the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (an
independent SQL statement of the same result) are what the driver checks.
All queries read the driver tables in full, derive the six-table shape with
Spark, and run the operator over the whole of it; queries of sources and
sinks first write that data to a fresh folder under the session's shared
checkpoint dir, then read it back through the operator under test.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..actions import run_concurrently
from ..config import LayerPaths, scratch_uri
from ..operators import aggregates as agg
from ..operators import rules
from ..operators.conform import conform, reject_counts
from ..operators.digest import column_digest
from ..operators.joins import enrich
from ..operators.order import order_digest
from ..sinks import files, publish
from ..sinks.buckets import bucketed
from ..sinks.warehouse import WAREHOUSE_LAYERS, layer_sources, load_layers
from ..sources import adapters
from ..sources.contract import type_report
from ..sources.csv_scan import load_raw, raw_uri, read_csv_export, scan_inferred, scan_table
from ..sources.landing import land_raw, probe_source
from ..vocab import ADAPTER_VOCAB as V
from . import marts
from . import oracle as O
from .pipeline import build_dds, build_dm, stage_driver_tables

AS_OF = "2001-12-31"

#: Tables of a row per line: a source of theirs that is also landed is compressed.
PACKED = ("inventory_results", "maintenance_logs")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return adapters.source_table(spark, sf_dir, name)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _staged_raw(spark: SparkSession, sf_dir: str, tables=schemas.SOURCE_TABLES, tag="raw") -> str:
    return stage_driver_tables(spark, sf_dir, scratch_uri(spark, tag), tables)


def _digests(frames: dict[str, DataFrame], label: str, **fixed: str) -> DataFrame:
    """What each column of each table holds: a shifted or altered column shows."""
    return _union([
        column_digest(df).select(*[F.lit(v).alias(k) for k, v in fixed.items()], F.lit(n).alias(label), "*")
        for n, df in frames.items()])


# --- 2.1 sources -------------------------------------------------------------

def _scan_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _staged_raw(spark, sf_dir, (name,), f"scan-{name}")
        return scan_table(spark, root, name, typed=True)
    return q


for _name in schemas.SOURCE_TABLES:
    register(f"scan_{_name}", O.table(_name, raw=True))(_scan_query(_name))


@register("scan_infer_schema", O.table("maintenance_logs", raw=True))
def scan_infer_schema(spark, sf_dir):
    root = _staged_raw(spark, sf_dir, ("maintenance_logs",), "infer")
    return scan_inferred(spark, root, "maintenance_logs")


@register("load_raw_bundle", O.with_ctes(O.raw_digests("table_name")))
def load_raw_bundle(spark, sf_dir):
    return _digests(load_raw(spark, _staged_raw(spark, sf_dir, tag="bundle")), "table_name")


@register("land_raw", O.with_ctes(O.raw_digests("table_name", status="landed")))
def land_raw_query(spark, sf_dir):
    """The large tables' sources are compressed and land decompressed, the others land as they are."""
    source = stage_driver_tables(spark, sf_dir, scratch_uri(spark, "source"), packed=PACKED)
    raw = scratch_uri(spark, "landed")
    status = land_raw(spark, source, raw)
    bundle = load_raw(spark, raw)
    return _union([_digests({n: bundle[n]}, "table_name", status=s) for n, s in status.items()])


@register("scan_csv_export", O.mart("equipment_health"))
def scan_csv_export(spark, sf_dir):
    t = adapters.source_tables(spark, sf_dir)
    mart = marts.equipment_health(t["equipment"], t["storage_locations"], t["employees"], AS_OF)
    layer = scratch_uri(spark, "dm")
    files.write_dataset(spark, mart, layer, "equipment_health")
    return read_csv_export(spark, files.dataset_uris(layer, "equipment_health")[1],
                           schemas.EQUIPMENT_HEALTH)


_PROBE_SQL = O.with_ctes("\nUNION ALL\n".join(
    f"SELECT '{n}' AS source, COUNT(*) AS n_rows, LEAST(COUNT(*), 5) AS sample_rows FROM {n}"
    for n in O.TABLE_NAMES))


@register("probe_source", _PROBE_SQL)
def probe_source_query(spark, sf_dir):
    root = _staged_raw(spark, sf_dir, tag="probe")
    return _union([probe_source(spark, raw_uri(root, n)) for n in schemas.SOURCE_TABLES])


# --- 2.2 sinks ---------------------------------------------------------------

@register("sink_parquet", O.table("equipment"))
def sink_parquet(spark, sf_dir):
    uri = files.write_parquet(_t(spark, sf_dir, "equipment"), scratch_uri(spark, "parquet"))
    return spark.read.parquet(uri)


@register("sink_csv_single", O.table("maintenance_logs"))
def sink_csv_single(spark, sf_dir):
    """One export that reads back as one table, in parts of a bounded number of rows."""
    uri = files.write_csv(_t(spark, sf_dir, "maintenance_logs"), scratch_uri(spark, "csv1"),
                          max_records=1_000_000)
    return read_csv_export(spark, uri, schemas.MAINTENANCE_LOGS)


@register("sink_dataset", O.mart("inventory_accuracy"))
def sink_dataset(spark, sf_dir):
    mart = marts.inventory_accuracy(_t(spark, sf_dir, "inventory_results"),
                                    _t(spark, sf_dir, "inventory_sessions"),
                                    _t(spark, sf_dir, "storage_locations"))
    return files.write_dataset(spark, mart, scratch_uri(spark, "dm"), "inventory_accuracy")


def _layers(spark, sf_dir) -> LayerPaths:
    paths = LayerPaths.under(scratch_uri(spark, "layers"))
    stage_driver_tables(spark, sf_dir, paths.raw, packed=schemas.SOURCE_TABLES)  # plain, it takes more disk than all that is made of it
    return paths


@register("build_dds", O.with_ctes(O.dds_digests("table_name")))
def build_dds_query(spark, sf_dir):
    return _digests(build_dds(spark, _layers(spark, sf_dir)), "table_name")


@register("build_dm", O.with_ctes(O.mart_digests("mart_name"), O.MART_CTES))
def build_dm_query(spark, sf_dir):
    paths = _layers(spark, sf_dir)
    dm = build_dm(spark, build_dds(spark, paths), paths, as_of=AS_OF, vocab=V)
    return _digests(dm, "mart_name")


_WAREHOUSE_SQL = O.with_ctes("\nUNION ALL\n".join([
    O.raw_digests("table_name", layer="dds_stg"), O.dds_digests("table_name", layer="dds"),
    O.mart_digests("table_name", layer="dm")]), O.MART_CTES)


def _of_own_databases(spark: SparkSession, load: Callable[[str], list[str]]) -> DataFrame:
    """Digests of all warehouse tables after ``load(prefix)``.  The databases are the
    query's own, since a shared catalog keeps what it has, and go once the digests
    (a row per column) are written."""
    prefix = f"shelfwise_check_{uuid.uuid4().hex[:12]}_"
    names = {"dds_stg": schemas.SOURCE_TABLES, "dds": schemas.SOURCE_TABLES, "dm": schemas.MART_NAMES}
    try:
        load(prefix)
        found = _union([
            _digests({n: spark.table(f"`{prefix}{layer}`.`{n}`") for n in names[layer]}, "table_name", layer=layer)
            for layer in WAREHOUSE_LAYERS])
        uri = files.write_parquet(found.coalesce(1), scratch_uri(spark, "warehouse-digests"))
        return spark.read.schema(found.schema).parquet(uri)
    finally:
        for layer in WAREHOUSE_LAYERS:
            spark.sql(f"DROP DATABASE IF EXISTS `{prefix}{layer}` CASCADE")


@register("warehouse_load", _WAREHOUSE_SQL)
def warehouse_load(spark, sf_dir):
    paths = _layers(spark, sf_dir)
    build_dm(spark, build_dds(spark, paths), paths, as_of=AS_OF, vocab=V)
    root = scratch_uri(spark, "warehouse")
    return _of_own_databases(spark, lambda prefix: load_layers(spark, paths, warehouse_root=root, prefix=prefix))


@register("warehouse_publish", _WAREHOUSE_SQL)
def warehouse_publish(spark, sf_dir):
    """All 17 tables as generations: a first one without rows, for which the views are
    made, and the second, which they show after its switch."""
    paths = _layers(spark, sf_dir)
    build_dm(spark, build_dds(spark, paths), paths, as_of=AS_OF, vocab=V)
    root = scratch_uri(spark, "published")
    sources = layer_sources(spark, paths)
    publish.publish(spark, {layer: {n: (df.limit(0), schema) for n, (df, schema) in held.items()}
                            for layer, held in sources.items()}, root)

    def load(prefix: str) -> list[str]:
        views = publish.create_views(spark, sources, root, prefix)
        publish.publish(spark, sources, root)
        return views
    return _of_own_databases(spark, load)


@register("bucketed_marts", O.with_ctes("\nUNION ALL\n".join(
    O.digest(f"m_{n}", {"mart_name": n}, schemas.MART_SCHEMAS[n]) for n in ("inventory_accuracy", "maintenance_summary")),
    O.MART_CTES))
def bucketed_marts(spark, sf_dir):
    """M2 and M4 over conformed facts in buckets."""
    database = f"shelfwise_check_{uuid.uuid4().hex[:12]}"
    try:
        plain = adapters.source_tables(spark, sf_dir)
        t = bucketed(spark, plain, database, scratch_uri(spark, "buckets"), buckets=8)
        found = _digests({
            "inventory_accuracy": marts.inventory_accuracy(
                t["inventory_results"], t["inventory_sessions"], t["storage_locations"],
                dealt=t["inventory_results"] is not plain["inventory_results"]),
            "maintenance_summary": marts.maintenance_summary(
                t["maintenance_logs"], t["equipment"], V,
                dealt=t["maintenance_logs"] is not plain["maintenance_logs"])}, "mart_name")
        uri = files.write_parquet(found.coalesce(1), scratch_uri(spark, "bucketed-digests"))
        return spark.read.schema(found.schema).parquet(uri)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


# --- 2.3 conform, projections, predicates -------------------------------------

def _conform_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _staged_raw(spark, sf_dir, (name,), f"conform-{name}")
        return conform(name, scan_table(spark, root, name, typed=False))
    return q


for _name in schemas.SOURCE_TABLES:
    register(f"conform_{_name}", O.table(_name))(_conform_query(_name))


_DUCK_TYPES = {"int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
               "timestamp_ntz": "TIMESTAMP"}


def _typed(name: str) -> list[tuple[str, str, str]]:
    """Columns that conforming converts: (name, type, digit).  A tenth to a
    seventh of a column's values is spoilt: those of the rows whose key ends in
    its digit."""
    kinds = [(f.name, f.dataType.simpleString()) for f in schemas.RAW_SCHEMAS[name].fields]
    return [(c, kind, str(i % 7 + 1)) for i, (c, kind) in enumerate(k for k in kinds if k[1] != "string")]


def _spoilt(name: str, raw: DataFrame) -> DataFrame:
    """The raw table as text, with values that do not convert."""
    last = F.right(F.col(raw.columns[0]).cast("string"), F.lit(1))
    return raw.withColumns({
        c: F.when(last == digit, F.concat(F.lit("x"), F.col(c).cast("string"))).otherwise(F.col(c).cast("string"))
        for c, _, digit in _typed(name)})


def _rejects_sql() -> str:
    parts = []
    for name, schema in schemas.RAW_SCHEMAS.items():
        src = "(" + O.RAW_MAINTENANCE + ")" if name == "maintenance_logs" else name
        key = schema.fields[0].name
        for c, kind, digit in _typed(name):
            parts.append(
                f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
                f"CAST(COALESCE(SUM(CASE WHEN {c} IS NOT NULL AND "
                f"TRY_CAST(CASE WHEN RIGHT(CAST({key} AS VARCHAR), 1) = '{digit}' THEN 'x' ELSE '' END "
                f"|| CAST({c} AS VARCHAR) AS {_DUCK_TYPES[kind]}) IS NULL "
                f"THEN 1 ELSE 0 END), 0) AS BIGINT) AS rejected_values FROM {src} s")
        parts.append(f"SELECT '{name}' AS table_name, '_corrupt_record' AS column_name, COUNT(*) AS rejected_values "
                     "FROM nation")
    return O.with_ctes("\nUNION ALL\n".join(parts))


def _broken_part(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lines of one more part: a header, and a record of two fields per nation."""
    header = spark.range(1).select(F.lit(",".join(schemas.RAW_SCHEMAS[name].fieldNames())).alias("value"))
    return header.union(spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.lit(",").alias("value"))).coalesce(1)


@register("conform_rejects", _rejects_sql())
def conform_rejects(spark, sf_dir):
    """Spoilt values and broken records of landed sources: counted, not lost."""
    source, root = scratch_uri(spark, "rejects-source"), scratch_uri(spark, "rejects")

    def stage(n: str) -> None:
        files.write_csv(_spoilt(n, adapters.source_table(spark, sf_dir, n, conformed=False)), raw_uri(source, n),
                        compression="gzip" if n in PACKED else "none")
        _broken_part(spark, sf_dir, n).write.mode("append").text(raw_uri(source, n))

    run_concurrently({n: (lambda n=n: stage(n)) for n in schemas.SOURCE_TABLES})
    land_raw(spark, source, root)
    return _union([reject_counts(n, scan_table(spark, root, n, typed=False))
                   for n in schemas.SOURCE_TABLES])


def _contract_sql() -> str:
    parts = []
    for name, schema in schemas.RAW_SCHEMAS.items():
        src = "(" + O.RAW_MAINTENANCE + ")" if name == "maintenance_logs" else name
        key = schema.fields[0].name
        for c, kind, digit in _typed(name):
            odd = f"COUNT(CASE WHEN RIGHT(CAST({key} AS VARCHAR), 1) = '{digit}' THEN {c} END)"
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{kind}' AS declared, "
                         f"CASE WHEN COUNT({c}) = 0 THEN 'void' WHEN {odd} > 0 THEN 'string' ELSE '{kind}' END AS inferred, "
                         f"COUNT({c}) AS n_values, {odd} AS n_conflicts FROM {src} s")
    return O.with_ctes("\nUNION ALL\n".join(parts))


@register("scan_contract", _contract_sql())
def scan_contract(spark, sf_dir):
    """Typed columns whose values are partly spoilt: named, with the inferred type."""
    root = scratch_uri(spark, "contract")
    run_concurrently({n: (lambda n=n: files.write_csv(
        _spoilt(n, adapters.source_table(spark, sf_dir, n, conformed=False)), raw_uri(root, n))) for n in schemas.SOURCE_TABLES})
    return _union([type_report(spark, root, n).where("declared <> 'string'").drop("example")
                   for n in schemas.SOURCE_TABLES])


@register("project_employee_dim",
          O.with_ctes("SELECT responsible_person_id, full_name, department, shift FROM employees"))
def project_employee_dim(spark, sf_dir):
    return marts.employee_dim(_t(spark, sf_dir, "employees"))


@register("project_equipment_dim", O.with_ctes("SELECT equipment_id, category FROM equipment"))
def project_equipment_dim(spark, sf_dir):
    return marts.equipment_category_dim(_t(spark, sf_dir, "equipment"))


A = O.AS_OF_SQL


def _dates(spark, sf_dir, cols: list[str]) -> DataFrame:
    return marts.with_equipment_dates(_t(spark, sf_dir, "equipment"), AS_OF).select(*cols)


@register("derive_equipment_age", O.with_ctes(
    f"SELECT equipment_id, purchase_date, {O.days_sql('purchase_date', A)} AS age_days, "
    f"ROUND({O.days_sql('purchase_date', A)} / 365.0, 2) AS age_years FROM equipment"))
def derive_equipment_age(spark, sf_dir):
    return _dates(spark, sf_dir, ["equipment_id", "purchase_date", "age_days", "age_years"])


@register("derive_warranty_left", O.with_ctes(
    f"SELECT equipment_id, warranty_end_date, {O.days_sql(A, 'warranty_end_date')} AS warranty_days_left "
    "FROM equipment"))
def derive_warranty_left(spark, sf_dir):
    return _dates(spark, sf_dir, ["equipment_id", "warranty_end_date", "warranty_days_left"])


@register("derive_maintenance_days", O.with_ctes(
    f"SELECT equipment_id, last_maintenance_date, next_maintenance_date, "
    f"{O.days_sql('last_maintenance_date', A)} AS days_since_last_maintenance, "
    f"{O.days_sql(A, 'next_maintenance_date')} AS days_to_next_maintenance FROM equipment"))
def derive_maintenance_days(spark, sf_dir):
    return _dates(spark, sf_dir, ["equipment_id", "last_maintenance_date", "next_maintenance_date",
                                  "days_since_last_maintenance", "days_to_next_maintenance"])


@register("flag_maintenance_overdue", O.with_ctes(
    f"SELECT equipment_id, next_maintenance_date, next_maintenance_date < {A} AS maintenance_overdue "
    "FROM equipment"))
def flag_maintenance_overdue(spark, sf_dir):
    return _dates(spark, sf_dir, ["equipment_id", "next_maintenance_date", "maintenance_overdue"])


# --- 2.4 joins ---------------------------------------------------------------

@register("join_equipment_location", O.with_ctes(
    "SELECT e.*, l.zone, l.rack, l.shelf, l.is_active FROM equipment e "
    "LEFT JOIN storage_locations l ON e.location_id = l.location_id"))
def join_equipment_location(spark, sf_dir):
    return enrich(_t(spark, sf_dir, "equipment"), _t(spark, sf_dir, "storage_locations"), "location_id")


@register("join_equipment_employee", O.with_ctes(
    "SELECT e.*, p.full_name, p.department, p.shift FROM equipment e "
    "LEFT JOIN employees p ON e.responsible_person_id = p.responsible_person_id"))
def join_equipment_employee(spark, sf_dir):
    return enrich(_t(spark, sf_dir, "equipment"), marts.employee_dim(_t(spark, sf_dir, "employees")),
                  "responsible_person_id")


_RESULT_SESSION = ("SELECT r.*, s.session_date, s.responsible_person_id, s.status, "
                   "s.discrepancy_count, s.notes FROM inventory_results r "
                   "LEFT JOIN inventory_sessions s ON r.inventory_id = s.inventory_id")


@register("join_results_session", O.with_ctes(_RESULT_SESSION))
def join_results_session(spark, sf_dir):
    return marts.results_with_session(_t(spark, sf_dir, "inventory_results"),
                                      _t(spark, sf_dir, "inventory_sessions"))


@register("join_results_location", O.with_ctes(
    f"SELECT rs.*, l.zone, l.rack, l.shelf, l.is_active FROM ({_RESULT_SESSION}) rs "
    "LEFT JOIN storage_locations l ON rs.location_id = l.location_id"))
def join_results_location(spark, sf_dir):
    with_session = marts.results_with_session(_t(spark, sf_dir, "inventory_results"),
                                              _t(spark, sf_dir, "inventory_sessions"))
    return enrich(with_session, _t(spark, sf_dir, "storage_locations"), "location_id")


@register("join_utilization_location", O.with_ctes(
    "SELECT a.location_id, a.equipment_count, l.zone, l.rack, l.shelf, l.is_active FROM (SELECT location_id, "
    "COUNT(*) AS equipment_count FROM equipment GROUP BY location_id) a "
    "LEFT JOIN storage_locations l ON a.location_id = l.location_id"))
def join_utilization_location(spark, sf_dir):
    """M3's join: counts per place, left to the planner to join with the places."""
    per_place = agg.count_rows(_t(spark, sf_dir, "equipment"), ["location_id"], "equipment_count")
    return enrich(per_place, _t(spark, sf_dir, "storage_locations"), "location_id", broadcast="auto")


@register("join_maintenance_equipment", O.with_ctes(
    "SELECT m.*, q.category FROM maintenance_logs m "
    "LEFT JOIN (SELECT equipment_id, category FROM equipment) q ON m.equipment_id = q.equipment_id"))
def join_maintenance_equipment(spark, sf_dir):
    return enrich(_t(spark, sf_dir, "maintenance_logs"),
                  marts.equipment_category_dim(_t(spark, sf_dir, "equipment")), "equipment_id",
                  broadcast="auto")


@register("join_load_employee", O.with_ctes(
    "SELECT a.responsible_person_id, a.assigned_equipment, p.full_name, p.role, p.department, "
    "p.contact, p.shift FROM (SELECT responsible_person_id, COUNT(*) AS assigned_equipment "
    "FROM equipment GROUP BY responsible_person_id) a "
    "LEFT JOIN employees p ON a.responsible_person_id = p.responsible_person_id"))
def join_load_employee(spark, sf_dir):
    per_person = agg.count_rows(_t(spark, sf_dir, "equipment"), ["responsible_person_id"],
                                "assigned_equipment")
    return enrich(per_person, _t(spark, sf_dir, "employees"), "responsible_person_id")


# --- 2.5 aggregations -----------------------------------------------------------

def _cnt(pred: str) -> str:
    return f"CAST(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT)"


def _eq(col: str, value: str) -> str:
    return f"{col} = '{value}'"


@register("agg_count", O.with_ctes(
    "SELECT location_id, COUNT(*) AS equipment_count FROM equipment GROUP BY location_id"))
def agg_count(spark, sf_dir):
    return agg.count_rows(_t(spark, sf_dir, "equipment"), ["location_id"], "equipment_count")


@register("agg_flag_count", O.with_ctes(
    f"SELECT inventory_id, {_cnt('discrepancy_flag')} AS discrepancies "
    "FROM inventory_results GROUP BY inventory_id"))
def agg_flag_count(spark, sf_dir):
    return agg.result_counts(_t(spark, sf_dir, "inventory_results"), ["inventory_id"]) \
        .select("inventory_id", "discrepancies")


@register("agg_conditional_count", O.with_ctes(
    f"SELECT location_id, {_cnt(_eq('status', 'working'))} AS working, "
    f"{_cnt(_eq('status', 'in_repair'))} AS in_repair, "
    f"{_cnt(_eq('status', 'reserve'))} AS in_reserve "
    "FROM equipment GROUP BY location_id"))
def agg_conditional_count(spark, sf_dir):
    return agg.equipment_status_counts(_t(spark, sf_dir, "equipment"), ["location_id"], V) \
        .drop("equipment_count")


@register("agg_overdue_count", O.with_ctes(
    f"SELECT equipment_id, {_cnt(_eq('maintenance_status', 'overdue'))} "
    "AS overdue_events FROM maintenance_logs GROUP BY equipment_id"))
def agg_overdue_count(spark, sf_dir):
    return agg.maintenance_totals(_t(spark, sf_dir, "maintenance_logs"), ["equipment_id"], V) \
        .select("equipment_id", "overdue_events")


@register("agg_load_count", O.with_ctes(
    f"SELECT responsible_person_id, COUNT(*) AS assigned_equipment, "
    f"{_cnt(_eq('status', 'working'))} AS working, "
    f"{_cnt(_eq('status', 'in_repair'))} AS in_repair "
    "FROM equipment GROUP BY responsible_person_id"))
def agg_load_count(spark, sf_dir):
    return agg.equipment_status_counts(_t(spark, sf_dir, "equipment"), ["responsible_person_id"], V,
                                       total_alias="assigned_equipment", with_reserve=False)


@register("agg_sum_int", O.with_ctes(
    "SELECT inventory_id, CAST(SUM(actual_presence) AS BIGINT) AS actual_presence_sum "
    "FROM inventory_results GROUP BY inventory_id"))
def agg_sum_int(spark, sf_dir):
    return agg.result_counts(_t(spark, sf_dir, "inventory_results"), ["inventory_id"]) \
        .select("inventory_id", "actual_presence_sum")


@register("agg_sum_double", O.with_ctes(
    f"SELECT equipment_id, {O.exact_sum('duration_hours')} AS total_duration_hours, "
    f"{O.exact_sum('cost')} AS total_cost FROM maintenance_logs GROUP BY equipment_id"))
def agg_sum_double(spark, sf_dir):
    return agg.maintenance_totals(_t(spark, sf_dir, "maintenance_logs"), ["equipment_id"], V) \
        .select("equipment_id", "total_duration_hours", "total_cost")


@register("agg_max_date", O.with_ctes(
    "SELECT equipment_id, MAX(maintenance_date) AS last_maintenance_date "
    "FROM maintenance_logs GROUP BY equipment_id"))
def agg_max_date(spark, sf_dir):
    return agg.maintenance_totals(_t(spark, sf_dir, "maintenance_logs"), ["equipment_id"], V) \
        .select("equipment_id", "last_maintenance_date")


@register("ratio_accuracy", O.with_ctes(
    f"SELECT inventory_id, COUNT(*) AS checked_equipment, {_cnt('discrepancy_flag')} AS discrepancies, "
    f"CASE WHEN COUNT(*) > 0 THEN 1 - {_cnt('discrepancy_flag')} / COUNT(*) END AS inventory_accuracy "
    "FROM inventory_results GROUP BY inventory_id"))
def ratio_accuracy(spark, sf_dir):
    counts = agg.result_counts(_t(spark, sf_dir, "inventory_results"), ["inventory_id"])
    return agg.with_accuracy(counts).select(
        "inventory_id", "checked_equipment", "discrepancies", "inventory_accuracy")


# --- 2.6 sort -------------------------------------------------------------------

@register("sort_session_date", O.with_ctes(
    "SELECT * FROM m_inventory_accuracy ORDER BY session_date", O.MART_CTES))
def sort_session_date(spark, sf_dir):
    return marts.inventory_accuracy(_t(spark, sf_dir, "inventory_results"),
                                    _t(spark, sf_dir, "inventory_sessions"),
                                    _t(spark, sf_dir, "storage_locations"), sort=True)


@register("sort_location", O.with_ctes(
    "SELECT * FROM m_location_utilization ORDER BY zone, rack, shelf", O.MART_CTES))
def sort_location(spark, sf_dir):
    return marts.location_utilization(_t(spark, sf_dir, "equipment"),
                                      _t(spark, sf_dir, "storage_locations"), V, sort=True)


def _order_sql(mart: str, key: str) -> str:
    return O.with_ctes(
        f"SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS inversions, CAST(0 AS BIGINT) AS overlaps, "
        f"CASE WHEN COUNT(*) = COUNT({key}) THEN MIN({key}) END AS first_{key}, MAX({key}) AS last_{key} "
        f"FROM m_{mart}", O.MART_CTES)


def _written_order(spark: SparkSession, mart: DataFrame, keys: list[str]) -> DataFrame:
    uri = files.write_parquet(mart, scratch_uri(spark, "sorted"))
    return order_digest(spark, uri, keys).drop("n_parts")


@register("order_session_date", _order_sql("inventory_accuracy", "session_date"))
def order_session_date(spark, sf_dir):
    """The written parts of the sorted mart are in order, within and between them."""
    return _written_order(spark, sort_session_date(spark, sf_dir), ["session_date"])


@register("order_location", _order_sql("location_utilization", "zone"))
def order_location(spark, sf_dir):
    return _written_order(spark, sort_location(spark, sf_dir), ["zone", "rack", "shelf"])


# --- 2.7 marts ---------------------------------------------------------------------

@register("mart_equipment_health", O.mart("equipment_health"))
def mart_equipment_health(spark, sf_dir):
    return marts.equipment_health(_t(spark, sf_dir, "equipment"), _t(spark, sf_dir, "storage_locations"),
                                  _t(spark, sf_dir, "employees"), AS_OF)


@register("mart_inventory_accuracy", O.mart("inventory_accuracy"))
def mart_inventory_accuracy(spark, sf_dir):
    return marts.inventory_accuracy(_t(spark, sf_dir, "inventory_results"),
                                    _t(spark, sf_dir, "inventory_sessions"),
                                    _t(spark, sf_dir, "storage_locations"))


@register("mart_location_utilization", O.mart("location_utilization"))
def mart_location_utilization(spark, sf_dir):
    return marts.location_utilization(_t(spark, sf_dir, "equipment"),
                                      _t(spark, sf_dir, "storage_locations"), V)


@register("mart_maintenance_summary", O.mart("maintenance_summary"))
def mart_maintenance_summary(spark, sf_dir):
    return marts.maintenance_summary(_t(spark, sf_dir, "maintenance_logs"), _t(spark, sf_dir, "equipment"), V)


@register("mart_responsible_load", O.mart("responsible_load"))
def mart_responsible_load(spark, sf_dir):
    return marts.responsible_load(_t(spark, sf_dir, "equipment"), _t(spark, sf_dir, "employees"), V)


# --- data rules ----------------------------------------------------------------------

_MOVED = ("SELECT r.*, e.location_id AS home_location_id, r.location_id <> e.location_id AS item_moved "
          "FROM inventory_results r LEFT JOIN equipment e ON r.equipment_id = e.equipment_id")


@register("rule_item_moved", O.with_ctes(_MOVED))
def rule_item_moved(spark, sf_dir):
    return rules.item_moved(_t(spark, sf_dir, "inventory_results"), _t(spark, sf_dir, "equipment"))


_FLAGS = ("SELECT result_id, inventory_id, equipment_id, location_id, home_location_id, expected_presence, "
          "actual_presence, discrepancy_flag, item_moved, flag_required, "
          "flag_required AND NOT COALESCE(discrepancy_flag, FALSE) AS flag_violation FROM ("
          "SELECT *, COALESCE((actual_presence <> expected_presence) OR COALESCE(item_moved, FALSE), FALSE) "
          f"AS flag_required FROM ({_MOVED}) m) v")


@register("rule_discrepancy_flag", O.with_ctes(_FLAGS))
def rule_discrepancy_flag(spark, sf_dir):
    return rules.check_discrepancy_flags(_t(spark, sf_dir, "inventory_results"),
                                         _t(spark, sf_dir, "equipment"))


_RECONCILE = ("SELECT s.inventory_id, s.session_date, s.discrepancy_count, "
              "COALESCE(f.flagged, 0) AS flagged_results, "
              "CAST(s.discrepancy_count AS BIGINT) - COALESCE(f.flagged, 0) AS count_difference, "
              "CAST(s.discrepancy_count AS BIGINT) - COALESCE(f.flagged, 0) = 0 AS is_reconciled "
              "FROM inventory_sessions s LEFT JOIN ("
              f"SELECT inventory_id, {_cnt('discrepancy_flag')} AS flagged FROM inventory_results "
              "GROUP BY inventory_id) f ON s.inventory_id = f.inventory_id")


@register("rule_session_reconcile", O.with_ctes(_RECONCILE))
def rule_session_reconcile(spark, sf_dir):
    return rules.reconcile_sessions(_t(spark, sf_dir, "inventory_sessions"),
                                    _t(spark, sf_dir, "inventory_results"))


@register("filter_active_locations", O.with_ctes("SELECT * FROM storage_locations WHERE is_active"))
def filter_active_locations(spark, sf_dir):
    return rules.active_locations(_t(spark, sf_dir, "storage_locations"))


@register("rule_followup_action", O.with_ctes(
    "SELECT result_id, inventory_id, equipment_id, discrepancy_flag, discrepancy_type, "
    "CASE WHEN COALESCE(discrepancy_flag, FALSE) THEN "
    "CASE WHEN discrepancy_type IN ('R') THEN 'recount' ELSE 'consider write-off' END "
    "ELSE '' END AS followup_action FROM inventory_results"))
def rule_followup_action(spark, sf_dir):
    return rules.with_followup_action(_t(spark, sf_dir, "inventory_results"), V)


@register("rule_summary", O.with_ctes("\nUNION ALL\n".join([
    f"SELECT 'discrepancy_flag_missing' AS rule, {_cnt('flag_violation')} AS rows_flagged FROM ({_FLAGS}) a",
    f"SELECT 'items_moved' AS rule, {_cnt('COALESCE(item_moved, FALSE)')} AS rows_flagged FROM ({_MOVED}) b",
    f"SELECT 'sessions_unreconciled' AS rule, {_cnt('NOT COALESCE(is_reconciled, FALSE)')} "
    f"AS rows_flagged FROM ({_RECONCILE}) c",
    f"SELECT 'flagged_without_session' AS rule, {_cnt('discrepancy_flag')} AS rows_flagged FROM inventory_results "
    "WHERE inventory_id IS NULL OR inventory_id NOT IN (SELECT inventory_id FROM inventory_sessions)",
    f"SELECT 'inactive_locations' AS rule, {_cnt('NOT COALESCE(is_active, FALSE)')} "
    "AS rows_flagged FROM storage_locations"])))
def rule_summary_query(spark, sf_dir):
    return rules.rule_summary(adapters.source_tables(spark, sf_dir))
