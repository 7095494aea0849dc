"""Sources and sinks: idempotent writes, CSV export parts, landing, warehouse."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise import schemas
from shelfwise.config import LayerPaths
from shelfwise.plans import pipeline
from shelfwise.sinks import files
from shelfwise.sinks.warehouse import load_layers, load_via_stage
from shelfwise.sources import adapters
from shelfwise.sources.csv_scan import load_raw, read_csv_export, scan_inferred, scan_table
from shelfwise.sources.landing import land_raw, probe_source
from shelfwise.vocab import ADAPTER_VOCAB as V


def local(uri: str) -> str:
    return uri.replace("file://", "")


def test_write_dataset_is_idempotent(spark, scratch):
    eq = adapters.equipment(spark, SF_SMALL)
    n = eq.count()
    for _ in range(2):
        written = files.write_dataset(spark, eq, scratch, "equipment")
    assert written.count() == n
    csv = read_csv_export(spark, files.dataset_uris(scratch, "equipment")[1], schemas.EQUIPMENT)
    assert csv.count() == n
    assert csv.exceptAll(eq).count() == 0


def test_csv_parts_are_bounded(spark, scratch):
    logs = adapters.maintenance_logs(spark, SF_SMALL).repartition(4)
    uri = files.write_csv(logs, f"{scratch}/bounded", max_records=500)
    parts = glob.glob(os.path.join(local(uri), "part-*.csv"))
    assert all(len(spark.read.option("header", "true").csv(f"file://{p}").take(501)) <= 500 for p in parts)
    assert read_csv_export(spark, uri, schemas.MAINTENANCE_LOGS).exceptAll(logs).count() == 0
    uri = files.write_csv(logs, f"{scratch}/many")
    parts = glob.glob(os.path.join(local(uri), "part-*.csv"))
    assert len(parts) == 4
    # every part is read back, not only the first
    assert read_csv_export(spark, uri, schemas.MAINTENANCE_LOGS).count() == logs.count()


def test_missing_export_raises(spark, scratch):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_csv_export(spark, f"{scratch}/nope", schemas.EQUIPMENT).count()


def test_partitioned_overwrite_replaces_only_present_partitions(spark, scratch):
    eq = adapters.equipment(spark, SF_SMALL).withColumn("snapshot", F.lit("a"))
    files.write_parquet(eq, f"{scratch}/snap", partition_by=["snapshot"])
    eq_b = eq.withColumn("snapshot", F.lit("b"))
    files.write_parquet(eq_b, f"{scratch}/snap", partition_by=["snapshot"])
    files.write_parquet(eq_b, f"{scratch}/snap", partition_by=["snapshot"])
    counts = {r.snapshot: r["count"] for r in
              spark.read.parquet(f"{scratch}/snap").groupBy("snapshot").count().collect()}
    assert counts == {"a": eq.count(), "b": eq.count()}


def test_land_raw_skips_missing(spark, scratch):
    src = f"{scratch}/src"
    pipeline.stage_driver_tables(spark, SF_SMALL, src, ("equipment", "employees"))
    status = land_raw(spark, src, f"{scratch}/raw")
    assert status["equipment"] == "landed" and status["employees"] == "landed"
    assert status["maintenance_logs"] == "missing"
    landed = scan_table(spark, f"{scratch}/raw", "equipment")
    assert landed.exceptAll(adapters.equipment(spark, SF_SMALL)).count() == 0
    # a skipped table fails later, at its scan
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_raw(spark, f"{scratch}/raw")


def test_inferred_scan_types(spark, scratch):
    pipeline.stage_driver_tables(spark, SF_SMALL, scratch, ("maintenance_logs",))
    types = dict(scan_inferred(spark, scratch, "maintenance_logs").dtypes)
    assert types["maintenance_date"] == "date"
    assert types["duration_hours"] == "double" and types["cost"] == "double"
    assert types["responsible_person_id"] == "int"


def test_probe_source(spark, scratch):
    pipeline.stage_driver_tables(spark, SF_SMALL, scratch, ("employees",))
    row = probe_source(spark, f"{scratch}/employees.csv").first()
    assert row.source == "employees" and row.n_rows > 5 and row.sample_rows == 5


def test_warehouse_full_refresh_is_positional_and_idempotent(spark, scratch):
    paths = LayerPaths.under(f"{scratch}/layers")
    pipeline.stage_driver_tables(spark, SF_SMALL, paths.raw)
    pipeline.run(spark, paths, as_of="2001-12-31", vocab=V, export_csv=True)
    wh = f"{scratch}/wh"
    for source in ("csv", "parquet"):
        loaded = load_layers(spark, paths, warehouse_root=wh, source=source)
    assert len(loaded) == 17
    logs = spark.table("dds.maintenance_logs")
    assert "status" in logs.columns and "maintenance_status" not in logs.columns
    assert logs.count() == adapters.maintenance_logs(spark, SF_SMALL).count()
    assert set(r.status for r in logs.select("status").distinct().collect()) == {
        "done", "planned", "overdue"}
    assert spark.table("dm.responsible_load").count() == \
        spark.read.parquet(f"{paths.dm}/responsible_load").count()


def test_load_via_stage_swaps(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS swaptest LOCATION '{scratch}/swap.db'")
    emp = adapters.employees(spark, SF_SMALL)
    for n in (10, 3, 7):
        load_via_stage(spark, emp.limit(n), "swaptest", "employees", schemas.EMPLOYEES, f"{scratch}/swap")
    assert spark.table("swaptest.employees").count() == 7
    assert spark.table("swaptest.employees__prev").count() == 3


def test_plain_write_keeps_snapshots(spark, scratch):
    emp = adapters.employees(spark, SF_SMALL)
    files.write_dataset(spark, emp, scratch, "employees", export_csv=False, snapshot="2001-12-30")
    with pytest.raises(ValueError, match="snapshot"):
        files.write_dataset(spark, emp, scratch, "employees")


def test_databases_after_a_prefix(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dm LOCATION '{scratch}/dm.db'")
    before = {d.name for d in spark.catalog.listDatabases()}
    paths = LayerPaths.under(f"{scratch}/layers")
    pipeline.stage_driver_tables(spark, SF_SMALL, paths.raw)
    pipeline.run(spark, paths, as_of="2001-12-31", vocab=V)
    load_layers(spark, paths, warehouse_root=f"{scratch}/wh", prefix="px_")
    assert {d.name for d in spark.catalog.listDatabases()} - before == {"px_dds_stg", "px_dds", "px_dm"}


ODD = ['said "hi", then left', "two\nlines", "  padded  ", "", None, '"', ",", "plain", "\r\n", "\\", '\\"']


def test_text_survives_landing_and_export(spark, scratch):
    rows = [(str(i), t) for i, t in enumerate(ODD)]
    os.makedirs(local(f"{scratch}/src"))
    with open(local(f"{scratch}/src/inventory_results.csv"), "w", newline="", encoding="utf-8") as out:
        names = schemas.RAW_SCHEMAS["inventory_results"].fieldNames()
        out.write(",".join(reversed(names)) + "\n")  # the header's order is its own
        for i, t in rows:
            value = "" if t is None else '"' + t.replace('"', '""') + '"'
            cells = {"result_id": i, "comment": value, "location_id": "5"}
            out.write(",".join(cells.get(n, "") for n in reversed(names)) + "\n")
    assert land_raw(spark, f"{scratch}/src", f"{scratch}/raw", ("inventory_results",)) == {"inventory_results": "landed"}
    for root in (f"{scratch}/src", f"{scratch}/raw"):
        got = scan_table(spark, root, "inventory_results").select("result_id", "comment", "location_id").collect()
        assert sorted((r.result_id, r.comment or "", r.comment is None) for r in got) == \
            sorted((i, t or "", t is None) for i, t in rows)
        assert {r.location_id for r in got} == {5}
    frame = scan_table(spark, f"{scratch}/raw", "inventory_results")
    uri = files.write_csv(frame, f"{scratch}/export")
    back = read_csv_export(spark, uri, schemas.RAW_SCHEMAS["inventory_results"])
    assert back.exceptAll(frame).count() == 0 and frame.exceptAll(back).count() == 0


def test_unknown_header_raises_and_broken_records_count(spark, scratch):
    os.makedirs(local(f"{scratch}/storage"))
    path = local(f"{scratch}/storage_locations.csv")
    with open(path, "w", encoding="utf-8") as out:
        out.write("zone,location_id,rack,shelf,is_active\nA,7,r1,s1,True\nB,8,r2\n")
    row = scan_table(spark, scratch, "storage_locations").where("zone = 'A'").first()
    assert row.location_id == 7 and row.is_active is True
    text = scan_table(spark, scratch, "storage_locations", typed=False)
    assert sorted(r["_corrupt_record"] is not None for r in text.collect()) == [False, True]
    with open(path, "w", encoding="utf-8") as out:
        out.write("zone,place,rack,shelf,is_active\nA,7,r1,s1,True\n")
    with pytest.raises(ValueError, match="header"):
        scan_table(spark, scratch, "storage_locations")


def test_run_lands_first_and_fails_on_a_missing_source(spark, scratch):
    paths = LayerPaths.under(f"{scratch}/layers")
    pipeline.stage_driver_tables(spark, SF_SMALL, f"{scratch}/src", ("equipment",))
    with pytest.raises(FileNotFoundError, match="employees"):
        pipeline.run(spark, paths, source_root=f"{scratch}/src")


def test_snapshot_layers_keep_history_and_prune(spark, scratch):
    paths = LayerPaths.under(f"{scratch}/layers")
    pipeline.stage_driver_tables(spark, SF_SMALL, paths.raw)
    for day in ("2001-12-30", "2001-12-31", "2001-12-31"):
        out = pipeline.run(spark, paths, as_of=day, vocab=V, snapshot=day,
                           load_warehouse=True, warehouse_root=f"{scratch}/wh")
    n_eq = adapters.equipment(spark, SF_SMALL).count()
    days = {r.snapshot_date.isoformat(): r["count"] for r in
            spark.read.parquet(f"{paths.dm}/equipment_health").groupBy("snapshot_date").count().collect()}
    assert days == {"2001-12-30": n_eq, "2001-12-31": n_eq}
    health = out["dm"]["equipment_health"]
    assert health.columns == schemas.EQUIPMENT_HEALTH.fieldNames()
    assert "PartitionFilters: [isnotnull(snapshot_date" in _formatted(health)
    assert spark.table("dm.equipment_health").count() == n_eq


def _formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dds_build_counts_rejects_in_the_same_pass(spark, scratch):
    paths = LayerPaths.under(f"{scratch}/layers")
    pipeline.stage_driver_tables(spark, SF_SMALL, paths.raw)
    # one dirty source: two malformed values in storage_locations
    dirty = spark.createDataFrame(
        [("1", "Z", "R", "S1", "True"), ("abc", "Z", "R", "S2", "maybe"), ("3", "Z", "R", "S3", "")],
        schemas.all_strings(schemas.STORAGE_LOCATIONS))
    files.write_csv(dirty, f"{paths.raw}/storage_locations.csv")
    dds = pipeline.build_dds(spark, paths)
    rej = {(r.table_name, r.column_name): r.rejected_values
           for r in spark.read.parquet(f"{paths.dds}/_rejects").collect()}
    assert rej[("storage_locations", "location_id")] == 1
    assert rej[("storage_locations", "is_active")] == 1
    assert rej[("equipment", "purchase_date")] == 0
    locs = {r.shelf: (r.location_id, r.is_active) for r in dds["storage_locations"].collect()}
    assert locs == {"S1": (1, True), "S2": (None, None), "S3": (3, None)}


def test_sorted_mart_parts_keep_order(spark, scratch):
    from shelfwise.plans import marts
    t = adapters.source_tables(spark, SF_SMALL)
    acc = marts.inventory_accuracy(t["inventory_results"], t["inventory_sessions"],
                                   t["storage_locations"], sort=True)
    rows = acc.collect()
    dates = [r.session_date for r in rows]
    # NULL dates first, then ascending (global order across range partitions)
    nulls = sum(d is None for d in dates)
    assert all(d is None for d in dates[:nulls])
    assert dates[nulls:] == sorted(dates[nulls:])
    uri = files.write_csv(acc, f"{scratch}/sorted", max_records=700)
    written = []
    for part in sorted(glob.glob(os.path.join(local(uri), "part-*.csv"))):
        with open(part, encoding="utf-8") as fh:
            written += [line.split(",")[1] for line in fh.read().splitlines()[1:]]
    assert written == ["" if d is None else d.isoformat() for d in dates]


def test_sorted_location_mart_order(spark):
    from shelfwise.plans import marts
    t = adapters.source_tables(spark, SF_SMALL)
    rows = marts.location_utilization(t["equipment"], t["storage_locations"], V, sort=True).collect()
    keys = [tuple((v is not None, v) for v in (r.zone, r.rack, r.shelf)) for r in rows]
    assert keys == sorted(keys)  # NULLs first, then ascending
