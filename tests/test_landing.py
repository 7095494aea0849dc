"""Landing copies files; scans bind each part by its own header."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.errors import AnalysisException

from conftest import SF_SMALL
from shelfwise import schemas
from shelfwise.config import LayerPaths
from shelfwise.plans import pipeline
from shelfwise.sources import parts
from shelfwise.sources.csv_scan import load_raw, scan_table
from shelfwise.sources.landing import land_raw, landed_uri, verify_landed

HEADER = b"location_id,zone,rack,shelf,is_active\n"
BODIES = {
    "plain": HEADER + b"1,A,r,s,True\n2,B,r,s,False\n",
    "no_end": HEADER + b"1,A,r,s,True\n2,B,r,s,False",
    "no_end_accent": HEADER + "1,A,r,s,é".encode(),
    "carriage": HEADER.replace(b"\n", b"\r\n") + b"1,A,r,s,True\r\n",
    "marked": b"\xef\xbb\xbf" + HEADER + b"1,A,r,s,True\n",
    "marked_no_end": b"\xef\xbb\xbf" + HEADER + b"1,A,r,s,True",
    "broken": HEADER + b"1,A,r,s,True\n2,B,r,s,True,EXTRA,9\n3,C\n\n\n",
    "no_utf8": HEADER + b"1,\xff\xfe\x80,r,s,True\n",
    "quoted": HEADER + b'1,"two\nlines, ""quoted""",r,s,""\n',
    "blank_ends": b"\n\n",
    "one_char": b"x",
}


def local(uri: str) -> str:
    return uri.removeprefix("file://")


def put(scratch: str, files: dict[str, bytes], table: str = "storage_locations") -> str:
    folder = f"{local(scratch)}/src/{table}.csv"
    os.makedirs(folder)
    for name, body in files.items():
        with open(f"{folder}/{name}.csv", "wb") as out:
            out.write(body)
    return f"{scratch}/src"


def landed_bytes(raw: str, table: str = "storage_locations") -> list[bytes]:
    out = []
    for path in glob.glob(f"{local(raw)}/{table}.csv/part-*"):
        with open(path, "rb") as part:
            out.append(part.read())
    return sorted(out)


@pytest.mark.parametrize("name", sorted(BODIES))
def test_landed_bytes_are_the_sources(spark, scratch, name):
    src = put(scratch, {name: BODIES[name]})
    assert land_raw(spark, src, f"{scratch}/raw", ("storage_locations",)) == {"storage_locations": "landed"}
    assert landed_bytes(f"{scratch}/raw") == [BODIES[name]]


def test_a_folder_lands_file_by_file(spark, scratch):
    src = put(scratch, {**BODIES, "empty": b"", "_hidden": b"x"})
    for _ in range(2):  # a second landing leaves one copy
        land_raw(spark, src, f"{scratch}/raw", ("storage_locations",))
    assert landed_bytes(f"{scratch}/raw") == sorted(BODIES.values())
    kept = spark.read.schema(parts.FILES_DDL).parquet(landed_uri(f"{scratch}/raw", "storage_locations")).collect()
    assert {os.path.basename(r.source_file): r.size for r in kept} == {f"{k}.csv": len(v) for k, v in BODIES.items()}


def test_a_single_file_lands(spark, scratch):
    os.makedirs(f"{local(scratch)}/src")
    with open(f"{local(scratch)}/src/storage_locations.csv", "wb") as out:
        out.write(BODIES["broken"])
    land_raw(spark, f"{scratch}/src", f"{scratch}/raw", ("storage_locations",))
    assert landed_bytes(f"{scratch}/raw") == [BODIES["broken"]]


def test_many_lines_stay_in_one_part_each(spark, scratch):
    """A file above the session's split size is copied by one task."""
    body = {n: HEADER + b"".join(b"%d,%s,r,s,True\n" % (i, n.encode()) for i in range(60_000)) for n in ("a", "b")}
    src = put(scratch, body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        land_raw(spark, src, f"{scratch}/raw", ("storage_locations",))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert landed_bytes(f"{scratch}/raw") == sorted(body.values())


def test_broken_records_of_a_landed_file_reach_the_rejects(spark, scratch):
    paths = LayerPaths.under(scratch)
    pipeline.stage_driver_tables(spark, SF_SMALL, f"{scratch}/src",
                                 tuple(t for t in schemas.SOURCE_TABLES if t != "storage_locations"))
    put(f"{scratch}/x", {"broken": BODIES["broken"]})
    os.rename(f"{local(scratch)}/x/src/storage_locations.csv", f"{local(scratch)}/src/storage_locations.csv")
    pipeline.run(spark, paths, as_of="2001-12-31", source_root=f"{scratch}/src")
    rejects = {(r.table_name, r.column_name): r.rejected_values for r in spark.read.parquet(f"{paths.dds}/_rejects").collect()}
    assert rejects["storage_locations", "_corrupt_record"] == 2
    assert spark.read.parquet(f"{paths.dds}/storage_locations").count() == 3


def test_verify_notices_a_lost_an_altered_and_an_added_part(spark, scratch):
    names = ("storage_locations",)
    land_raw(spark, put(scratch, {"a": BODIES["plain"], "b": BODIES["quoted"]}), f"{scratch}/raw", names)
    verify_landed(spark, f"{scratch}/raw", names)
    for crc in glob.glob(f"{local(scratch)}/raw/storage_locations.csv/.*.crc"):
        os.remove(crc)  # the local file system's own checksums would notice first
    parts_ = sorted(glob.glob(f"{local(scratch)}/raw/storage_locations.csv/part-*"))
    with open(parts_[0], "rb") as f:
        first = f.read()
    for spoilt in (first.replace(b"r,s", b"s,r"), first[:-1], b"".join(sorted(first.splitlines(True)))):
        with open(parts_[0], "wb") as f:
            f.write(spoilt)
        with pytest.raises(OSError, match="no equal copy"):
            verify_landed(spark, f"{scratch}/raw", names)
    os.remove(parts_[0])
    with pytest.raises(OSError, match="no equal copy"):
        verify_landed(spark, f"{scratch}/raw", names)
    for path in (parts_[0], f"{parts_[0]}.more.txt"):
        with open(path, "wb") as f:
            f.write(first)
    with pytest.raises(OSError, match="too many"):
        verify_landed(spark, f"{scratch}/raw", names)


def test_digest_tells_order_and_repeated_lines(spark, scratch):
    src = put(scratch, {"a": b"x\ny\n", "b": b"y\nx\n", "c": b"x\nx\n", "d": b"x\ny\n"})
    held = {os.path.basename(f.path): f.content for f in parts.describe(spark, f"{src}/storage_locations.csv")}
    assert held["a.csv"] == held["d.csv"] and len({held[k] for k in ("a.csv", "b.csv", "c.csv")}) == 3


def test_parts_bind_by_their_own_headers(spark, scratch):
    src = put(scratch, {
        "a": b"location_id,zone,rack,shelf,is_active\n1,Z1,R1,S1,True\n",
        "b": b"location_id,rack,zone,shelf,is_active\r\n2,R2,Z2,S2,False\r\n",
        "c": b'\xef\xbb\xbf"is_active",shelf,rack,zone,location_id\nTrue,S3,"R\n3",Z3,3\n',
        "d": b"location_id,zone,rack,shelf,is_active\n4,Z4,R4,S4,True\n", "e": b"", "f": HEADER.strip()})
    land_raw(spark, src, f"{scratch}/raw", ("storage_locations",))
    with pytest.raises(ValueError, match="itself"):
        land_raw(spark, src, src, ("storage_locations",))
    for root in (src, f"{scratch}/raw"):
        rows = {r.location_id: tuple(r) for r in scan_table(spark, root, "storage_locations").collect()}
        assert rows == {1: (1, "Z1", "R1", "S1", True), 2: (2, "Z2", "R2", "S2", False),
                        3: (3, "Z3", "R\n3", "S3", True), 4: (4, "Z4", "R4", "S4", True)}
    groups = parts.header_groups(spark, f"{scratch}/src/storage_locations.csv")
    assert sorted(len(f) for f in groups.values()) == [1, 1, 3]


def test_an_unknown_header_names_its_part(spark, scratch):
    src = put(scratch, {"a": BODIES["plain"], "odd": b"location_id,zone,rack,shelf\n1,A,r,s\n"})
    with pytest.raises(ValueError, match="odd.csv.*does not name"):
        scan_table(spark, src, "storage_locations")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan_table(spark, src, "employees")


def test_single_line_reads_a_file_by_many_tasks(spark, scratch):
    src = put(scratch, {"a": HEADER + b"".join(b"%d,z,r,s,True\n" % i for i in range(20_000))})
    for t in schemas.SOURCE_TABLES:
        if t != "storage_locations":
            put(f"{scratch}/{t}", {"a": ",".join(schemas.RAW_SCHEMAS[t].fieldNames()).encode() + b"\n"}, t)
            os.rename(f"{local(scratch)}/{t}/src/{t}.csv", f"{local(scratch)}/src/{t}.csv")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        many = load_raw(spark, src, typed=False, multi_line=False)["storage_locations"]
        assert many.rdd.getNumPartitions() > 3 and many.count() == 20_000
        assert load_raw(spark, src, typed=False)["storage_locations"].rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_an_empty_marker_cannot_be_a_value(spark, scratch):
    src = put(scratch, {"a": HEADER + b'1,\x01,"",,True\n'})
    row = scan_table(spark, src, "storage_locations").first()
    assert (row.zone, row.rack, row.shelf) == ("\x01", "", None)


def test_describing_files_sorts_no_lines(spark, scratch):
    """The lines pass through one aggregate of numbers: nothing to sort, nothing to spill."""
    source = put(scratch, {"a": HEADER + b"1,A,r,s,True\n", "b": HEADER + "1,A,r,s,\U0001F600".encode()})
    digests = parts.file_digests(spark, f"{source}/storage_locations.csv")
    plan = digests._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    assert {r.file[-5:]: r.last_char for r in digests.collect()} == {"a.csv": "e", "b.csv": "\U0001F600"}


def test_packed_sources_land_with_the_lines_of_plain_ones(spark, scratch):
    tables = ("storage_locations", "inventory_results")
    lines = []
    for packed in ((), ("inventory_results",)):
        source, raw = f"{scratch}/source{len(packed)}", f"{scratch}/raw{len(packed)}"
        pipeline.stage_driver_tables(spark, SF_SMALL, source, tables, packed=packed)
        assert land_raw(spark, source, raw, tables) == dict.fromkeys(tables, "landed")
        verify_landed(spark, raw, tables)
        lines.append([landed_bytes(raw, n) for n in tables])
        assert bool(glob.glob(f"{local(source)}/inventory_results.csv/*.gz")) is bool(packed)
    assert lines[0] == lines[1] and all(lines[0])
