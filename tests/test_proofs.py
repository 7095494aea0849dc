"""Exact sums, order of written parts, types against the contract, sizes of written files."""

from __future__ import annotations

import glob
import math
import os
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise import schemas
from shelfwise.functions import casting
from shelfwise.functions.casting import try_convert
from shelfwise.operators import aggregates as agg
from shelfwise.operators.exact import exact_sum, merged, parts
from shelfwise.operators.order import order_digest
from shelfwise.plans import marts, pipeline
from shelfwise.sinks import files
from shelfwise.sources import adapters
from shelfwise.sources.contract import CANDIDATES, hold_types, tried, type_report
from shelfwise.vocab import ADAPTER_VOCAB as V

GROUPS = {
    "money": [round(random.Random(1).uniform(-1e6, 1e6), 2) for _ in range(999)],
    "cancels": [1e12, 0.1, -1e12, 0.2, -0.3] * 7,
    "small": [2.0 ** -30 * i for i in range(-50, 400)],
    "negative": [-0.1] * 10,
    "nothing": [None, None],
    "some": [None, 1.5],
    "edge": [2.0 ** 40 - 2.0 ** -12, -(2.0 ** 39), 0.0, -0.0],
}


def bits(v):
    return None if v is None else v.hex()


def test_exact_sums_are_rounded_once(spark):
    rows = [(k, v) for k, held in GROUPS.items() for v in held]
    expected = {k: bits(float(sum(map(Fraction, own)))) if (own := [v for v in held if v is not None]) else None
                for k, held in GROUPS.items()}
    assert expected["money"] == bits(math.fsum(GROUPS["money"]))
    rnd = random.Random(2)
    for n in (1, 3, 8):
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v double").repartition(n)
        assert {r.k: bits(r.s) for r in df.groupBy("k").agg(exact_sum("v").alias("s")).collect()} == expected
        twice = df.withColumn("p", F.spark_partition_id()).groupBy("k", "p").agg(*parts("v", "s")).groupBy("k").agg(merged("s"))
        assert {r.k: bits(r.s) for r in twice.collect()} == expected


def test_sums_out_of_range_are_plain_sums(spark):
    rows = [("huge", 1e300), ("huge", 1.0), ("inf", math.inf), ("inf", 1.0), ("nan", math.nan), ("nan", 1.0), ("ok", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    for made in (df.groupBy("k").agg(exact_sum("v").alias("s")),
                 df.groupBy("k", "v").agg(*parts("v", "s")).groupBy("k").agg(merged("s"))):
        got = {r.k: r.s for r in made.collect()}
        assert got["huge"] == 1e300 and got["inf"] == math.inf and math.isnan(got["nan"]) and got["ok"] == 1.0


def test_m4_does_not_depend_on_partitions(spark):
    logs = adapters.maintenance_logs(spark, SF_SMALL).withColumn("cost", F.col("cost") / 7)
    equipment = adapters.equipment(spark, SF_SMALL)
    held = [sorted((r.equipment_id, bits(r.total_cost)) for r in marts.maintenance_summary(
        logs.repartition(n, "maintenance_id"), equipment.union(equipment.limit(50)), V).collect()) for n in (1, 7)]
    assert held[0] == held[1]
    totals = agg.maintenance_totals(logs, ["equipment_id"], V).select("equipment_id", "total_cost").collect()
    exact = {}
    for r in logs.select("equipment_id", "cost").collect():
        exact.setdefault(r.equipment_id, []).append(r.cost)
    assert {r.equipment_id: r.total_cost for r in totals} == {k: math.fsum(v) for k, v in exact.items()}


def test_order_digest_sees_what_is_out_of_order(spark, scratch):
    keys = ["d", "s"]
    rows = [(None, "b"), (None, "c"), (1, None), (1, "a"), (2, "a"), (2, "a"), (3, "z"), (9, "q")]

    def digest(parts_):
        uri = f"{scratch}/{len(os.listdir(scratch.removeprefix('file://')))}"
        for i, part in enumerate(parts_):
            spark.createDataFrame(part, "d int, s string").coalesce(1).write.parquet(f"{uri}-{i}")
        os.makedirs(uri.removeprefix("file://"))
        for i in range(len(parts_)):
            os.rename(glob.glob(f"{uri.removeprefix('file://')}-{i}/part-*.parquet")[0],
                      f"{uri.removeprefix('file://')}/part-{i:05d}.parquet")
        return tuple(order_digest(spark, uri, keys).first())

    assert digest([rows[:3], rows[3:5], rows[5:]]) == (8, 3, 0, 0, None, 9)
    assert digest([rows[3:5], rows[:3], rows[5:]])[2:4] == (0, 1)
    assert digest([[rows[1], rows[0], *rows[2:]]])[2:4] == (1, 0)
    assert digest([rows[::-1]])[2:4] == (6, 0)


def test_order_of_a_mart_in_many_parts(spark, scratch):
    t = adapters.source_tables(spark, SF_SMALL)
    made = {sort: marts.inventory_accuracy(t["inventory_results"], t["inventory_sessions"], t["storage_locations"], sort=sort)
            for sort in (True, False)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        digests = {s: order_digest(spark, files.write_parquet(df, f"{scratch}/{s}"), ["session_date"]).first() for s, df in made.items()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert digests[True].n_parts > 1 and digests[True].inversions == digests[True].overlaps == 0
    assert digests[False].inversions > 0  # without the sort the proof fails


def test_a_drifted_column_is_named(spark, scratch):
    pipeline.stage_driver_tables(spark, SF_SMALL, scratch, ("maintenance_logs", "equipment"))
    for name in ("maintenance_logs", "equipment"):
        report = {r.column_name: r for r in type_report(spark, scratch, name).collect()}
        for f in schemas.RAW_SCHEMAS[name].fields:
            r = report[f.name]
            assert r.n_conflicts == 0 and r.example is None and r.declared == f.dataType.simpleString()
            assert r.inferred == r.declared or r.declared == "string"
        hold_types(spark, scratch, name)
    with open(f"{scratch.removeprefix('file://')}/maintenance_logs.csv/more.csv", "w", encoding="utf-8") as out:
        out.write(",".join(schemas.RAW_SCHEMAS["maintenance_logs"].fieldNames()) + "\n")
        out.write("M1,E1,31.12.2001,x,1.5,done,7,12\nM2,E2,2001-12-31,x,two,done,,\n")
    report = {r.column_name: r for r in type_report(spark, scratch, "maintenance_logs").collect()}
    assert (report["maintenance_date"].inferred, report["maintenance_date"].n_conflicts, report["maintenance_date"].example) == \
        ("string", 1, "31.12.2001")
    assert report["duration_hours"].example == "two" and report["cost"].n_conflicts == 0
    with pytest.raises(ValueError, match="maintenance_date is date, 1 of .*'31.12.2001'; .*duration_hours|duration_hours.*maintenance_date"):
        hold_types(spark, scratch, "maintenance_logs")


def test_written_files_have_a_stated_size(spark, scratch):
    """2,000 shuffle partitions and a hot key give few files near the advisory size."""
    conf = {"spark.sql.shuffle.partitions": "2000", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "300k",
            "spark.sql.adaptive.coalescePartitions.enabled": "true",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(60_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "uuid() AS v").repartition(2000, "k")
        uri = files.write_parquet(rows, f"{scratch}/sized", rebalance=True)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    sizes = [os.path.getsize(p) for p in glob.glob(f"{uri.removeprefix('file://')}/part-*.parquet")]
    assert 4 < len(sizes) < 40 and max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    assert spark.read.parquet(uri).count() == 60_000


def test_texts_convert_by_shape_as_by_cast(spark):
    """Texts that are not cast are texts whose cast fails, blanks and odd spellings included."""
    texts = ["", " ", "0", "1", "-1", "+7", "+-5", "--1", "5-", "007", "1.0", "1.", ".5", ".", "1e3", "1E-3", "1e", "1d", "2F", "0x1p3", "0x1.8P1d",
             "0x", "NaN", "nan", "-NaN", "inf", "-Infinity", "+INF", "infinit", "t", "TRUE", "Yes", "n", "no", "off", "2", "\t1\n", "1\x00", "\x7f1",
             "1 ", "١", "1_000", "1,5", "2147483647", "2147483648", "-2147483649", "00000000002147483647", "9223372036854775807",
             "9223372036854775808", "000000000000000000009", "1234", "12345", "123456", "1234567", "12345678", "-1234", "+1234-5", "2024-1",
             "2024-01-02", "2024-1-2", "2024-13-01", "2024-02-30", "2024-01-02 ", "2024-01-02 x", "2024-01-02T", "2024-01-02Tx\ny", "2024-01-02\n",
             "2024-01-02 03:04", "2024-01-02T03:04:05.123456", "2024-01-02 03:04:05Z", "2024-01-02 03:04:05 UTC", "123-01-01", "1234567-01-01",
             "123456-01-01", "-123456-01-01", "2024 ", "2024T", "2024-01T", "03:04", "T03:04", "T03:04:05", "3:4:5", "+03:04", "12:30 UTC",
             "epoch", "now", "today", "x5", "xtrue", "x2024-01-02", "two\nlines", "ı", "İnf", "ｔ", "trUe\t", "1995-03-04x", None]
    rows = spark.createDataFrame([(i, pad.format(t) if t is not None else None) for i, (t, pad) in
                                  enumerate((t, pad) for t in texts for pad in ("{}", " {} ", "\r{}\x0b"))], "i int, text string")
    kinds = [k.simpleString() for k in CANDIDATES]
    found = tried(rows).select("*", casting.present(F.col("text")).alias("has_value"), *[try_convert(F.col("text"), k).isNotNull().alias(f"by_cast_{k.simpleString()}") for k in CANDIDATES]).collect()
    assert all((r.present or False) is (r.has_value or False) for r in found)
    wrong = [(r.text, k) for r in found for k in kinds if r[f"is_{k}"] is not r[f"by_cast_{k}"]]
    assert not wrong and all(any(r[f"is_{k}"] for r in found) for k in kinds)
    shapes = {k: re.compile(casting._SHAPES[k].replace("(?i)", "").replace(r"\z", r"\Z"), re.I) for k in kinds}
    for k, texts in {"int": ("x5", "2024-01-02", "3000000000000"), "double": ("2024-01-02", "INV-1", "yes"), "boolean": ("12", "x"),
                     "date": ("12345678", "plain", "1.5"), "timestamp_ntz": ("12345678", "EQ1", "1.5")}.items():
        assert not any(shapes[k].search(t) for t in texts)  # no exception is built for them


def test_order_digest_compares_blocks_of_a_file(spark, scratch, monkeypatch):
    """No task sorts a whole file; a row below the last one of the block before is seen."""
    from shelfwise.operators import joins, order
    monkeypatch.setattr(order, "BLOCK_ROWS", 10)
    monkeypatch.setattr(joins, "TASK_ROWS", 30)
    values = [*range(50), *range(49, 99), *range(200, 250)]
    uri = files.write_parquet(spark.createDataFrame([(v,) for v in values], "k long").coalesce(1), f"{scratch}/blocks")
    got = order_digest(spark, uri, ["k"])
    assert tuple(got.first()) == (150, 1, 0, 0, 0, 249)
    files.write_parquet(spark.createDataFrame([(v,) for v in [*range(50), *range(48, 98)]], "k long").coalesce(1), uri)
    assert tuple(order_digest(spark, uri, ["k"]).first()) == (100, 1, 1, 0, 0, 97)
    assert re.search(r"hashpartitioning\(file#\d+, block#\d+L, \d+\), REPARTITION_BY_NUM", got._jdf.queryExecution().toString())
