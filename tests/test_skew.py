"""Hot keys: a third of all rows on one key must neither break results nor
land in one task.  Inputs are the driver tables with a hot key forced in."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from shelfwise.operators import joins
from shelfwise.plans import marts
from shelfwise.sources import adapters
from shelfwise.vocab import ADAPTER_VOCAB as V


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture
def skewed(spark):
    t = adapters.source_tables(spark, SF_MID)
    # a third of the assets at place 10, a sixth with no place at all; spread
    # over several input splits, as a real input is (AQE splits a hot reducer
    # partition along map-output boundaries, so one map task cannot be split)
    key = F.substring("equipment_id", 3, 12).cast("long")
    eq = t["equipment"].repartition(8).withColumn(
        "location_id",
        F.when(key % 3 == 0, F.lit(10)).when(key % 6 == 1, F.lit(None).cast("int"))
         .otherwise(F.col("location_id")))
    return t, eq


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.enabled")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1024")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4096")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_health_mart_splits_hot_place(spark, skewed, no_broadcast):
    t, eq = skewed
    df = marts.equipment_health(eq, t["storage_locations"], t["employees"], "2001-12-31",
                                broadcast="never")
    rows = df.collect()  # runs this DataFrame's own (adaptive) plan
    assert len(rows) == eq.count()
    assert {r.zone for r in rows if r.location_id == 10} == {
        t["storage_locations"].filter("location_id = 10").first().zone}
    assert all(r.zone is None for r in rows if r.location_id is None)
    # AQE split the hot partitions of the left side instead of one task per key
    plan = final_plan(df)
    assert "isFinalPlan=true" in plan and "AQEShuffleRead skewed" in plan


def test_aggregating_marts_are_exact_under_skew(spark, skewed):
    t, eq = skewed
    util = marts.location_utilization(eq, t["storage_locations"], V)
    want = (eq.join(t["storage_locations"], "location_id", "left")
            .groupBy("zone", "rack", "shelf", "is_active").agg(F.count(F.lit(1)).alias("equipment_count")))
    got = util.select("zone", "rack", "shelf", "is_active", "equipment_count")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    load = marts.responsible_load(eq, t["employees"], V)
    assert load.agg(F.sum("assigned_equipment")).first()[0] == eq.count()


def test_accuracy_mart_deals_facts_by_their_rows(spark, monkeypatch):
    """A task of the join holds a bounded number of rows, whatever the shuffle partitions;
    a hot session, sessions without a key and repeated sessions change no result."""
    t = adapters.source_tables(spark, SF_MID)
    results, sessions = t["inventory_results"], t["inventory_sessions"]
    odd = results.withColumn("inventory_id", F.when(F.col("result_id").rlike("[0-4]$"), F.lit("INV-1"))
                             .when(F.col("result_id").rlike("5$"), F.lit(None).cast("string"))
                             .otherwise(F.col("inventory_id")))
    twice = sessions.unionByName(sessions.where("inventory_id = 'INV-1' OR inventory_id LIKE '%7'"))
    for facts, days in ((results, sessions), (odd, twice), (results.limit(0), sessions)):
        monkeypatch.setattr(joins, "TASK_ROWS", 1 << 40)
        want = sorted(map(str, marts.inventory_accuracy(facts, days, t["storage_locations"]).collect()))
        monkeypatch.setattr(joins, "TASK_ROWS", 2_000)
        got = marts.inventory_accuracy(facts, days, t["storage_locations"])
        assert sorted(map(str, got.collect())) == want
        n, hot = joins.deal_over(facts, days, "inventory_id")
        assert n == -(-(facts.count() + days.count()) // 2_000) and hot is (facts is odd)
        assert facts.isEmpty() or re.search(rf"hashpartitioning\(inventory_id#\d+, {n}\), REPARTITION_BY_NUM", final_plan(got))


def test_accuracy_mart_deals_places_that_are_not_broadcast(spark, monkeypatch, no_broadcast):
    """Beyond the broadcast budget the places' join, the sums and the sort follow the rows too;
    hot, missing and repeated places change no result."""
    t = adapters.source_tables(spark, SF_MID)
    results, sessions, places = t["inventory_results"], t["inventory_sessions"], t["storage_locations"]
    results = results.withColumn("location_id", F.when(F.col("result_id").rlike("[0-4]$"), F.lit(3))
                                 .when(F.col("result_id").rlike("5$"), F.lit(None).cast("int"))
                                 .otherwise(F.col("location_id")))
    places = places.unionByName(places.where("location_id IN (3, 7)").withColumn("zone", F.lit("twice")))
    monkeypatch.setattr(joins, "TASK_ROWS", 1 << 40)
    want = sorted(map(str, marts.inventory_accuracy(results, sessions, places).collect()))
    monkeypatch.setattr(joins, "TASK_ROWS", 2_000)
    got = marts.inventory_accuracy(results, sessions, places)
    assert sorted(map(str, got.collect())) == want
    n = -(-results.count() // 2_000)
    plan = final_plan(got)
    assert re.search(rf"hashpartitioning\(location_id#\d+, _place#\d+L, {n}\), REPARTITION_BY_NUM", plan)
    assert re.search(rf"hashpartitioning\(inventory_id#\d+, session_date#\d+, zone#\d+, rack#\d+, shelf#\d+, {n}\)", plan)
    ordered = marts.inventory_accuracy(results, sessions, places, sort=True)
    days = [r.session_date for r in ordered.collect()]
    assert days == sorted(days, key=lambda d: (d is not None, d)) and len(days) == len(want)
    assert re.search(rf"rangepartitioning\(session_date#\d+ ASC NULLS FIRST.*, {n}\), REPARTITION_BY_NUM", final_plan(ordered))


def test_maintenance_summary_deals_logs_by_their_rows(spark, monkeypatch):
    t = adapters.source_tables(spark, SF_MID)
    logs, assets = t["maintenance_logs"], t["equipment"]
    odd = logs.withColumn("equipment_id", F.when(F.col("maintenance_id").rlike("[0-4]$"), F.lit("EQ1"))
                          .when(F.col("maintenance_id").rlike("5$"), F.lit(None).cast("string"))
                          .otherwise(F.col("equipment_id")))
    twice = assets.unionByName(assets.where("equipment_id = 'EQ1' OR equipment_id LIKE '%7'"))
    for facts, dims in ((logs, assets), (odd, twice), (logs.limit(0), assets)):
        monkeypatch.setattr(joins, "TASK_ROWS", 1 << 40)
        want = sorted(map(str, marts.maintenance_summary(facts, dims, V).collect()))
        monkeypatch.setattr(joins, "TASK_ROWS", 2_000)
        got = marts.maintenance_summary(facts, dims, V)
        assert sorted(map(str, got.collect())) == want
        n = -(-(facts.count() + dims.count()) // 2_000)
        assert facts.isEmpty() or re.search(rf"hashpartitioning\(equipment_id#\d+(, maintenance_date#\d+)?, {n}\), "
                                            "REPARTITION_BY_NUM", final_plan(got))
