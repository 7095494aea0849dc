"""Invariants of the marts, and pre-aggregation == join-then-aggregate."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise import schemas
from shelfwise.functions.conditional import accuracy, flag_count, value_count
from shelfwise.plans import marts
from shelfwise.sources import adapters
from shelfwise.vocab import ADAPTER_VOCAB as V


@pytest.fixture(scope="module")
def t(spark):
    return adapters.source_tables(spark, SF_SMALL)


def total(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_mart_invariants(spark, t):
    n_eq = t["equipment"].count()
    assert marts.equipment_health(t["equipment"], t["storage_locations"], t["employees"],
                                  "2001-12-31").count() == n_eq
    util = marts.location_utilization(t["equipment"], t["storage_locations"], V)
    assert total(util, "equipment_count") == n_eq
    assert util.filter("working + in_repair + in_reserve > equipment_count").count() == 0
    load = marts.responsible_load(t["equipment"], t["employees"], V)
    assert total(load, "assigned_equipment") == n_eq
    acc = marts.inventory_accuracy(t["inventory_results"], t["inventory_sessions"],
                                   t["storage_locations"])
    assert total(acc, "checked_equipment") == t["inventory_results"].count()
    assert acc.filter("inventory_accuracy < 0 OR inventory_accuracy > 1").count() == 0
    summ = marts.maintenance_summary(t["maintenance_logs"], t["equipment"], V)
    assert total(summ, "maintenance_events") == t["maintenance_logs"].count()
    assert total(summ, "total_cost") == pytest.approx(total(t["maintenance_logs"], "cost"))


keys = st.one_of(st.none(), st.integers(0, 3))
flags = st.one_of(st.none(), st.booleans())
statuses = st.one_of(st.none(), st.sampled_from([V.working, V.in_repair, V.reserve, V.written_off]))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(results=st.lists(st.tuples(st.sampled_from(["I1", "I2", None]), keys, flags,
                                  st.one_of(st.none(), st.integers(0, 2))), max_size=12),
       sessions=st.lists(st.tuples(st.sampled_from(["I1", "I2", "I3"]),
                                   st.sampled_from(["2025-01-01", "2025-02-01"])), max_size=4),
       places=st.lists(st.tuples(keys, st.sampled_from(["Z1", "Z2"])), max_size=5))
def test_accuracy_preaggregation_equals_join_first(spark, results, sessions, places):
    res = spark.createDataFrame(
        [(f"R{i}", iid, "E", loc, 1, act, None, flag, None, None)
         for i, (iid, loc, flag, act) in enumerate(results)], schemas.INVENTORY_RESULTS)
    ses = spark.createDataFrame(
        [(iid, dt.date.fromisoformat(d), 0, 0, "s", 0, "n") for iid, d in sessions],
        schemas.INVENTORY_SESSIONS)
    loc = spark.createDataFrame([(k, z, "R", "S", True) for k, z in places], schemas.STORAGE_LOCATIONS)
    got = marts.inventory_accuracy(res, ses, loc, broadcast="auto")
    keys5 = ["inventory_id", "session_date", "zone", "rack", "shelf"]
    joined = (res.join(ses.drop("location_id"), "inventory_id", "left")
              .join(loc.drop("is_active"), "location_id", "left"))
    want = joined.groupBy(*keys5).agg(
        F.count(F.lit(1)).alias("checked_equipment"),
        flag_count("discrepancy_flag").alias("discrepancies"),
        F.sum("actual_presence").alias("actual_presence_sum"),
    ).withColumn("inventory_accuracy", accuracy("discrepancies", "checked_equipment"))
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert want.select(*got.columns).exceptAll(got).count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(assets=st.lists(st.tuples(keys, statuses), max_size=12),
       places=st.lists(st.tuples(keys, st.sampled_from(["Z1", "Z2"]), st.booleans()), max_size=5))
def test_utilization_preaggregation_equals_join_first(spark, assets, places):
    eq = spark.createDataFrame(
        [(f"E{i}", None, None, None, None, None, s, k, None, None, None, None, None, None)
         for i, (k, s) in enumerate(assets)], schemas.EQUIPMENT)
    loc = spark.createDataFrame([(k, z, "R", "S", a) for k, z, a in places], schemas.STORAGE_LOCATIONS)
    got = marts.location_utilization(eq, loc, V, broadcast="auto")
    want = eq.join(loc, "location_id", "left").groupBy("zone", "rack", "shelf", "is_active").agg(
        F.count(F.lit(1)).alias("equipment_count"),
        value_count("status", V.working).alias("working"),
        value_count("status", V.in_repair).alias("in_repair"),
        value_count("status", V.reserve).alias("in_reserve"))
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert want.select(*got.columns).exceptAll(got).count() == 0
