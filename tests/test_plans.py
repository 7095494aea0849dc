"""Physical-plan properties: partial aggregation before every exchange,
pruned scans, size-checked broadcasts, no Python UDFs, no cartesian joins."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL
from shelfwise.operators.joins import broadcast_size_ok, bounded_broadcast
from shelfwise.plans import marts
from shelfwise.plans.registry import QUERIES
from shelfwise.sources import adapters
from shelfwise.vocab import ADAPTER_VOCAB as V


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture(scope="module")
def t(spark):
    return adapters.source_tables(spark, SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_no_cartesian(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL), "extended")
    for banned in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                   "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas"):
        assert banned not in text, f"{name} plan has {banned}"


def test_location_utilization_preaggregates(spark, t):
    df = marts.location_utilization(t["equipment"], t["storage_locations"], V)
    physical = plan(df, "simple")
    # the asset table is collapsed to one partial row per place per task
    assert re.search(r"HashAggregate\(keys=\[location_id#\d+\], functions=\[partial_count", physical)
    # exchanges: per-place aggregate, the dimension side, the final 4-key group
    assert exchanges(physical) <= 3
    # the orders scan reads only the three columns the mart uses
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>",
                     plan(df))


def test_maintenance_summary_reaggregates_without_extra_exchange(spark, t):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(marts.maintenance_summary(t["maintenance_logs"], t["equipment"], V), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # one exchange for the per-asset aggregate, one for the asset side of the
    # join; the final re-aggregation reuses the join's partitioning
    assert exchanges(text) == 2
    assert "SortMergeJoin" in text


def test_equipment_health_broadcasts_proven_dimensions(spark, t):
    text = plan(marts.equipment_health(t["equipment"], t["storage_locations"], t["employees"],
                                       "2001-12-31"), "simple")
    assert text.count("BroadcastHashJoin") >= 2
    assert exchanges(text) == 0


def test_equipment_health_falls_back_to_shuffle_join_over_budget(spark, t):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = marts.equipment_health(t["equipment"], t["storage_locations"], t["employees"],
                                    "2001-12-31")
        text = plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" not in text
    assert "SortMergeJoin" in text


def test_size_probe(spark, t):
    loc = t["storage_locations"]
    assert broadcast_size_ok(loc)
    assert not broadcast_size_ok(loc, max_bytes=100)
    assert not broadcast_size_ok(t["inventory_results"], max_bytes=1 << 16)
    # the hint is only attached after a passing probe
    hinted = plan(t["equipment"].join(bounded_broadcast(loc), "location_id", "left"), "extended")
    refused = plan(t["equipment"].join(bounded_broadcast(loc, max_bytes=100), "location_id", "left"),
                   "extended")
    assert "strategy=broadcast" in hinted
    assert "strategy=broadcast" not in refused


def test_size_probe_refuses_a_large_frame(spark):
    big = spark.range(0, 50_000_000, 1, 200).selectExpr("id", "CAST(id AS STRING) AS s")
    assert not broadcast_size_ok(big, max_bytes=1 << 20)


def test_refused_dimension_is_merged_whatever_its_file_size(spark, scratch):
    """Files compress far below the broadcast threshold; the rows do not fit it."""
    spark.range(400_000).selectExpr("CAST(id AS INT) AS location_id", "repeat('x', 60) AS zone") \
        .write.parquet(f"{scratch}/dim")
    dim, fact = spark.read.parquet(f"{scratch}/dim"), spark.range(10).selectExpr("CAST(id AS INT) AS location_id")
    text = plan(fact.join(bounded_broadcast(dim), "location_id", "left"), "simple")
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_accuracy_above_the_budget_has_two_exchanges(spark, t):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(marts.results_dated(t["inventory_results"], t["inventory_sessions"]), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # one exchange a side; both aggregates reuse the join's partitioning
    assert exchanges(text) == 2


def test_active_filter_reaches_the_scan(spark, t):
    from shelfwise.operators import rules
    text = plan(rules.active_locations(t["storage_locations"]))
    # is_active is derived (s_acctbal >= 0); the predicate is pushed to Parquet
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(s_acctbal,0\.0\)", text)


def test_rules_plans_above_broadcast_budget(spark, t):
    from shelfwise.operators import rules
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        recon = plan(rules.reconcile_sessions(t["inventory_sessions"], t["inventory_results"]), "simple")
        moved = plan(rules.item_moved(t["inventory_results"], t["equipment"]), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # D3: per-session aggregate (partial below its exchange) joins the sessions
    # on its own partitioning: one exchange per side, none after
    assert exchanges(recon) == 2 and "SortMergeJoin" in recon and "partial_sum" in recon
    # D2: one shuffle join of results and the two asset columns it needs
    assert exchanges(moved) == 2 and "SortMergeJoin" in moved
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>", plan(
        rules.item_moved(t["inventory_results"], t["equipment"])))
