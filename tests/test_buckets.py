"""Facts in buckets: the joins of M2, M4, D1 and D3 without an exchange; hot keys stay unbucketed."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.config import LayerPaths
from shelfwise.operators import rules
from shelfwise.plans import marts, pipeline
from shelfwise.sinks import buckets
from shelfwise.sinks.buckets import bucketed, fullest_bucket
from shelfwise.sources import adapters
from shelfwise.vocab import ADAPTER_VOCAB as V


@pytest.fixture(scope="module")
def plain(spark):
    return adapters.source_tables(spark, SF_SMALL)


@pytest.fixture(scope="module")
def held(spark, plain, tmp_path_factory):
    yield bucketed(spark, plain, "buckets_test", f"file://{tmp_path_factory.mktemp('b')}", 5)
    spark.sql("DROP DATABASE buckets_test CASCADE")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_on_the_facts(spark, plain, held):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")  # places fit, facts do not
    try:
        def made(t):
            results = t.get("inventory_results_by_equipment", t["inventory_results"])
            return {
                "m2": marts.results_dated(t["inventory_results"], t["inventory_sessions"]),
                "m4": marts.maintenance_summary(t["maintenance_logs"], t["equipment"], V),
                "d1": rules.check_discrepancy_flags(results, t["equipment"]),
                "d3": rules.reconcile_sessions(t["inventory_sessions"], t["inventory_results"])}
        with_exchange, without = made(plain), made(held)
        for name in without:
            assert "Exchange" in plan(with_exchange[name])
            text = plan(without[name])
            assert "Exchange" not in text and len(re.findall("Bucketed: true", text)) >= 2, name
            assert without[name].exceptAll(with_exchange[name]).count() == 0
            assert without[name].count() == with_exchange[name].count()
        accuracy = marts.inventory_accuracy(held["inventory_results"], held["inventory_sessions"], held["storage_locations"])
        assert "hashpartitioning(inventory_id#" not in re.sub(r"hashpartitioning\(inventory_id#\d+, \w+#", "", plan(accuracy))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_key_is_not_bucketed(spark, plain, tmp_path):
    hot = plain["inventory_results"].withColumn(
        "inventory_id", F.when(F.col("result_id").rlike("[0-4]$"), F.lit("INV-1")).otherwise(F.col("inventory_id")))
    assert fullest_bucket(hot, "inventory_id", 16) > 4 > fullest_bucket(plain["inventory_results"], "inventory_id", 16)
    assert fullest_bucket(hot.limit(0), "inventory_id", 16) == 0
    t = bucketed(spark, {**plain, "inventory_results": hot}, "buckets_hot", f"file://{tmp_path}", 16)
    assert t["inventory_results"] is hot and t["inventory_sessions"] is plain["inventory_sessions"]
    assert "Bucketed: true" in plan(t["maintenance_logs"].groupBy("equipment_id").count())
    spark.sql("DROP DATABASE buckets_hot CASCADE")


def test_daily_run_with_buckets(spark, scratch):
    paths = LayerPaths.under(scratch)
    pipeline.stage_driver_tables(spark, SF_SMALL, paths.raw)
    runs = []
    for buckets in (0, 4):
        out = pipeline.run(spark, paths, as_of="2001-12-31", vocab=V, buckets=buckets, checks=True)["dm"]
        runs.append({n: sorted(map(str, df.collect())) for n, df in out.items()})
    assert runs[0] == runs[1]
    spark.sql("DROP DATABASE dds_buckets CASCADE")


def test_buckets_follow_the_rows(spark, plain, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "TASK_ROWS", 200)
    most = max(plain[n].count() for n, _ in buckets.BUCKETED.values())
    t = bucketed(spark, plain, "buckets_more", f"file://{tmp_path}", 3)
    told = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED buckets_more.inventory_results").collect()}
    n = int(told["Num Buckets"])
    assert n % 3 == 0 and most / n <= 200 < most / (n // 2) and buckets.enough_buckets(plain, 3) == n
    assert buckets.enough_buckets({k: df.limit(0) for k, df in plain.items()}, 3) == 3
    assert "Bucketed: true" in plan(t["inventory_results"].groupBy("inventory_id").count())
    spark.sql("DROP DATABASE buckets_more CASCADE")
