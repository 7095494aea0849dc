"""The spark-submit entry runs the whole daily job in its own process."""

from __future__ import annotations

import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL
from shelfwise import schemas
from shelfwise.config import LayerPaths
from shelfwise.plans import pipeline


def test_run_pipeline_entry(spark, scratch):
    paths = LayerPaths.under(f"{scratch}/layers")
    pipeline.stage_driver_tables(spark, SF_SMALL, paths.raw)
    env = {**os.environ, "PYTHONPATH": ROOT}
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "run_pipeline.py"), "--root", f"{scratch}/layers",
         "--as-of", "2001-12-31", "--vocab", "adapter", "--load-warehouse", "--checks",
         "--warehouse-root", f"{scratch}/wh"],
        env=env, capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    for name in schemas.MART_NAMES:
        assert spark.read.parquet(f"{paths.dm}/{name}").count() > 0
    util = spark.read.parquet(f"{paths.dm}/location_utilization")
    assert util.columns == schemas.LOCATION_UTILIZATION.fieldNames()
    assert os.path.isdir(f"{scratch}/wh/dm/responsible_load".replace("file://", ""))
    checks = {r.rule: r.rows_flagged for r in spark.read.parquet(f"{paths.dm}/_checks").collect()}
    assert set(checks) == {"discrepancy_flag_missing", "items_moved",
                           "sessions_unreconciled", "flagged_without_session", "inactive_locations"}


def test_object_store_settings_from_env(monkeypatch):
    from shelfwise.config import object_store_conf_from_env
    assert object_store_conf_from_env("SWTEST") == {}
    monkeypatch.setenv("SWTEST_S3_ENDPOINT", "http://store:9000")
    monkeypatch.setenv("SWTEST_S3_ACCESS_KEY", "a")
    monkeypatch.setenv("SWTEST_S3_SECRET_KEY", "b")
    conf = object_store_conf_from_env("SWTEST")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_sizing_conf_bounds():
    from shelfwise.config import sizing_conf
    big = sizing_conf(100 << 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 1 << 30
    small = sizing_conf(40 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 128 << 20


def test_layer_paths(monkeypatch):
    from shelfwise.config import LayerPaths
    p = LayerPaths.under("s3a://bucket/2024/12/")
    assert (p.raw, p.dds, p.dm) == ("s3a://bucket/2024/12/raw", "s3a://bucket/2024/12/dds",
                                    "s3a://bucket/2024/12/dm")
    for k, v in {"SWT_RAW_URI": "r", "SWT_DDS_URI": "d", "SWT_DM_URI": "m"}.items():
        monkeypatch.setenv(k, v)
    assert LayerPaths.from_env("SWT") == LayerPaths("r", "d", "m")


def test_broadcast_budget_parsing(spark):
    from shelfwise.operators.joins import _budget
    df = spark.range(1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for raw, want in (("10485760b", 10 << 20), ("64m", 64 << 20), ("1g", 1 << 30), ("-1", -1)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", raw)
            assert _budget(df, None) == want
        assert _budget(df, 123) == 123
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
