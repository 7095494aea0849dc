"""Session and layer-path configuration.

Layer locations are plain Hadoop URIs (``s3a://bucket/prefix``,
``hdfs://…``, ``file:/…``), so the same job runs against an object store
on a cluster and against a local folder in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class LayerPaths:
    """Where each layer lives: raw CSV, conformed (dds) and marts (dm)."""

    raw: str
    dds: str
    dm: str

    @classmethod
    def under(cls, root: str) -> "LayerPaths":
        root = root.rstrip("/")
        return cls(raw=f"{root}/raw", dds=f"{root}/dds", dm=f"{root}/dm")

    @classmethod
    def from_env(cls, prefix: str = "SHELFWISE") -> "LayerPaths":
        """``{prefix}_RAW_URI``, ``{prefix}_DDS_URI``, ``{prefix}_DM_URI``."""
        return cls(
            raw=os.environ[f"{prefix}_RAW_URI"],
            dds=os.environ[f"{prefix}_DDS_URI"],
            dm=os.environ[f"{prefix}_DM_URI"],
        )


# Session settings the jobs rely on.  AQE re-plans joins from measured
# shuffle sizes and splits skewed partitions; UTC keeps CSV round trips of
# timestamps stable.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot keys also where an aggregate reuses the join's partitioning (M2, M4)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def object_store_conf_from_env(prefix: str = "SHELFWISE") -> dict[str, str]:
    """S3A settings from ``{prefix}_S3_ENDPOINT``, ``{prefix}_S3_ACCESS_KEY``,
    ``{prefix}_S3_SECRET_KEY`` (and ``{prefix}_S3_SSL``); empty if unset."""
    endpoint = os.environ.get(f"{prefix}_S3_ENDPOINT")
    if not endpoint:
        return {}
    return object_store_conf(endpoint, os.environ[f"{prefix}_S3_ACCESS_KEY"],
                             os.environ[f"{prefix}_S3_SECRET_KEY"],
                             ssl=os.environ.get(f"{prefix}_S3_SSL", "false").lower() == "true")


def object_store_conf(endpoint: str, access_key: str, secret_key: str,
                      path_style: bool = True, ssl: bool = False) -> dict[str, str]:
    """S3A settings for an S3-compatible store (needs hadoop-aws on the classpath)."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def sizing_conf(input_bytes: int, total_cores: int,
                target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a run over ``input_bytes`` on ``total_cores``.

    * initial shuffle partitions: enough for ``target_partition_bytes`` per
      reducer on a shuffle as large as the input, three waves of tasks at
      least; AQE coalesces small ones and splits skewed ones;
    * scan splits: large enough to keep the task count near ten waves, never
      above 1 GiB so a split still fits an executor's memory when decoded.
    """
    waves = max(1, total_cores)
    shuffle = max(3 * waves, -(-input_bytes // target_partition_bytes))
    split = min(max(input_bytes // (10 * waves), 128 << 20), 1 << 30)
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        # files and tasks of the advisory size rather than as many as there are cores
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(app_name: str = "shelfwise", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this must name shared storage (HDFS, object store) and is
    only read here.  A folder of our own is created only when the session has
    none *and* runs in local mode (tests, single-machine runs).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder "
                                   "(e.g. hdfs:// or s3a://) for intermediate tables")
            current = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    return f"{shared_dir(spark)}/shelfwise/{name}-{uuid.uuid4().hex[:12]}"
