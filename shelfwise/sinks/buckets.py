"""Conformed facts written in buckets, so that their joins need no exchange.

Results and sessions meet on ``inventory_id``, logs and assets on ``equipment_id``;
results also meet assets there (D1, D2), so they are kept a second time by that key.
Written once per day into the same number of buckets, both sides of such a join are
read bucket by bucket, and the grouping after it keeps that partitioning: M2, M4, D1
and D3 shuffle no fact.

A bucket is read by one task, and AQE cannot split it.  So the rows per bucket are
counted first (one row per bucket reaches the driver): where the fullest of a table
holds over ``skew`` times the mean, its key is too hot, and the tables of that key
stay unbucketed, for shuffle joins that deal with it.  For the same reason the number
asked for is the least one: it is doubled until a bucket of no table would have over
``TASK_ROWS`` rows on average.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..actions import run_concurrently
from ..operators.joins import TASK_ROWS
from .warehouse import ensure_schema

#: Bucketed table: (conformed table, key).
BUCKETED = {
    "inventory_results": ("inventory_results", "inventory_id"),
    "inventory_sessions": ("inventory_sessions", "inventory_id"),
    "maintenance_logs": ("maintenance_logs", "equipment_id"),
    "equipment": ("equipment", "equipment_id"),
    "inventory_results_by_equipment": ("inventory_results", "equipment_id"),
}
#: Tables that are bucketed together or not at all.
JOINED = (("inventory_results", "inventory_sessions"), ("maintenance_logs", "equipment"),
          ("inventory_results_by_equipment", "equipment"))


def fullest_bucket(df: DataFrame, key: str, buckets: int) -> float:
    """Rows of the fullest bucket over the mean of all buckets (0 of an empty table)."""
    held = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).count()
    most, rows = held.agg(F.max("count"), F.sum("count")).first()
    return most * buckets / rows if rows else 0.0


def enough_buckets(tables: dict[str, DataFrame], least: int) -> int:
    """``least``, or its first doubling that leaves no table over ``TASK_ROWS`` rows a
    bucket on average."""
    rows = run_concurrently({n: tables[n].count for n in {n for n, _ in BUCKETED.values()}})
    return least << max(0, math.ceil(math.log2(max(*rows.values(), 1) / (least * TASK_ROWS))))


def write_bucketed(df: DataFrame, database: str, table: str, key: str, buckets: int, uri: str) -> DataFrame:
    """Replace a bucketed, sorted table, a file per bucket; returns its scan."""
    spark = df.sparkSession
    qualified = f"`{database}`.`{table}`"
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", uri).saveAsTable(qualified))
    return spark.table(qualified)


def bucketed(spark: SparkSession, tables: dict[str, DataFrame], database: str, root: str, buckets: int,
             skew: float = 4.0) -> dict[str, DataFrame]:
    """``tables`` with the facts read from ``buckets`` buckets, or more for large tables,
    where no bucket is too full, and ``inventory_results_by_equipment`` where that is so
    for its key."""
    ensure_schema(spark, database)
    buckets = enough_buckets(tables, buckets)
    full = run_concurrently({name: (lambda n=n, key=key: fullest_bucket(tables[n], key, buckets))
                             for name, (n, key) in BUCKETED.items()})
    even = {t for pair in JOINED if all(full[t] <= skew for t in pair) for t in pair}
    written = run_concurrently({
        name: (lambda name=name, n=n, key=key: write_bucketed(tables[n], database, name, key, buckets,
                                                              f"{root.rstrip('/')}/{name}"))
        for name, (n, key) in BUCKETED.items() if name in even})
    return {**tables, **written}
