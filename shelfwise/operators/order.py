"""Proof that written parts are in order.

A sorted dataset is a promise about files: rows ascend within each part, and a part
begins where the one before it ended.  ``order_digest`` reads only the sort keys with
their file and row number, compares neighbours within blocks of a file's rows, and then
the ends of neighbouring blocks (a row per block), so no task sorts a whole file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .joins import tasks_for

BLOCK_ROWS = 50_000


def order_digest(spark: SparkSession, uri: str, keys: Sequence[str]) -> DataFrame:
    """One row over the Parquet parts of ``uri``, by file name: ``n_rows``, ``n_parts``,
    ``inversions`` (rows below the row before them in their part), ``overlaps`` (parts
    that begin below the end of the part before), and the first and last value of the
    leading key.  Ascending, NULLs first."""
    found = spark.read.parquet(uri)
    row = F.col("_metadata.row_index")
    rows = found.select(F.struct(*keys).alias("key"), F.col("_metadata.file_name").alias("file"), row.alias("row"),
                        F.floor(row / BLOCK_ROWS).alias("block"))
    if n := tasks_for(found, found.count()):
        rows = rows.repartition(n, "file", "block")
    within = Window.partitionBy("file", "block").orderBy("row")
    per_block = rows.withColumn("before", F.lag("key").over(within)).groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") > F.col("key")).alias("inversions"),
        F.min_by("key", "row").alias("first"), F.max_by("key", "row").alias("last"))
    ends = per_block.withColumn("before", F.lag("last").over(Window.orderBy("file", "block")))  # a row per block
    starts, below, place = F.col("block") == 0, F.col("before") > F.col("first"), F.struct("file", "block")
    return ends.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(starts).alias("n_parts"),
        F.coalesce(F.sum(F.col("inversions") + F.when(~starts & below, 1).otherwise(0)), F.lit(0)).alias("inversions"),
        F.count_if(starts & below).alias("overlaps"),
        F.min_by(F.col(f"first.{keys[0]}"), place).alias(f"first_{keys[0]}"),
        F.max_by(F.col(f"last.{keys[0]}"), place).alias(f"last_{keys[0]}"))
