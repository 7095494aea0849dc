"""Parquet and CSV dataset writes for the dds and dm layers.

``write_dataset`` writes Parquet once and makes the CSV export **from the
written Parquet**, so the export neither recomputes the plan nor keeps its
lineage alive.  The export writes one part per task, or parts of at most
``max_records`` rows, each with a header; ``read_csv_export`` reads all back.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..actions import run_concurrently
from ..sources.csv_scan import CSV_OPTIONS
from ..sources.parts import FILES_DDL, SourceFile, check_copies, describe

SNAPSHOT_COLUMN = "snapshot_date"

#: Of layers and warehouse tables, whose texts are keys for the most part: half the disk of Spark's default.
PARQUET_CODEC = "zstd"


def write_parquet(df: DataFrame, uri: str, partition_by: Sequence[str] = (), rebalance: bool = False) -> str:
    """Overwrite a Parquet dataset.  With ``partition_by`` only the partitions
    present in ``df`` are replaced (dynamic partition overwrite), so a daily
    snapshot partition can be rewritten without touching history.

    ``rebalance`` deals the rows out again before the write, for one more exchange:
    AQE then joins small and splits large partitions to about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, whatever the number of
    shuffle partitions and however hot a key.  Not for sorted frames.
    """
    writer = (df.hint("rebalance") if rebalance else df).write.mode("overwrite").option("compression", PARQUET_CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(uri)
    return uri


def write_csv(df: DataFrame, uri: str, max_records: int = 0, manifest: bool = False, compression: str = "none") -> str:
    """Overwrite a CSV dataset, a header in each part; with ``max_records`` no
    part has more rows.  Parts are numbered in the order of a sorted frame.  With
    ``manifest`` lines, bytes and checksum of every part are kept beside them."""
    (df.write.mode("overwrite").options(**CSV_OPTIONS).option("maxRecordsPerFile", str(max_records))
       .option("compression", compression).option("zlib.compress.level", "BEST_SPEED").csv(uri))
    if manifest:
        spark = df.sparkSession
        rows = [(f.path, f.size, f.n_lines, f.n_bytes, Decimal(f.digest), f.line_end, f.marked) for f in describe(spark, uri)]
        spark.createDataFrame(rows, FILES_DDL).coalesce(1).write.mode("overwrite").parquet(f"{uri}/_manifest")
    return uri


def check_export(spark: SparkSession, uri: str) -> None:
    """Raise ``OSError`` unless the export's parts are those of its manifest: none
    lost, altered or added.  An export without a manifest raises ``PATH_NOT_FOUND``."""
    kept = spark.read.schema(FILES_DDL).parquet(f"{uri}/_manifest").collect()
    check_copies(spark, [SourceFile(*r[:4], int(r.digest), r.line_end, r.marked) for r in kept], uri)


def _has_snapshots(spark: SparkSession, uri: str) -> bool:
    """Whether the dataset has snapshot partitions (a listing, no read)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{uri}/{SNAPSHOT_COLUMN}=*")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def dataset_uris(layer_uri: str, name: str) -> tuple[str, str]:
    base = f"{layer_uri.rstrip('/')}/{name}"
    return base, f"{base}_csv"


def write_dataset(spark: SparkSession, df: DataFrame, layer_uri: str, name: str,
                  export_csv: bool = True, max_records: int = 0,
                  snapshot: _dt.date | str | None = None, rebalance: bool = False) -> DataFrame:
    """Write ``{layer}/{name}`` as Parquet and, optionally, ``{layer}/{name}_csv``.

    With ``snapshot`` (a day), the Parquet dataset is partitioned by
    ``snapshot_date`` and only that day's partition is replaced, so earlier
    days stay as history; the CSV export holds the current day.  Without it a
    dataset that has snapshots is not overwritten: that raises.

    Returns the written data (that day's partition, read back with partition
    pruning) as a fresh DataFrame: lineage is cut at the write, and
    downstream steps read files instead of recomputing.
    """
    parquet_uri, csv_uri = dataset_uris(layer_uri, name)
    # the schema is known, so the read-back skips Parquet footer inference
    if snapshot is None:
        if _has_snapshots(spark, parquet_uri):
            raise ValueError(f"{parquet_uri} keeps snapshots; name the snapshot day to write")
        write_parquet(df, parquet_uri, rebalance=rebalance)
        written = spark.read.schema(df.schema).parquet(parquet_uri)
    else:
        day = _dt.date.fromisoformat(snapshot) if isinstance(snapshot, str) else snapshot
        dated = df.withColumn(SNAPSHOT_COLUMN, F.lit(day))
        write_parquet(dated, parquet_uri, partition_by=[SNAPSHOT_COLUMN], rebalance=rebalance)
        written = (spark.read.schema(dated.schema).parquet(parquet_uri)
                   .where(F.col(SNAPSHOT_COLUMN) == F.lit(day)).drop(SNAPSHOT_COLUMN))
    if export_csv:
        write_csv(written, csv_uri, max_records, manifest=True)
    return written


def write_layer(spark: SparkSession, frames: dict[str, DataFrame], layer_uri: str,
                export_csv: bool = True, max_records: int = 0,
                snapshot: _dt.date | str | None = None,
                max_parallel: int = 6, rebalance: bool = False) -> dict[str, DataFrame]:
    """``write_dataset`` for every frame of a layer, up to ``max_parallel``
    datasets at a time; returns the written frames."""
    return run_concurrently(
        {name: (lambda n=name, df=df: write_dataset(spark, df, layer_uri, n, export_csv,
                                                    max_records, snapshot, rebalance))
         for name, df in frames.items()}, max_parallel)
