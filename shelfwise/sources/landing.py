"""Land source CSV files into the raw zone, and probe a source.

Landing copies files, not rows: each file of ``{source}/{name}.csv`` becomes one
part of ``{raw}/{name}.csv`` with the same bytes (broken records, quotes, line ends
and headers as they are), copied by a task of its own and compared by size and
checksum.  ``{raw}/_landed/{name}`` keeps what was landed: source file, bytes,
lines and checksum; ``verify_landed`` holds the raw zone against it.

A missing source is skipped with a warning and keeps what the raw zone had; the
returned status says so, and the daily run fails on it.
"""

from __future__ import annotations

import logging
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..actions import run_concurrently
from .csv_scan import raw_uri, read_csv
from .parts import FILES_DDL, SourceFile, check_copies, copy_files

log = logging.getLogger(__name__)


def landed_uri(raw_root: str, name: str) -> str:
    return f"{raw_root.rstrip('/')}/_landed/{name}"


def land_raw(spark: SparkSession, source_root: str, raw_root: str,
             tables: tuple[str, ...] = schemas.SOURCE_TABLES) -> dict[str, str]:
    """Copy ``{source}/{name}.csv`` to the raw zone; returns ``{name: status}``
    with status ``landed`` or ``missing``."""
    def land(name: str) -> str:
        src = raw_uri(source_root, name)
        try:
            files = copy_files(spark, src, raw_uri(raw_root, name))
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            log.warning("source %s not found, skipped", src)
            return "missing"
        rows = [(f.path, f.size, f.n_lines, f.n_bytes, Decimal(f.digest), f.line_end, f.marked) for f in files]
        spark.createDataFrame(rows, FILES_DDL).coalesce(1).write.mode("overwrite").parquet(landed_uri(raw_root, name))
        return "landed"

    # independent tables land side by side
    return run_concurrently({name: (lambda n=name: land(n)) for name in tables})


def verify_landed(spark: SparkSession, raw_root: str, tables: tuple[str, ...] = schemas.SOURCE_TABLES) -> None:
    """Raise ``OSError`` if a landed table is not what was landed (a part lost,
    added or altered since)."""
    for name in tables:
        kept = spark.read.schema(FILES_DDL).parquet(landed_uri(raw_root, name)).collect()
        check_copies(spark, [SourceFile(*r[:4], int(r.digest), r.line_end, r.marked) for r in kept], raw_uri(raw_root, name))


def peek(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (``show(n)`` as a DataFrame)."""
    return df.limit(n)


def probe_source(spark: SparkSession, uri: str, sample: int = 5) -> DataFrame:
    """One row ``(source, n_rows, sample_rows)`` for a CSV source: its row count
    and how many rows a sample of ``sample`` rows, read in full, really gives."""
    df = read_csv(spark, uri)
    rows = peek(df, sample).collect()
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(uri.rstrip("/").rsplit("/", 1)[-1].removesuffix(".csv")).alias("source"), F.col("n_rows"),
        F.lit(len(rows)).cast("long").alias("sample_rows"))
