"""raw CSV -> conformed (dds) Parquet -> marts (dm) -> warehouse.

One Spark application per daily run.  Conformed tables are written once
and every mart reads them back as Parquet (column-pruned, vectorised
scans); the CSV exports are made from the written Parquet.  Each layer
write is an idempotent overwrite, so a re-run after a failure (or a lost
executor mid-job, which Spark's commit protocol already retries) leaves
exactly one copy.

    spark-submit --py-files shelfwise.zip run_pipeline.py --root s3a://bucket/2024/12
"""

from __future__ import annotations

import argparse
import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..config import LayerPaths, build_session, object_store_conf_from_env, sizing_conf
from ..operators.conform import conform_observed, observed_rejects
from ..operators.rules import rule_summary
from ..actions import run_concurrently
from ..sinks.buckets import bucketed
from ..sinks.files import write_csv, write_layer, write_parquet
from ..sinks.publish import publish_layers
from ..sinks.warehouse import load_layers
from ..sources import adapters
from ..sources.csv_scan import load_raw, raw_uri
from ..sources.landing import land_raw
from ..vocab import ADAPTER_VOCAB, SOURCE_VOCAB, Vocabulary
from .marts import build_marts

log = logging.getLogger(__name__)

REJECTS_SCHEMA = "table_name STRING, column_name STRING, rejected_values BIGINT"


def stage_driver_tables(spark: SparkSession, sf_dir: str, raw_root: str,
                        tables: tuple[str, ...] = schemas.SOURCE_TABLES, packed: tuple[str, ...] = ()) -> str:
    """Write the six tables derived from the driver tables as raw CSV
    (``{raw}/{name}.csv``), the shape an upstream feed delivers; those of ``packed``
    come as compressed parts."""
    run_concurrently({
        name: (lambda n=name: write_csv(adapters.source_table(spark, sf_dir, n, conformed=False),
                                        raw_uri(raw_root, n), compression="gzip" if n in packed else "none"))
        for name in tables})
    return raw_root


def build_dds(spark: SparkSession, paths: LayerPaths, export_csv: bool = False,
              snapshot: _dt.date | str | None = None, multi_line: bool = True
              ) -> dict[str, DataFrame]:
    """Raw text -> try-cast conform -> dds Parquet (+ CSV); returns the
    written tables.

    Values that do not convert become NULL; how many per column is counted
    during the same write (observed metrics) and saved as the small dataset
    ``{dds}/_rejects`` (table_name, column_name, rejected_values).
    """
    observed = {n: conform_observed(n, df) for n, df in load_raw(spark, paths, typed=False, multi_line=multi_line).items()}
    written = write_layer(spark, {n: df for n, (df, _) in observed.items()},
                          paths.dds, export_csv, snapshot=snapshot)
    rejects = observed_rejects({n: obs for n, (_, obs) in observed.items()})
    for table, column, n in rejects:
        if n:
            log.warning("%s.%s: %d values did not convert and were set to NULL", table, column, n)
    write_parquet(spark.createDataFrame(rejects, REJECTS_SCHEMA).coalesce(1),
                  f"{paths.dds.rstrip('/')}/_rejects")
    return written


def build_dm(spark: SparkSession, dds: dict[str, DataFrame], paths: LayerPaths,
             as_of: _dt.date | str | None = None, vocab: Vocabulary = SOURCE_VOCAB,
             export_csv: bool = False,
             sort: bool = False, snapshot: _dt.date | str | None = None,
             rebalance: bool = False, dealt: bool = False) -> dict[str, DataFrame]:
    """All five marts from the written dds tables -> dm Parquet (+ CSV).
    ``rebalance`` sizes the files of unsorted marts (see ``write_parquet``)."""
    marts = build_marts(dds, as_of=as_of, vocab=vocab, sort=sort, dealt=dealt)
    return write_layer(spark, marts, paths.dm, export_csv, snapshot=snapshot, rebalance=rebalance and not sort)


def build_checks(spark: SparkSession, dds: dict[str, DataFrame], paths: LayerPaths) -> DataFrame:
    """Data-rule summary over the written dds tables -> ``{dm}/_checks``."""
    uri = f"{paths.dm.rstrip('/')}/_checks"
    write_parquet(rule_summary(dds).coalesce(1), uri)
    return spark.read.parquet(uri)


def run(spark: SparkSession, paths: LayerPaths, as_of: _dt.date | str | None = None,
        vocab: Vocabulary = SOURCE_VOCAB, export_csv: bool = False,
        sort: bool = False, warehouse_root: str | None = None,
        load_warehouse: bool = False, warehouse_source: str = "parquet",
        snapshot: _dt.date | str | None = None, checks: bool = False, source_root: str | None = None,
        multi_line: bool = True, max_rejects: int | None = 0, publish: bool = False, rebalance: bool = False,
        buckets: int = 0
        ) -> dict[str, dict[str, DataFrame]]:
    """One daily run; with ``source_root`` the sources are landed first, and a
    missing one fails the run (the raw zone may still hold an older copy)."""
    if source_root:
        missing = [n for n, status in land_raw(spark, source_root, paths.raw).items() if status != "landed"]
        if missing:
            raise FileNotFoundError(f"no source for {', '.join(sorted(missing))} under {source_root}")
    dds = build_dds(spark, paths, export_csv, snapshot, multi_line)
    facts = bucketed(spark, dds, "dds_buckets", f"{paths.dds.rstrip('/')}/_buckets", buckets) if buckets else dds
    dm = build_dm(spark, facts, paths, as_of, vocab, export_csv, sort, snapshot, rebalance,
                  dealt=facts["inventory_results"] is not dds["inventory_results"])
    if checks:
        dm = {**dm, "_checks": build_checks(spark, facts, paths)}
    if load_warehouse:
        if warehouse_source == "csv" and not export_csv:
            raise ValueError("a warehouse load from CSV needs the CSV exports")
        load = publish_layers if publish else load_layers
        load(spark, paths, warehouse_root, source=warehouse_source, snapshot=snapshot, max_rejects=max_rejects,
             multi_line=multi_line)
    return {"dds": dds, "dm": dm}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Build the dds and dm layers (and load the warehouse).")
    p.add_argument("--root", help="layer root URI: {root}/raw, {root}/dds, {root}/dm")
    p.add_argument("--raw"), p.add_argument("--dds"), p.add_argument("--dm")
    p.add_argument("--as-of", help="reporting day YYYY-MM-DD (default: today)")
    p.add_argument("--vocab", choices=("source", "adapter"), default="source")
    p.add_argument("--csv", action="store_true", help="also export the layers as CSV")
    p.add_argument("--source", help="land {source}/{table}.csv into the raw layer first; a missing table fails")
    p.add_argument("--single-line", action="store_true",
                   help="no field of the source holds a line break: large files are read by many tasks")
    p.add_argument("--sort", action="store_true", help="globally sort the sorted marts before writing")
    p.add_argument("--buckets", type=int, default=0,
                   help="write the conformed facts in so many buckets too, so that their joins need no exchange")
    p.add_argument("--rebalance", action="store_true",
                   help="deal the marts out again before writing, for files near the advisory partition size")
    p.add_argument("--load-warehouse", action="store_true")
    p.add_argument("--warehouse-root")
    p.add_argument("--publish", action="store_true",
                   help="load a new generation of the warehouse and switch all its tables at once")
    p.add_argument("--max-rejects", type=int, default=0,
                   help="values of the raw files that may fail to convert in a warehouse load (-1: any number)")
    p.add_argument("--warehouse-source", choices=("parquet", "csv"), default="parquet")
    p.add_argument("--snapshot-date", help="keep history: partition Parquet layers by this day")
    p.add_argument("--checks", action="store_true", help="write the data-rule summary {dm}/_checks")
    p.add_argument("--input-gb", type=float, help="approximate input size, sizes shuffles and scans")
    p.add_argument("--total-cores", type=int, default=0, help="executor cores of the cluster")
    a = p.parse_args(argv)
    if a.root:
        paths = LayerPaths.under(a.root)
    elif a.raw and a.dds and a.dm:
        paths = LayerPaths(a.raw, a.dds, a.dm)
    else:
        paths = LayerPaths.from_env()
    extra = object_store_conf_from_env()
    if a.input_gb and a.total_cores:
        extra.update(sizing_conf(int(a.input_gb * (1 << 30)), a.total_cores))
    spark = build_session("shelfwise-daily", extra=extra)
    try:
        run(spark, paths, as_of=a.as_of, vocab=SOURCE_VOCAB if a.vocab == "source" else ADAPTER_VOCAB,
            export_csv=a.csv, sort=a.sort, source_root=a.source,
            warehouse_root=a.warehouse_root, load_warehouse=a.load_warehouse,
            warehouse_source=a.warehouse_source, snapshot=a.snapshot_date, checks=a.checks, multi_line=not a.single_line, publish=a.publish, rebalance=a.rebalance, buckets=a.buckets,
            max_rejects=None if a.max_rejects < 0 else a.max_rejects)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
