"""Conform raw text tables to their typed layout (the dds layer).

Raw CSV is read as text (every column a string), then each typed column is
converted with ``try_cast``: malformed values become NULL instead of failing
the job, and ``reject_counts`` reports how many values each column lost.
Maintenance logs get ``status`` renamed to ``maintenance_status``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas
from ..functions.casting import present, rejected, try_convert
from ..sources.csv_scan import CORRUPT

_RENAMES = {"maintenance_logs": {"status": "maintenance_status"}}


def conform(name: str, raw_text: DataFrame) -> DataFrame:
    """Typed, renamed version of a raw text table (columns in DDL order)."""
    target = schemas.RAW_SCHEMAS[name]
    renames = _RENAMES.get(name, {})
    cols = [try_convert(F.col(f"`{f.name}`"), f.dataType).alias(renames.get(f.name, f.name))
            for f in target.fields]
    return raw_text.select(*cols)


def conform_all(raw_text: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: conform(name, df) for name, df in raw_text.items()}


def _typed_fields(name: str):
    return [f for f in schemas.RAW_SCHEMAS[name].fields if f.dataType != schemas.S]


def conform_observed(name: str, raw_text: DataFrame) -> tuple[DataFrame, Observation]:
    """``conform`` plus an ``Observation`` that counts rejected values per
    typed column while the conformed table is being written: no extra pass
    over the data.  Read ``observation.get`` after the write."""
    obs = Observation(f"rejects_{name}")
    renames, typed = _RENAMES.get(name, {}), _typed_fields(name)
    metrics = [F.count_if(F.col(f"{f.name} given") & F.col(f"`{renames.get(f.name, f.name)}`").isNull()).alias(f.name)
               for f in typed]
    kept = [present(F.col(f"`{f.name}`")).alias(f"{f.name} given") for f in typed]
    if CORRUPT in raw_text.columns:  # records with too few or too many fields
        metrics.append(F.count(CORRUPT).alias(CORRUPT))
        kept.append(F.col(CORRUPT))
    made = [try_convert(F.col(f"`{f.name}`"), f.dataType).alias(renames.get(f.name, f.name))
            for f in schemas.RAW_SCHEMAS[name].fields]
    # values are converted once, below the count; a given one that is NULL after that was rejected
    counted = raw_text.select(*made, *kept)
    return (counted.observe(obs, *metrics) if metrics else counted).drop(*[f"{f.name} given" for f in typed], CORRUPT), obs


def observed_rejects(observations: dict[str, Observation]) -> list[tuple[str, str, int]]:
    """``(table_name, column_name, rejected_values)`` from finished observations."""
    return [(name, col, int(n or 0)) for name, obs in observations.items()
            for col, n in obs.get.items()]


def reject_counts(name: str, raw_text: DataFrame) -> DataFrame:
    """One row per typed column: ``(table_name, column_name, rejected_values)``, and
    one for the broken records of a scan that marks them.

    A single aggregation pass over the table, whatever the column count.
    """
    sums = {f.name: F.sum(F.when(rejected(F.col(f"`{f.name}`"), f.dataType), 1).otherwise(0))
            for f in _typed_fields(name)}
    if CORRUPT in raw_text.columns:
        sums[CORRUPT] = F.count(CORRUPT)
    if not sums:
        return raw_text.sparkSession.createDataFrame(
            [], "table_name string, column_name string, rejected_values long")
    counted = raw_text.agg(*[F.coalesce(n, F.lit(0)).cast("long").alias(c) for c, n in sums.items()])
    stacked = ", ".join(f"'{c}', `{c}`" for c in sums)
    return counted.selectExpr(
        f"'{name}' AS table_name",
        f"stack({len(sums)}, {stacked}) AS (column_name, rejected_values)")
