"""Content digest of a table: one row per column, from one aggregation pass.

Compares two copies of a table (a source and what was landed, a layer and the
warehouse table loaded from it) without joining them.  A shifted column, a
trimmed or cut text, a lost value and a changed number each change a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = ("column_no", "n_rows", "n_values", "total", "low", "high")


def _total_of_doubles(units: Column) -> Column:
    """Exact sum, as text, of units rounded half away from zero.  Below 2^52 a unit's
    fraction is exact and the whole number goes into two BIGINT sums, of its upper bits
    and of its lower ones; larger, infinite and undefined units add up as DECIMAL."""
    size = F.abs(units)
    small = size < float(1 << 52)
    whole = F.floor(size) + (size - F.floor(size).cast("double") >= 0.5).cast("int")
    whole = F.when(small, F.when(units < 0, -whole).otherwise(whole))
    upper, lower = (F.sum(x).cast("decimal(20,0)") for x in (F.shiftright(whole, 26), whole.bitwiseAND(F.lit((1 << 26) - 1))))
    exact = upper * F.lit(1 << 26).cast("decimal(8,0)") + lower
    rest = F.sum(F.when(~small, F.round(units).cast("decimal(20,0)")))
    return F.coalesce(exact + rest, exact, rest).cast("string")


def _total(col: Column, kind: T.DataType) -> Column:
    """Exact sum as text: characters of text, numbers (doubles in units of
    1e-4, so the order of adding does not show), true flags; NULL for dates.

    What fits is added up as BIGINT, which is several times faster than as DECIMAL."""
    if isinstance(kind, T.StringType):
        return F.sum(F.length(col)).cast("string")
    if isinstance(kind, T.BooleanType):
        return F.sum(col.cast("int")).cast("string")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.sum(col).cast("string")
    if isinstance(kind, T.DoubleType):
        return _total_of_doubles(col * 10_000)
    if isinstance(kind, T.FloatType):
        unit = F.round(col * 10_000)
    elif isinstance(kind, T.NumericType):
        unit = col
    else:
        return F.lit(None).cast("string")
    return F.sum(unit.cast("decimal(20,0)")).cast("string")


def _bound(fn, col: Column, kind: T.DataType) -> Column:
    """Least or greatest text, date or timestamp as text; NULL for numbers."""
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.lit(None).cast("string")
    return fn(col).cast("string")


def column_digest(df: DataFrame) -> DataFrame:
    """Columns ``COLUMNS``; ``column_no`` counts from 0 in the frame's order.
    An empty table gives its columns with zero counts and NULLs."""
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for i, f in enumerate(df.schema.fields):
        col = F.col(f"`{f.name}`")
        measures += [F.count(col).alias(f"n{i}"), _total(col, f.dataType).alias(f"t{i}"),
                     _bound(F.min, col, f.dataType).alias(f"l{i}"), _bound(F.max, col, f.dataType).alias(f"h{i}")]
    rows = ", ".join(f"{i}, n{i}, t{i}, l{i}, h{i}" for i in range(len(df.columns)))
    stacked = f"stack({len(df.columns)}, {rows}) AS (column_no, n_values, total, low, high)"
    return df.agg(*measures).selectExpr("n_rows", stacked).select(*COLUMNS)
