"""Conditional counts and guarded ratios, all JVM-side expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_count(flag: ColumnOrName) -> Column:
    """Rows where a boolean is true; NULL and false count 0, never NULL."""
    return F.sum(F.when(_col(flag), F.lit(1)).otherwise(F.lit(0)))


def value_count(col: ColumnOrName, value: object) -> Column:
    """Rows where ``col == value``; NULL counts 0."""
    return flag_count(_col(col) == F.lit(value))


def value_counts(col: ColumnOrName, aliases: Mapping[str, object]) -> list[Column]:
    """One conditional count per ``{alias: value}``, computed in a single pass."""
    return [value_count(col, v).alias(a) for a, v in aliases.items()]


def accuracy(discrepancies: ColumnOrName, checked: ColumnOrName) -> Column:
    """``1 - discrepancies / checked`` as double, NULL unless ``checked > 0``."""
    n = _col(checked)
    return F.when(n > 0, F.lit(1) - (_col(discrepancies) / n))
