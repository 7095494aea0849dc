"""Date scalars: as-of day, day differences, age in years."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_column(as_of: _dt.date | str | Column | None = None) -> Column:
    """The reporting day: a fixed date, or today (``current_date``) if None."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """``end - start`` in days (negative when ``end`` is earlier); NULL-propagating."""
    return F.datediff(_col(end), _col(start))


def years_from_days(days: ColumnOrName, digits: int = 2, days_per_year: float = 365.0) -> Column:
    """Age in years, rounded half-up; the year is 365.0 days, not 365.25."""
    return F.round(_col(days) / F.lit(days_per_year), digits)


def is_before(day: ColumnOrName, as_of: Column) -> Column:
    """Three-valued ``day < as_of``: NULL day gives NULL."""
    return _col(day) < as_of
