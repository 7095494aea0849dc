"""Sums of doubles that do not depend on the order of adding.

A plain sum of doubles rounds at every step, so its last digits follow the
partitioning.  Here each value is cut into whole numbers, one above the point and
three limbs of 20 bits below it, which add up exactly as BIGINT (the limbs within
2^43 rows); only the total is rounded, once, to the nearest double.

Exact for values under 2^40 in size, to 2^-60 (smaller bits of a value are cut off).
A group with a larger value, an infinity or NaN, or a total beyond 2^62, has the plain
sum.  NULL values do not count, and a group of only NULLs sums to NULL, as with ``sum``.

``parts`` and ``merged`` carry the exact total through a second aggregation.  The
aggregates are SQL text: a call to the JVM each, not one per operator in them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB_BITS, LIMBS = 20, 3
_LIMB = 1 << LIMB_BITS
_LARGEST = f"{float(1 << 40)!r}D"
_UNIT = f"{float(_LIMB ** LIMBS)!r}D"  # units a whole number has


def _sums(value: str) -> list[str]:
    """Sums of the value in whole numbers, each a limb finer than the one before.  Scaling
    by powers of two and taking off the whole part are exact; casts cut towards zero."""
    scaled = f"(CASE WHEN abs({value}) < {_LARGEST} THEN {value} END * {float(_LIMB)!r}D)"
    upper = f"CAST({scaled} AS BIGINT)"
    lower = f"CAST(({scaled} - CAST({upper} AS DOUBLE)) * {float(_LIMB * _LIMB)!r}D AS BIGINT)"
    limbs = [f(x) for x in (upper, lower) for f in (lambda x: f"shiftright({x}, {LIMB_BITS})", lambda x: f"({x} & {_LIMB - 1}L)")]
    return [f"try_sum({limb})" for limb in limbs]


def _total(limbs: list[str]) -> str:
    """Limb sums as one number, rounded once to a double (NULL if one overflowed)."""
    total = f"CAST({limbs[0]} AS DECIMAL(38,0))"
    for limb in limbs[1:]:
        total = f"CAST(CAST({total} * CAST({_LIMB} AS DECIMAL(8,0)) AS DECIMAL(38,0)) + CAST({limb} AS DECIMAL(38,0)) AS DECIMAL(38,0))"
    return f"CAST({total} AS DOUBLE) / {_UNIT}"


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def exact_sum(column: str) -> Column:
    """Aggregate: the sum of a double column, the same for every order of its rows."""
    value = _quoted(column)
    return F.expr(f"coalesce(CASE WHEN max(abs({value})) < {_LARGEST} THEN {_total(_sums(value))} END, sum({value}))")


def parts(column: str, name: str) -> list[Column]:
    """Aggregates that ``merged`` can sum again: limbs, their range, the plain sum."""
    value = _quoted(column)
    made = {str(i): limb for i, limb in enumerate(_sums(value))} | {
        "in_range": f"max(abs({value})) < {_LARGEST}", "plain": f"sum({value})"}
    return [F.expr(f"{sql} AS {_quoted(f'{name}__{part}')}") for part, sql in made.items()]


def merged(name: str) -> Column:
    """Aggregate over rows of ``parts``: the sum of all their values."""
    limbs = [_quoted(f"{name}__{i}") for i in range(LIMBS + 1)]
    plain = _quoted(f"{name}__plain")
    # in_range is NULL if the part has no value
    whole = " AND ".join([_quoted(f"{name}__in_range"), *[f"{limb} IS NOT NULL" for limb in limbs]])
    exact = _total([f"try_sum({limb})" for limb in limbs])
    return F.expr(f"coalesce(CASE WHEN bool_and({plain} IS NULL OR ({whole})) THEN {exact} END, sum({plain})) AS {_quoted(name)}")
