"""Grouped aggregates shared by the marts and the single-operator queries.

Each helper is one ``groupBy().agg()``: Spark plans it as a partial
(map-side) aggregate, one hash exchange on the keys, and a final aggregate,
so a key holding a third of the rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditional import accuracy, flag_count, value_count, value_counts
from ..vocab import Vocabulary
from .exact import exact_sum, merged, parts


def status_counts(vocab: Vocabulary, *, with_reserve: bool = True) -> dict[str, str]:
    """``{alias: status}`` for the per-status sub-counts.  Written-off assets
    have no sub-count: they appear only in the totals."""
    counts = {"working": vocab.working, "in_repair": vocab.in_repair}
    if with_reserve:
        counts["in_reserve"] = vocab.reserve
    return counts


def count_rows(df: DataFrame, keys: list[str], alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def equipment_status_counts(equipment: DataFrame, keys: list[str], vocab: Vocabulary,
                            total_alias: str = "equipment_count",
                            with_reserve: bool = True) -> DataFrame:
    return equipment.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(total_alias),
        *value_counts("status", status_counts(vocab, with_reserve=with_reserve)))


def result_counts(results: DataFrame, keys: list[str]) -> DataFrame:
    """Checked items, flagged discrepancies and summed presence per key."""
    return results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("checked_equipment"),
        flag_count("discrepancy_flag").alias("discrepancies"),
        F.sum("actual_presence").alias("actual_presence_sum"))


def with_accuracy(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "inventory_accuracy", accuracy("discrepancies", "checked_equipment"))


def maintenance_totals(logs: DataFrame, keys: list[str], vocab: Vocabulary, again: bool = False) -> DataFrame:
    """Events, overdue events, hours, cost and last date per key.  The sums of
    doubles are exact; ``again`` leaves them as parts that ``resum`` can add up."""
    doubles = {"total_duration_hours": "duration_hours", "total_cost": "cost"}
    sums = [part for name, c in doubles.items() for part in parts(c, name)] if again else [
        exact_sum(c).alias(name) for name, c in doubles.items()]
    return logs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("maintenance_events"),
        value_count("maintenance_status", vocab.maint_overdue).alias("overdue_events"),
        *sums, F.max("maintenance_date").alias("last_maintenance_date"))


def resum(df: DataFrame, keys: list[str], sums: list[str], maxes: tuple[str, ...] = (),
          exact: tuple[str, ...] = ()) -> DataFrame:
    """Re-aggregate partial results after a join: counts and sums add up,
    maxima take the max, ``exact`` sums merge their parts, so pre-aggregating
    before a join is exact."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *[merged(c) for c in exact],
                                 *[F.max(c).alias(c) for c in maxes])
