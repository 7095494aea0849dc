"""Data rules on the conformed tables.

* ``item_moved``          -- recorded place differs from the asset's home place
* ``check_discrepancy_flags`` -- a presence mismatch or a move must be flagged
* ``reconcile_sessions``  -- session ``discrepancy_count`` vs. flagged results
* ``active_locations``    -- places that are active
* ``with_followup_action`` -- follow-up by discrepancy type

All are joins, filters and one grouped aggregate; row-level rules keep
every input row and add verdict columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditional import flag_count
from ..vocab import SOURCE_VOCAB, Vocabulary


def moved(recorded: Column, home: Column) -> Column:
    """Recorded place differs from home; NULL when either is unknown."""
    return recorded != home


def item_moved(results: DataFrame, equipment: DataFrame) -> DataFrame:
    """Results with ``home_location_id`` and ``item_moved``.

    A left join of two facts on ``equipment_id``: a shuffle join at scale,
    whose skewed partitions (one hot asset) AQE splits.
    """
    home = equipment.select("equipment_id", F.col("location_id").alias("home_location_id"))
    joined = results.join(home, "equipment_id", "left")
    return joined.select(
        *results.columns,
        "home_location_id",
        moved(F.col("location_id"), F.col("home_location_id")).alias("item_moved"))


def flag_required(actual: Column, expected: Column, item_is_moved: Column) -> Column:
    """A discrepancy exists: presence mismatch, or a known move.  An unknown
    move (NULL) counts as no move."""
    return (actual != expected) | F.coalesce(item_is_moved, F.lit(False))


def check_discrepancy_flags(results: DataFrame, equipment: DataFrame) -> DataFrame:
    """Per result: whether a flag is required and whether it is missing.

    ``flag_violation`` is true when a discrepancy exists but the flag is not
    set (false or NULL).  A set flag without a derivable discrepancy is not a
    violation: the place of a moved item may coincide with its home place.
    """
    with_moves = item_moved(results, equipment)
    required = F.coalesce(
        flag_required(F.col("actual_presence"), F.col("expected_presence"), F.col("item_moved")),
        F.lit(False))
    return with_moves.select(
        "result_id", "inventory_id", "equipment_id", "location_id", "home_location_id",
        "expected_presence", "actual_presence", "discrepancy_flag", "item_moved",
        required.alias("flag_required"),
        (required & ~F.coalesce(F.col("discrepancy_flag"), F.lit(False))).alias("flag_violation"))


def reconcile_sessions(sessions: DataFrame, results: DataFrame) -> DataFrame:
    """Sessions with their flagged-result count and the gap to the stated count.

    Results are aggregated per session first (partial aggregation, so a hot
    session costs one row per task), then joined to the sessions.
    ``count_difference = discrepancy_count - flagged_results``.
    """
    flagged = results.groupBy("inventory_id").agg(
        flag_count("discrepancy_flag").alias("flagged_results"))
    joined = sessions.select("inventory_id", "session_date", "discrepancy_count").join(
        flagged, "inventory_id", "left")
    n_flagged = F.coalesce(F.col("flagged_results"), F.lit(0).cast("long"))
    diff = F.col("discrepancy_count").cast("long") - n_flagged
    return joined.select(
        "inventory_id", "session_date", "discrepancy_count",
        n_flagged.alias("flagged_results"),
        diff.alias("count_difference"),
        (diff == 0).alias("is_reconciled"))


def active_locations(locations: DataFrame) -> DataFrame:
    """Places whose ``is_active`` is true (false and NULL are excluded)."""
    return locations.filter(F.col("is_active"))


def followup_action(flag: Column, dtype: Column, vocab: Vocabulary) -> Column:
    """Recount for surplus or moved items, consider write-off for other
    flagged items, nothing when not flagged (NULL flag: not flagged)."""
    recount_types = sorted({vocab.type_surplus, vocab.type_moved})
    return (F.when(F.coalesce(flag, F.lit(False)),
                   F.when(dtype.isin(*recount_types), F.lit(vocab.action_recount))
                    .otherwise(F.lit(vocab.action_write_off)))
            .otherwise(F.lit(vocab.action_none)))


def with_followup_action(results: DataFrame, vocab: Vocabulary = SOURCE_VOCAB) -> DataFrame:
    return results.select(
        "result_id", "inventory_id", "equipment_id", "discrepancy_flag", "discrepancy_type",
        followup_action(F.col("discrepancy_flag"), F.col("discrepancy_type"), vocab)
        .alias("followup_action"))


def rule_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per data rule: ``(rule, rows_flagged)`` over the conformed tables.

    * ``discrepancy_flag_missing`` -- results with a discrepancy but no flag (D1)
    * ``items_moved``              -- results recorded away from home (D2)
    * ``sessions_unreconciled``    -- sessions whose count differs from flagged results (D3)
    * ``flagged_without_session``  -- flagged results whose session is unknown or NULL (beside D3)
    * ``inactive_locations``       -- places not active (D4's complement)

    Each rule is a grouped count; D1 and D2 share one join of results to
    assets and one aggregate.
    """
    by_equipment = tables.get("inventory_results_by_equipment", tables["inventory_results"])
    flags = check_discrepancy_flags(by_equipment, tables["equipment"]).agg(
        F.count_if(F.col("flag_violation")).alias("discrepancy_flag_missing"),
        F.count_if(F.coalesce(F.col("item_moved"), F.lit(False))).alias("items_moved"))
    recon = reconcile_sessions(tables["inventory_sessions"], tables["inventory_results"]).agg(
        F.count_if(~F.coalesce(F.col("is_reconciled"), F.lit(False))).alias("sessions_unreconciled"))
    places = tables["storage_locations"].agg(
        F.count_if(~F.coalesce(F.col("is_active"), F.lit(False))).alias("inactive_locations"))
    known = tables["inventory_sessions"].select("inventory_id")
    lost = (tables["inventory_results"].groupBy("inventory_id")
            .agg(flag_count("discrepancy_flag").alias("flagged")).join(known, "inventory_id", "left_anti")
            .agg(F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged_without_session")))
    return reduce(DataFrame.unionByName, [
        df.selectExpr(f"stack({len(df.columns)}, "
                      + ", ".join(f"'{c}', CAST({c} AS BIGINT)" for c in df.columns) + ") AS (rule, rows_flagged)")
        for df in (flags, recon, lost, places)])
