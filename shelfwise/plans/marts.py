"""The five marts, each a pure ``DataFrame -> DataFrame`` plan.

Plan choices (vs. a literal join-then-group):

* Marts that aggregate (but M2) are **pre-aggregated before their joins**: facts are
  grouped on the join key (plus any key the final grouping needs) first,
  so only partial aggregates cross the shuffle, a hot key collapses to one
  row per task, and the dimension joins touch one row per key instead of
  one row per fact.  Counts and sums re-add, maxima re-max, so the result
  is exactly that of joining first, for duplicate dimension keys too.
* Dimension joins go through ``enrich``.  Where the big side is not
  partitioned on the dimension key (M1, M2) the dimension is broadcast only
  after a size proof; where a pre-aggregate already is (M3, M5) the join is
  left to the planner and AQE, since a shuffle of the dimension alone is
  cheaper than a cluster-wide broadcast.  Beyond the budget it is a shuffle
  join that AQE may convert or split for skew.
* Output columns follow the warehouse DDL order exactly (loads are
  positional).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import as_of_column, days_between, is_before, years_from_days
from ..operators import aggregates as agg
from ..operators.joins import bounded_broadcast_all, broadcast_size_ok, deal_over, enrich, enrich_dealt, tasks_for
from ..vocab import SOURCE_VOCAB, Vocabulary

AsOf = _dt.date | str | Column | None

EMPLOYEE_DIM_COLUMNS = ("responsible_person_id", "full_name", "department", "shift")
LOCATION_DIM_COLUMNS = ("location_id", "zone", "rack", "shelf", "is_active")


def _in_order(df: DataFrame, schema) -> DataFrame:
    return df.select(*schema.fieldNames())


def employee_dim(employees: DataFrame) -> DataFrame:
    """The four employee columns the health mart carries."""
    return employees.select(*EMPLOYEE_DIM_COLUMNS)


def equipment_category_dim(equipment: DataFrame) -> DataFrame:
    return equipment.select("equipment_id", "category")


# --- M1 -------------------------------------------------------------------

def with_equipment_dates(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Age, warranty and maintenance day counts relative to ``as_of``."""
    today = as_of_column(as_of)
    return df.withColumns({
        "age_days": days_between(today, "purchase_date"),
        "age_years": years_from_days(days_between(today, "purchase_date")),
        "warranty_days_left": days_between("warranty_end_date", today),
        "days_since_last_maintenance": days_between(today, "last_maintenance_date"),
        "days_to_next_maintenance": days_between("next_maintenance_date", today),
        "maintenance_overdue": is_before("next_maintenance_date", today),
    })


def equipment_health(equipment: DataFrame, locations: DataFrame, employees: DataFrame,
                     as_of: AsOf = None, broadcast: str = "checked") -> DataFrame:
    """Every asset with its place, owner, age, warranty and maintenance state.

    Row-preserving: two left joins onto the asset table, no aggregation.
    """
    loc, emp = locations.select(*LOCATION_DIM_COLUMNS), employee_dim(employees)
    if broadcast == "checked":
        # probe both dimensions at once, then join without further checks
        dims = bounded_broadcast_all({"loc": loc, "emp": emp})
        loc, emp, broadcast = dims["loc"], dims["emp"], "auto"
    placed = enrich(equipment, loc, "location_id", broadcast)
    owned = enrich(placed, emp, "responsible_person_id", broadcast)
    return _in_order(with_equipment_dates(owned, as_of), schemas.EQUIPMENT_HEALTH)


# --- M2 -------------------------------------------------------------------

def results_with_session(results: DataFrame, sessions: DataFrame) -> DataFrame:
    """Results with their session's attributes.  The session's own
    ``location_id`` is dropped first, so ``location_id`` stays the place
    where the result was recorded."""
    return results.join(sessions.drop("location_id"), "inventory_id", "left")


def results_dated(results: DataFrame, sessions: DataFrame, dealt: bool = False) -> DataFrame:
    """Counts per session, day and recorded place.

    Results and sessions meet first, one exchange a side, and the aggregates
    reuse that partitioning.  Results hardly repeat (session, place), so
    aggregating them before the join would only add an exchange.

    Both sides are dealt over as many partitions as their rows need (``deal_over``),
    but for those that are ``dealt`` already (buckets).  Where a session has more
    results than a task should hold, they are first counted per session and place,
    dealt by both, so that the join gets a row per place of that session.
    """
    results = results.select("inventory_id", "location_id", "discrepancy_flag", "actual_presence")
    sessions = sessions.select("inventory_id", "session_date")
    n, hot = (0, False) if dealt else deal_over(results, sessions, "inventory_id")
    keys = ["inventory_id", "session_date", "location_id"]
    if hot:
        places = agg.result_counts(results.repartition(n, "inventory_id", "location_id"), ["inventory_id", "location_id"])
        dated = places.repartition(n, "inventory_id").join(sessions.repartition(n, "inventory_id"), "inventory_id", "left")
        return agg.resum(dated, keys, ["checked_equipment", "discrepancies", "actual_presence_sum"])
    if n:
        results, sessions = results.repartition(n, "inventory_id"), sessions.repartition(n, "inventory_id")
    return agg.result_counts(results.join(sessions, "inventory_id", "left"), keys)


def inventory_accuracy(results: DataFrame, sessions: DataFrame, locations: DataFrame,
                       sort: bool = False, broadcast: str = "checked", dealt: bool = False) -> DataFrame:
    """Per session and recorded place: checked, discrepancies, presence, accuracy.

    The place is the **result's** location, not the session's; a session
    whose items were recorded at several places yields several rows.

    Beyond the broadcast budget the places are joined, and the counts added up, over as
    many partitions as the results need; so is the sort.
    """
    dated, places = results_dated(results, sessions, dealt), locations.select("location_id", "zone", "rack", "shelf")
    keys = ["inventory_id", "session_date", "zone", "rack", "shelf"]
    large = broadcast == "checked" and not broadcast_size_ok(places)
    n = tasks_for(results, results.count()) if large or sort else 0
    if large and n:
        placed = enrich_dealt(dated, places, "location_id", results, ["inventory_id", "session_date"], n).repartition(n, *keys)
    else:
        mode = broadcast if broadcast != "checked" else "never" if large else "auto"
        placed = enrich(dated, F.broadcast(places) if broadcast == "checked" and not large else places, "location_id", mode)
    out = agg.with_accuracy(agg.resum(
        placed, keys, ["checked_equipment", "discrepancies", "actual_presence_sum"]))
    out = _in_order(out, schemas.INVENTORY_ACCURACY)
    if sort:
        # session_date first; the rest of the group key only breaks ties, so
        # a hot date can still be range-split over several partitions.
        order = ["session_date"] + [k for k in keys if k != "session_date"]
        order = [F.col(k).asc_nulls_first() for k in order]
        out = out.repartitionByRange(n, *order).sortWithinPartitions(*order) if n else out.orderBy(*order)
    return out


# --- M3 -------------------------------------------------------------------

def location_utilization(equipment: DataFrame, locations: DataFrame,
                         vocab: Vocabulary = SOURCE_VOCAB, sort: bool = False,
                         broadcast: str = "auto") -> DataFrame:
    """Assets per place and active flag, with working / repair / reserve counts.

    The per-place aggregate is already hash-partitioned on ``location_id``,
    so a shuffle join costs only the dimension's own exchange; no probe job
    is spent, and the planner (static size) or AQE (measured size) picks a
    broadcast when the dimension is small.
    """
    per_location = agg.equipment_status_counts(equipment, ["location_id"], vocab)
    placed = enrich(per_location, locations.select(*LOCATION_DIM_COLUMNS), "location_id", broadcast)
    keys = ["zone", "rack", "shelf", "is_active"]
    out = agg.resum(placed, keys, ["equipment_count", "working", "in_repair", "in_reserve"])
    out = _in_order(out, schemas.LOCATION_UTILIZATION)
    if sort:
        out = out.orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    return out


# --- M4 -------------------------------------------------------------------

def maintenance_summary(logs: DataFrame, equipment: DataFrame,
                        vocab: Vocabulary = SOURCE_VOCAB, broadcast: str = "auto", dealt: bool = False) -> DataFrame:
    """Events, overdue events, hours, cost and last date per logged asset.

    Assets without logs are absent.  The asset side is a fact table, so it
    is never broadcast-hinted; the logs are collapsed to one row per asset
    before the join, and the join's hash partitioning on ``equipment_id``
    serves the final re-aggregation without another exchange.

    Logs beyond what a task should hold are dealt over as many partitions as their rows
    need, but for those that are ``dealt`` already (buckets); where one asset has that
    many, they are first counted per asset and day.
    """
    assets, keys = equipment_category_dim(equipment), ["equipment_id"]
    n, hot = (0, False) if dealt else deal_over(logs, equipment, "equipment_id")
    if n:
        keys = [*keys, "maintenance_date"] if hot else keys
        logs, assets = logs.repartition(n, *keys), assets.repartition(n, "equipment_id")
    per_asset = agg.maintenance_totals(logs, keys, vocab, again=True)
    if hot:
        per_asset = per_asset.drop("maintenance_date").repartition(n, "equipment_id")
    joined = enrich(per_asset, assets, "equipment_id", broadcast)
    out = agg.resum(joined, ["equipment_id", "category"],
                    ["maintenance_events", "overdue_events"], maxes=("last_maintenance_date",),
                    exact=("total_duration_hours", "total_cost"))
    return _in_order(out, schemas.MAINTENANCE_SUMMARY)


# --- M5 -------------------------------------------------------------------

def responsible_load(equipment: DataFrame, employees: DataFrame,
                     vocab: Vocabulary = SOURCE_VOCAB, broadcast: str = "auto") -> DataFrame:
    """Assets per person (total, working, in repair) with the person's attributes.

    People without assets are absent; assets without a known person form a
    row with NULL attributes.  Aggregated before the join, and partitioned on
    the join key by that aggregate, so the join needs no size probe.
    """
    per_person = agg.equipment_status_counts(
        equipment, ["responsible_person_id"], vocab,
        total_alias="assigned_equipment", with_reserve=False)
    return _in_order(enrich(per_person, employees, "responsible_person_id", broadcast),
                     schemas.RESPONSIBLE_LOAD)


def build_marts(tables: dict[str, DataFrame], as_of: AsOf = None,
                vocab: Vocabulary = SOURCE_VOCAB, sort: bool = False,
                broadcast: str = "checked", dealt: bool = False) -> dict[str, DataFrame]:
    """All five marts from the six conformed tables; ``dealt``: results and sessions
    are in buckets.

    Each dimension is size-probed once here: a proven small one carries its broadcast
    hint into every mart that joins it, but M2, which probes the columns it joins.
    """
    eq, loc, emp = tables["equipment"], tables["storage_locations"], tables["employees"]
    places, checked = loc, broadcast
    if broadcast == "checked":
        dims = bounded_broadcast_all({"loc": loc, "emp": emp})
        loc, emp, broadcast = dims["loc"], dims["emp"], "auto"
    return {
        "equipment_health": equipment_health(eq, loc, emp, as_of, broadcast),
        "inventory_accuracy": inventory_accuracy(
            tables["inventory_results"], tables["inventory_sessions"], places, sort, checked, dealt),
        "location_utilization": location_utilization(eq, loc, vocab, sort, broadcast),
        "maintenance_summary": maintenance_summary(tables["maintenance_logs"], eq, vocab, dealt=dealt),
        "responsible_load": responsible_load(eq, emp, vocab, broadcast),
    }
