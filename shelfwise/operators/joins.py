"""Left enrichment joins with a size-checked broadcast.

A side is broadcast only after one aggregate has proven its size under a
byte budget (default: the session's ``spark.sql.autoBroadcastJoinThreshold``).
Beyond the budget the join is a shuffle (sort-merge) join by hint, whose
skewed partitions AQE splits.

Facts that meet on a key are dealt by it over a number of partitions that follows their
rows (``deal``): sorts and aggregates after a join hold a bounded number of rows per task,
whatever ``spark.sql.shuffle.partitions`` says.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..actions import run_concurrently

_DEFAULT_BUDGET = 10 * 1024 * 1024

TASK_ROWS = 500_000  # rows of both sides that a task of a dealt join holds
_SLOTS = 1 << 12  # hash values of the key whose rows are counted


def _budget(df: DataFrame, max_bytes: int | None) -> int:
    if max_bytes is not None:
        return max_bytes
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", str(_DEFAULT_BUDGET))
    raw = raw.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
             "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix) and raw[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(raw[: -len(suffix)]) * units[suffix]
    return int(raw)


def _row_bytes_sql(df: DataFrame) -> str:
    """SQL for the in-memory bytes of one row: an 8-byte slot per field and a
    null-bitset word, plus the payload of variable-length fields."""
    fixed = 8 + 8 * len(df.schema.fields)
    var = [f"coalesce(octet_length(`{f.name}`), 0)" for f in df.schema.fields
           if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return " + ".join([str(fixed), *var])


def broadcast_size_ok(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when ``df`` is proven to fit the broadcast byte budget: one
    distributed aggregate of its in-memory row bytes; no row reaches the driver."""
    budget = _budget(df, max_bytes)
    if budget <= 0:
        return False
    size = df.selectExpr(f"sum(CAST({_row_bytes_sql(df)} AS BIGINT)) AS b").first()["b"] or 0
    return size <= budget


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` if its size is proven under budget; else ``df`` with a
    merge-join hint, since the planner might still broadcast it by the (smaller,
    compressed) size of its files."""
    return F.broadcast(df) if broadcast_size_ok(df, max_bytes) else df.hint("shuffle_merge")


def bounded_broadcast_all(frames: dict[str, DataFrame],
                          max_bytes: int | None = None) -> dict[str, DataFrame]:
    """``bounded_broadcast`` for several frames, their probes run side by side."""
    return run_concurrently({name: (lambda df=df: bounded_broadcast(df, max_bytes))
                             for name, df in frames.items()})


def enrich(left: DataFrame, right: DataFrame, key: str | list[str],
           broadcast: str = "checked", max_bytes: int | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (key)``: every left row is kept.

    ``broadcast``: ``"checked"`` hints the right side after a size proof,
    ``"auto"`` leaves the choice to Catalyst and AQE, ``"never"`` forbids it.
    """
    if broadcast == "checked":
        right = bounded_broadcast(right, max_bytes)
    elif broadcast == "never":
        right = right.hint("shuffle_merge")
    elif broadcast != "auto":
        raise ValueError(f"unknown broadcast mode {broadcast!r}")
    return left.join(right, on=key, how="left")


def deal_over(left: DataFrame, right: DataFrame, key: str) -> tuple[int, bool]:
    """Partitions for ``left JOIN right USING (key)`` with TASK_ROWS rows each, and whether
    more rows of the left side than that share a hash of the key.  0 partitions: all rows
    fit one task, and the planner may deal them as it likes.  At most ``_SLOTS`` counts
    are gathered, by an aggregate of the keys alone."""
    def rows_of(df):
        slots = df.groupBy(F.pmod(F.hash(key), F.lit(_SLOTS)).alias("slot")).count()
        found = slots.agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
        return found.rows or 0, found.most or 0

    held = run_concurrently({"left": lambda: rows_of(left), "right": lambda: rows_of(right)})
    (rows, most), (others, _) = held["left"], held["right"]
    return tasks_for(left, rows + others), most > TASK_ROWS + rows // _SLOTS


def tasks_for(df: DataFrame, rows: int) -> int:
    """Partitions of TASK_ROWS rows each; 0 if one task holds all rows."""
    if rows <= TASK_ROWS:
        return 0
    spark = df.sparkSession
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(math.ceil(rows / TASK_ROWS), least)


def enrich_dealt(left: DataFrame, right: DataFrame, key: str, facts: DataFrame, by: list[str], n: int) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` over ``n`` partitions, without a broadcast.

    The rows of a key that more than TASK_ROWS of the ``facts`` (which ``left`` counts) share,
    or that have none, are spread by the columns ``by`` and meet a copy of their right rows
    in each place."""
    many = facts.groupBy(key).count().where(F.col("count") > TASK_ROWS).collect()  # at most a key per TASK_ROWS rows
    copies = math.ceil(max([r["count"] for r in many], default=1) / TASK_ROWS)
    hot = [r[key] for r in many if r[key] is not None]
    zero, spread = F.lit(0).cast("bigint"), F.pmod(F.xxhash64(*by), F.lit(copies).cast("bigint"))
    left = left.withColumn("_place", F.when(F.col(key).isNull() | F.col(key).isin(hot), spread).otherwise(zero))
    last = F.when(F.col(key).isin(hot), F.lit(copies - 1).cast("bigint")).otherwise(zero)
    right = right.withColumn("_place", F.explode(F.sequence(zero, last)))
    on = [key, "_place"]
    return left.repartition(n, *on).join(right.repartition(n, *on).hint("shuffle_merge"), on, "left").drop("_place")
