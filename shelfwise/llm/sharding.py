"""Sharding through fixed virtual slots.

Every row is hashed into one of ``SLOTS`` virtual slots, a number that never
changes.  Rows and bytes are aggregated per slot, and a versioned map says
which shard holds which slot.  Shards are filled largest slot first, always
into the lightest one, so that their bytes come out nearly equal; when a shard
is added, an edited copy of the map becomes the next version and moves no more
slots than the new shard takes.  Versions are stored in a table, and rows are
placed from the stored map.

Rows that are equal in key and text are counted first; the next copy of a row
goes to the next slot, round and round, so that one row that is there very
often fills all slots alike.  A row there once keeps the slot of its hash.

The map has ``SLOTS`` rows at any corpus size, so the driver may edit it and
tasks may get it whole.  A row's place in its shard is the number of rows in
earlier slots of the shard plus its rank in its own slot: no window ever spans
more than a slot.

Defined results: a null text has no bytes; null keys are hashed like any
value; repeated rows get slots and places of their own; an empty table gives
no row and a map without slots.  Extra columns are not read.
"""

from __future__ import annotations

import bisect
import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import scratch_uri
from .common import written

SLOTS = 8_192
SHARDS = 40
OVERHEAD = 16  # bytes that every row takes besides its text
MAP = "version int, virtual_slot int, rows long, bytes long, shard int"


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Key, size and crc32 of the text, virtual slot, and how many equal rows the
    slot holds (``copies``); the one pass over the texts."""
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), crc.alias("text_crc32"))
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long")
    equal = rows.groupBy("key", size.alias("size"), "text_crc32").agg(F.count("*").alias("n"))
    turns = F.sequence(F.lit(0).cast("long"), F.least("n", F.lit(slots)) - 1)
    spread = equal.withColumn("turn", F.explode(turns))  # a row per slot at most
    first = F.xxhash64("key", "text_crc32")
    return spread.select(
        "key", "size", "text_crc32",
        F.pmod(F.pmod(first, F.lit(slots)) + F.col("turn"), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.expr(f"(n - 1 - turn) div {slots} + 1").alias("copies"))


def slot_loads(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, rows, bytes) of the slots in use: ``SLOTS`` rows at most."""
    loads = rows.groupBy("virtual_slot").agg(F.sum("copies"), F.sum(F.col("copies") * F.col("size")))
    return sorted((r[0], r[1], r[2]) for r in loads.collect())


def first_map(loads: list[tuple[int, int, int]], shards: int = SHARDS) -> list[tuple]:
    """Version 1: the largest slot first, into the lightest shard."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for slot, n, size in sorted(loads, key=lambda x: (-x[2], x[0])):
        held, s = heapq.heappop(heap)
        heapq.heappush(heap, (held + size, s))
        out.append((1, slot, n, size, s))
    return sorted(out)


def grown_map(current: list[tuple], shards: int) -> list[tuple]:
    """The next version, with ``shards`` shards: the new ones take slots from the
    heaviest shard, at most a small slot below the mean; nothing else moves."""
    version = max((r[0] for r in current), default=0) + 1
    place = {r[1]: r[4] for r in current}
    load = {r[1]: r[3] for r in current}
    held = dict.fromkeys(range(shards), 0)
    members: dict[int, list[int]] = {s: [] for s in range(shards)}
    for slot, s in place.items():
        held[s] += load[slot]
        members[s].append(slot)
    for s in members:
        members[s].sort(key=lambda x: (load[x], x))
    old = {r[4] for r in current}
    mean = sum(load.values()) / max(1, shards)
    for new in (s for s in range(shards) if s not in old):
        donors = {s for s in old if members[s]}
        while held[new] < mean and donors:
            heaviest = max(donors, key=lambda s: (held[s], -s))
            # the largest slot that leaves neither side beyond the mean, or else the smallest
            room = min(mean - held[new], held[heaviest] - mean)
            at = max(0, bisect.bisect_right(members[heaviest], room, key=load.__getitem__) - 1)
            if not members[heaviest] or held[new] + load[members[heaviest][at]] > mean:
                donors.remove(heaviest)
                continue
            slot = members[heaviest].pop(at)
            held[heaviest] -= load[slot]
            held[new] += load[slot]
            place[slot] = new
    return sorted((version, r[1], r[2], r[3], place[r[1]]) for r in current)


def save_map(spark: SparkSession, rows: list[tuple], uri: str, version: int = 1) -> None:
    """Store a version of the map in the table at ``uri``; a version is written once."""
    own = spark.createDataFrame(rows, MAP).drop("version")
    own.coalesce(1).write.mode("errorifexists").parquet(f"{uri}/version={version}")


def read_map(spark: SparkSession, uri: str, version: int | None = None) -> list[tuple]:
    """A version of the map, the latest by default."""
    if version is None:
        version = spark.read.schema(MAP).parquet(uri).agg(F.max("version")).first()[0]
    rows = spark.read.schema(MAP).parquet(f"{uri}/version={version}").drop("version")
    return sorted((version, *r) for r in rows.select("virtual_slot", "rows", "bytes", "shard").collect())


def _starts(spark: SparkSession, slot_map: list[tuple]) -> DataFrame:
    """Per slot its shard and the rows in earlier slots of the shard."""
    before, starts = {}, []
    for _, slot, n, _, s in slot_map:
        starts.append((slot, s, before.get(s, 0)))
        before[s] = before.get(s, 0) + n
    return spark.createDataFrame(starts, "virtual_slot int, shard int, start long")


def place(rows: DataFrame, slot_map: list[tuple], grown: list[tuple] | None = None) -> DataFrame:
    """``rows`` of ``digests``, each copy a row, plus shard and gapless slot in the
    shard; with the next version ``grown`` also the shard there, ``next_shard``."""
    spark = rows.sparkSession
    starts = _starts(spark, slot_map)
    if grown is not None:
        later = _starts(spark, grown).select("virtual_slot", F.col("shard").alias("next_shard"))
        starts = starts.join(F.broadcast(later), "virtual_slot")
    own = Window.partitionBy("virtual_slot").orderBy("key", "text_crc32", "size")
    upto = rows.withColumn("upto", F.sum("copies").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    placed = upto.join(F.broadcast(starts), "virtual_slot")  # SLOTS rows at most
    slots = F.sequence(F.col("start") + F.col("upto") - F.col("copies"), F.col("start") + F.col("upto") - 1)
    return placed.withColumn("slot", F.explode(slots)).drop("start", "upto", "copies")


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
          slots: int = SLOTS, uri: str | None = None) -> tuple[DataFrame, str]:
    """The placed rows and the table of map versions (a new one in the shared
    scratch folder, or ``uri``): version 1 for ``shards`` shards, by which rows are
    placed, and version 2 edited for one shard more (``next_shard``)."""
    spark = docs.sparkSession
    uri = uri or scratch_uri(spark, "llm/sharding-map")
    rows = written(digests(docs, key, text, slots), "sharding")
    save_map(spark, first_map(slot_loads(rows), shards), uri)
    save_map(spark, grown_map(read_map(spark, uri, 1), shards + 1), uri, 2)
    return place(rows, read_map(spark, uri, 1), read_map(spark, uri, 2)), uri
