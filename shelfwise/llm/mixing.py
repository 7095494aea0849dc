"""Mixing sources to target weights with a multivariate-hypergeometric tree.

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and
share ``SHARE`` of all words; no target exceeds ``MOST`` times its source, the
excess goes to the others by weight until none is above.

Blocks: a source's documents are dealt by hash into blocks, in number
proportional to its words (``BLOCKS`` in all, one per source at least).  A
target of r times the source takes floor(r) copies of every block, then blocks
of one hashed permutation as long as they fit into what is left; in the one
block that fits in part, documents in hash order as long as half of the next
one fits.  So a source misses its target by half a document at most.

Splitting tree: the block copies are halved among the output shards again and
again; at each node the first part of a fresh hashed permutation goes left, in
exact proportion to the shards there.  The number of each source's blocks on
either side is then a multivariate-hypergeometric draw without replacement,
blocks are disjoint, and every shard gets its exact quota.  The leaves say what
the mix takes: ``allocate`` counts a row in them, ``draw`` gives it out there,
and rows are shuffled within their shard only.

All choices are functions of the row's hash, and reruns agree.  Rows equal in
key, source and text are told apart by their number among their equals, so they
are dealt like different rows; only then is anything joined by row.  Running
sums go by ranges of hashes, so no window holds a whole source.  The block table
has ``2 * BLOCKS`` rows plus two per source at most, at any corpus size.

Defined results: a null text has no words; null sources are one source; of rows
equal in key, source and text it is undefined which one is taken, not how many
are; with no words at all nothing has a target and every row is taken zero
times; an empty table gives no row.  Extra columns pass through ``draw``.
"""

from __future__ import annotations

import functools
import itertools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, word_count, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BLOCKS = 8_192
SEED = 20_240_607
_ALL = (1 << 63) - 1


def _hash(key: Column, text: Column) -> Column:
    """Not negative, the same for equal rows."""
    return F.shiftrightunsigned(F.xxhash64(key, text, F.lit(SEED)), 1)


def ranked(rows: DataFrame, order: Column, name: str) -> DataFrame:
    """``rows`` plus their global rank (from 0) in ``order``: ranges are dealt to
    tasks, and each task adds the rows in the ranges before its own."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = written(rows.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()), name)
    counts = sorted((r[0], r[1]) for r in held.groupBy("_part").count().collect())  # a number per task
    before = itertools.accumulate((n for _, n in counts), initial=0)
    starts = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before, strict=False)],
                                               "_part int, _before long")
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return (held.withColumn("_rank", rank).join(F.broadcast(starts), "_part")
            .withColumn("rank", F.col("_rank") + F.col("_before")).drop("_part", "_rank", "_before"))


def source_targets(rows: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``rows(source, size)`` to one row per source: source_size, target, n_blocks."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.col("source").asc_nulls_last()
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    sources = written(ranked(sums, order, "mixing-order").withColumn("weight", weight).drop("rank"), "mixing-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while total:  # the level rises until no further source meets its limit
        full = F.col("weight") * level > F.col("source_size") * MOST if capped >= 0 else F.lit(False)
        n, held, free = sources.agg(
            F.sum(full.cast("long")), F.sum(F.when(full, F.col("source_size") * MOST).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n == capped or not free:
            break
        level, capped = (SHARE * total - held) / free, n
    target = F.least(F.col("weight") * level, F.col("source_size") * MOST)
    share = F.ceil(F.col("source_size") * float(blocks) / float(max(1, total)))
    return sources.select("source", "source_size", target.alias("target"),
                          F.greatest(share, F.lit(1)).cast("long").alias("n_blocks"))


def digests(docs: DataFrame, key: str, source: str, text: str, row: Column | None = None) -> DataFrame:
    """(key, source, size, h, row), written; ``row`` numbers the rows."""
    return written(docs.select(F.col(key).alias("key"), F.col(source).alias("source"),
                               word_count(F.col(text)).alias("size"), _hash(F.col(key), F.col(text)).alias("h"),
                               (F.monotonically_increasing_id() if row is None else row).alias("row")), "mixing-rows")


def repeats(rows: DataFrame) -> DataFrame | None:
    """(row, h): a hash of its own for each of the written ``rows`` that has an equal
    before it; None if there is none.  Equal rows are numbered within the tasks that
    wrote them, after the equal rows of the tasks before."""
    rows = rows.select("row", "h", F.xxhash64("h", "source").alias("same"))
    often = written(rows.groupBy("same").agg(F.count("*").alias("n")).where("n > 1").select("same"), "mixing-often")
    if often.isEmpty():
        return None
    own = rows.join(often, "same", "left_semi").withColumn("task", F.shiftright("row", 33))
    counts = own.groupBy("same", "task").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("same").orderBy("task"))  # a row per task
    starts = counts.select("same", "task", (upto - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("same", "task").orderBy("row")) - 1
    told = own.withColumn("rank", rank).join(starts, ["same", "task"])
    number = (F.col("before") + F.col("rank")).alias("number")
    return written(told.select("row", "h", number).where("number > 0")
                   .select("row", F.shiftrightunsigned(F.xxhash64("h", "number"), 1).alias("h")), "mixing-apart")


def told_apart(rows: DataFrame, again: DataFrame | None) -> DataFrame:
    """``rows`` with the hashes of ``repeats`` in place of theirs."""
    if again is None:
        return rows
    again = again.select("row", F.col("h").alias("_own"))
    return written(rows.join(again, "row", "left").withColumn("h", F.coalesce("_own", "h")).drop("_own"), "mixing-told")


def _running(rows: DataFrame, by: list[str], order: str, bits: int) -> DataFrame:
    """``rows`` plus ``upto``, the running sum of ``size`` per ``by`` in the order of a
    hash: 2**bits ranges of the hash are summed first, then the rows in each."""
    ranged = rows.withColumn("_range", F.shiftright(order, 63 - bits))
    sums = ranged.groupBy(*by, "_range").agg(F.sum("size").alias("_sum"))
    upto = F.sum("_sum").over(Window.partitionBy(*by).orderBy("_range"))
    starts = sums.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_range").alias("_at"),
                         (upto - F.col("_sum")).alias("_before"))
    same = functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    own = F.sum("size").over(Window.partitionBy(*by, "_range").orderBy(order))
    return (ranged.withColumn("_own", own).join(starts, same & (F.col("_range") == F.col("_at")))
            .withColumn("upto", F.col("_own") + F.col("_before"))
            .select(*rows.columns, "upto"))


def dealt_rows(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with their source's figures and their block."""
    return (rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(rows["source"])
            .withColumn("block", F.pmod("h", "n_blocks")))


def block_copies(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Per (source, block) the copies taken: ``copies`` is an array of the highest
    hash that each copy takes."""
    dealt = dealt_rows(rows, sources)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("times") * F.col("source_size")
    turn = F.shiftrightunsigned(F.xxhash64("source", "block", F.lit(SEED)), 1)
    sizes = written(dealt.groupBy("source", "block").agg(
        F.sum("size").alias("size"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
        .withColumn("times", times).withColumn("rest", rest).withColumn("turn", turn), "mixing-sizes")
    marked = written(_running(sizes, ["source"], "turn", 6), "mixing-blocks")
    partly = marked.where("upto > rest AND upto - size < rest").select(
        F.col("source").alias("s"), F.col("block").alias("b"), (F.col("rest") - F.col("upto") + F.col("size")).alias("room"))
    # documents of the one block per source that fits in part
    here = (dealt.join(partly, dealt["source"].eqNullSafe(partly["s"]) & (dealt["block"] == partly["b"]))
            .groupBy("s", "b", "room", "h").agg(F.sum("size").alias("size")))
    inside = (_running(written(here, "mixing-here"), ["s", "b"], "h", 12)
              .where("upto - size / 2 <= room").groupBy("s", "b").agg(F.max("h").alias("limit")))
    inside = written(inside, "mixing-partly")
    extra = (F.when((F.col("upto") <= F.col("rest")) & (F.col("rest") > 0), F.lit(_ALL))
             .otherwise(F.coalesce("limit", F.lit(-1))))
    copies = marked.join(inside, marked["source"].eqNullSafe(inside["s"]) & (marked["block"] == inside["b"]), "left")
    limits = F.concat(F.array_repeat(F.lit(_ALL), F.col("times").cast("int")),
                      F.when(F.col("extra") >= 0, F.array("extra")).otherwise(F.array().cast("array<bigint>")))
    return written(copies.withColumn("extra", extra).select("source", "block", limits.alias("copies")), "mixing-copies")


def plan(docs: DataFrame, key: str, source: str, text: str, blocks: int = BLOCKS):
    """The rows' digests, told apart, the sources, and the copies of their blocks."""
    rows = digests(docs, key, source, text)
    rows = told_apart(rows, repeats(rows))
    sources = written(source_targets(rows, blocks), "mixing-targets")
    return rows, sources, block_copies(rows, sources)


def leaves(copies: DataFrame, shards: int) -> DataFrame:
    """The tree's leaves per block: (_cell_source, _cell_block, cells), ``cells``
    being (copy, limit, shard) of each copy, two at most."""
    cells = written(split(copies, shards), "mixing-shards")
    per_block = cells.groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct("copy", "limit", "shard"))).alias("cells"))
    return per_block.select(F.col("source").alias("_cell_source"), F.col("block").alias("_cell_block"), "cells")


def _shards(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def allocate(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
             blocks: int = BLOCKS, shards: int | None = None) -> DataFrame:
    """Per row: key, size, source_size, target and taken (words, repeats counted):
    its words as often as leaves of the tree hold it."""
    rows, sources, copies = plan(docs, key, source, text, blocks)
    dealt = dealt_rows(rows, sources)
    own = leaves(copies, shards or _shards(docs.sparkSession))
    dealt = dealt.join(own, F.col("source").eqNullSafe(F.col("_cell_source")) & (F.col("block") == F.col("_cell_block")), "left")
    times = F.coalesce(F.size(F.filter("cells", lambda c: c["limit"] >= F.col("h"))), F.lit(0))
    return dealt.select(F.col("key").alias(key), "size", "source_size", "target",
                        (F.col("size") * times).cast("long").alias("taken"))


def split(copies: DataFrame, shards: int) -> DataFrame:
    """Block copies to output shards: (source, block, copy, limit, shard)."""
    nodes = copies.select("source", "block", F.posexplode("copies").alias("copy", "limit"),
                          F.lit(0).alias("shard"), F.lit(shards).alias("width"))
    level, widest = 0, shards
    while widest > 1:
        own = Window.partitionBy("shard", "width")
        draw = own.orderBy(F.xxhash64("source", "block", "copy", F.lit(SEED + level)), "source", "block", "copy")
        left = F.expr("width div 2").cast("int")
        goes = F.row_number().over(draw) * F.col("width") <= F.count("*").over(own) * left
        nodes = nodes.withColumn("_left", goes & (F.col("width") > 1)).withColumn("_half", left)
        nodes = nodes.select(
            "source", "block", "copy", "limit",
            F.when(F.col("_left") | (F.col("width") == 1), F.col("shard")).otherwise(F.col("shard") + F.col("_half")).alias("shard"),
            F.when(F.col("width") == 1, 1).when(F.col("_left"), F.col("_half"))
            .otherwise(F.col("width") - F.col("_half")).alias("width"))
        level, widest = level + 1, -(-widest // 2)
    return nodes.drop("width")


def draw(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", blocks: int = BLOCKS,
         shards: int | None = None) -> DataFrame:
    """The mix: the rows of ``docs``, each as often as it is taken, dealt to
    ``shards`` output shards (a column ``shard``; the session's shuffle
    partitions by default) and shuffled within them."""
    shards = shards or _shards(docs.sparkSession)
    columns, named, shard = docs.columns, free_name(docs, "_row"), free_name(docs, "shard")
    rows = digests(docs, key, source, text)
    again = repeats(rows)
    if again is not None:  # rows to tell apart are stored with their numbers
        docs = written(docs.withColumn(named, F.monotonically_increasing_id()), "mixing-numbered")
        rows = digests(docs, key, source, text, F.col(named))
        again = repeats(rows)
        rows = told_apart(rows, again)
    sources = written(source_targets(rows, blocks), "mixing-targets")
    per_block = leaves(block_copies(rows, sources), shards)
    n_of = sources.select(F.col("source").alias("_source"), F.col("n_blocks").alias("_n_blocks"))
    number = F.lit(None).cast("long") if again is None else docs[named]
    own = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"), number.alias("_row"),
                      docs[source].alias("_own"), _hash(docs[key], docs[text]).alias("_h"))
    if again is not None:
        told = again.select(F.col("row").alias("_again"), F.col("h").alias("_told"))
        own = own.join(told, F.col("_row") == F.col("_again"), "left").withColumn("_h", F.coalesce("_told", "_h"))
    dealt = own.join(n_of, F.col("_own").eqNullSafe(F.col("_source")))
    block = F.pmod("_h", "_n_blocks")
    dealt = dealt.join(per_block, F.col("_own").eqNullSafe(F.col("_cell_source")) & (block == F.col("_cell_block")))
    cell = F.explode(F.filter("cells", lambda c: c["limit"] >= F.col("_h")))
    mixed = dealt.select("row", "_h", cell.alias("_cell"))
    mixed = mixed.withColumn("_turn", F.xxhash64("_h", "_cell.copy", F.lit(SEED)))
    mixed = mixed.withColumn("_shard", F.col("_cell.shard"))
    return (mixed.repartition(shards, "_shard").sortWithinPartitions("_shard", "_turn")
            .select("row.*", F.col("_shard").alias(shard)))
