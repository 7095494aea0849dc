"""Connected components as Spark jobs: alternating large-star and small-star.

Every round rewrites the edge table with joins and grouped minima only, so no
vertex's neighbours are ever gathered: a hub's edges meet one row (its minimum)
in a join that adaptive execution can split.  Each round is written to the
shared checkpoint folder; the loop ends when the edge set stays the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its
    smallest node.

    Defined results: edges with a null end count for nothing; loops and
    repeated edges are allowed; no edge gives no row.  A node that only has a
    loop is its own component.
    """
    x, y = F.col(a), F.col(b)
    given = edges.where(x.isNotNull() & y.isNotNull())
    # child > parent
    links = given.where(x != y).select(F.greatest(x, y).alias("c"), F.least(x, y).alias("p")).distinct()
    links = written(links, "edges")
    before = _state(links)
    while before[0]:
        links = written(_small_star(_large_star(links)), "edges")
        after = _state(links)
        if after == before:
            break
        before = after
    own = given.select(x.alias("c")).union(given.select(y.alias("c"))).distinct()
    return own.join(links, "c", "left").select(
        F.col("c").alias("node"), F.coalesce("p", "c").alias("component"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest neighbour (or itself)."""
    low = links.groupBy(F.col("c").alias("u")).agg(F.min("p").alias("m"))
    # a node that is nobody's child is its own minimum: its children stay as they are
    moved = links.join(low, links.p == low.u, "left").select("c", F.coalesce("m", "p").alias("p"))
    return moved.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, move to its smallest neighbour."""
    low = links.groupBy(F.col("c").alias("u")).agg(F.min("p").alias("m"))
    side = (links.join(low, links.c == low.u).where(F.col("p") != F.col("m"))
            .select(F.col("p").alias("c"), F.col("m").alias("p")))
    return side.union(low.select("u", "m")).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("c", "p").cast("decimal(38,0)"))).first()
    return row[0], row[1]
