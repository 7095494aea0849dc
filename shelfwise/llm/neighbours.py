"""Approximate nearest neighbours by inner product: stable projections, kd-tree,
chi-square stopping test.

Reduction: with M the largest norm, x becomes (x, sqrt(M^2 - |x|^2)) / M and a
query (q / |q|, 0).  All have length one, and nearer means a larger inner
product.  A Gaussian (2-stable) projection to ``DIMS`` dimensions keeps, for two
points at distance r, projected distance^2 / r^2 distributed as chi-square with
``DIMS`` degrees of freedom.

Index: a kd-tree over the projected points.  Its upper splits come from a
bounded sample (``SAMPLE_ROWS``) and deal *every* vector into shards; a shard
that gets too many (equal vectors, say) is dealt on by hash.  In each shard the
tree goes on down to cells of ``CELL_ROWS``.

Search: cells are taken in the order of their projected distance, in growing
steps, and their vectors verified with exact inner products.  With d the
distance of the kth best so far, a query stops at the first projected distance
D with chi2cdf(D^2 / d^2) >= ``CERTAINTY``: a nearer vector would lie beyond D
with a probability of at most 1 - CERTAINTY.  First each query searches its
home shard; the kth score found there and the shards' boxes then tell which
other shards the test still lets in, and only those are searched.  Queries of
neighbouring leaves form a block, and a shard travels to the blocks only that
need it: once in the first pass, wherever the queries are.

Scores are exact inner products of the given vectors in double precision.

Defined results: vectors that are null, zero or hold a null or non-finite
component take no part, nor do null ids; missing trailing components count as
zero; rows equal in id and vector count once; candidates with the query's own
id are left out; ties go to the smaller id; an empty table gives no row.
Extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import QUERY_ROWS, SHARD_ROWS, finite, matrix, merged

DIMS = 8
SAMPLE_ROWS = 20_000
CELL_ROWS = 256
CERTAINTY = 0.97
ROUTED_AT_ONCE = 1 << 21  # pairs of query and box that a task looks at together
SEED = 7


def chi2_quantile(p: float, dims: int = DIMS) -> float:
    """The x with chi2cdf(x) = p, for an even number of degrees of freedom."""
    def cdf(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))

    lo, hi = 0.0, 200.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


@dataclass
class Projection:
    """The reduction to unit vectors and the projection of those."""

    width: int
    longest: float  # M

    def matrix(self) -> np.ndarray:
        return np.random.default_rng(SEED).standard_normal((self.width + 1, DIMS))

    def points(self, v: np.ndarray) -> np.ndarray:
        v = v / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", v, v)))
        return np.hstack([v, rest[:, None]]) @ self.matrix()

    def queries(self, q: np.ndarray) -> np.ndarray:
        return (q / _norms(q)[:, None]) @ self.matrix()[:-1]


def _norms(v: np.ndarray) -> np.ndarray:
    scale = np.maximum(np.abs(v).max(axis=1, initial=0), 1e-300)
    w = v / scale[:, None]
    return scale * np.sqrt(np.einsum("ij,ij->i", w, w))


def _query_blocks(counts: dict[int, int], query_rows: int) -> list[tuple[int, int, int]]:
    """(home leaf, first block, blocks): leaves next to each other in the tree share a
    block as long as it holds ``query_rows`` queries; a leaf with more gets several."""
    out, block, held = [], -1, query_rows
    for leaf in sorted(counts):
        n = counts[leaf]
        if held + n > query_rows:
            block, held = block + 1, 0
        parts = max(1, math.ceil(n / query_rows))
        out.append((leaf, block, parts))
        block, held = block + parts - 1, query_rows if parts > 1 else held + n
    return out


class Splits:
    """The upper part of the kd-tree: a complete binary tree of (dimension, value)."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.dim = np.zeros((1 << depth) - 1, np.int64)
        self.value = np.zeros((1 << depth) - 1)
        parts = [sample]
        for level in range(depth):
            below = []
            for i, p in enumerate(parts):
                node = (1 << level) - 1 + i
                if len(p):
                    spread = p.max(axis=0) - p.min(axis=0)
                    self.dim[node] = spread.argmax()
                    self.value[node] = np.median(p[:, self.dim[node]])
                right = p[:, self.dim[node]] >= self.value[node]
                below += [p[~right], p[right]]
            parts = below

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node, row = np.zeros(len(points), np.int64), np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[row, self.dim[node]] >= self.value[node])
        return node - ((1 << self.depth) - 1)


def _kd_cells(points: np.ndarray) -> list[np.ndarray]:
    """Row numbers of the cells of a kd-tree over a shard, halved at medians."""
    todo, cells = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= CELL_ROWS:
            cells.append(rows)
            continue
        p = points[rows]
        d = (p.max(axis=0) - p.min(axis=0)).argmax()
        order = np.argpartition(p[:, d], len(rows) // 2)
        todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return cells


def _box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances [point, box]."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d:d + 1]
        gap = np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0)
        out += gap * gap
    return out


def _search_shard(ids, v, query_ids, q, bound, projection: Projection, k: int, certainty: float):
    """(query number, vector number, score): the best k at most of each query above its bound."""
    points, at = projection.points(v), projection.queries(q)
    cells = _kd_cells(points)
    low, high = np.array([points[c].min(axis=0) for c in cells]), np.array([points[c].max(axis=0) for c in cells])
    gaps = _box_distance(at, low, high)
    order, limit = np.argsort(gaps, axis=1), chi2_quantile(certainty)
    place = np.argsort(order, axis=1)  # a cell's turn for each query
    scale = _norms(q) * projection.longest
    pool_q, pool_v, pool_s = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    bound = bound.copy()
    first, step = 0, 1
    while first < len(cells):
        turn = (place >= first) & (place < first + step)
        # the test: how far a projected neighbour may be, given the kth best so far
        reach = np.where(np.isfinite(bound), limit * np.maximum(0.0, 2 - 2 * bound / scale) + 1e-12, np.inf)
        turn &= gaps <= reach[:, None]
        if first and not (gaps <= reach[:, None])[place >= first].any():
            break
        found = [(pool_q, pool_v, pool_s)]
        for c in np.flatnonzero(turn.any(axis=0)):
            who, rows = np.flatnonzero(turn[:, c]), cells[c]
            rough = q[who] @ v[rows].T
            slack = 1e-9 * scale[who]
            i, j = np.nonzero(rough >= (np.where(np.isfinite(bound[who]), bound[who], -np.inf) - slack)[:, None])
            i, j = who[i], rows[j]
            other = query_ids[i] != ids[j]
            i, j = i[other], j[other]
            for lo in range(0, len(i), 1 << 15):  # the same sum for equal vectors, whatever their place
                a, b = i[lo:lo + (1 << 15)], j[lo:lo + (1 << 15)]
                found.append((a, b, (q[a] * v[b]).sum(axis=1)))
        pool_q, pool_v, pool_s = (np.concatenate(x) for x in zip(*found, strict=True))
        best = np.lexsort((ids[pool_v], -pool_s, pool_q))
        pool_q, pool_v, pool_s = pool_q[best], pool_v[best], pool_s[best]
        starts = np.searchsorted(pool_q, np.arange(len(q)))
        rank = np.arange(len(pool_q)) - starts[pool_q]
        kth = rank == k - 1
        bound[pool_q[kth]] = np.maximum(bound[pool_q[kth]], pool_s[kth])
        keep = rank < k
        pool_q, pool_v, pool_s = pool_q[keep], pool_v[keep], pool_s[keep]
        first, step = first + step, step * 2
    return pool_q, pool_v, pool_s


def search(vectors: DataFrame, is_query, k: int, key: str = "vec_id", vector: str = "embedding",
           certainty: float = CERTAINTY, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best found for each row with
    ``is_query(id column)``, nearest first."""
    spark = vectors.sparkSession
    rows = written(finite(vectors, key, vector, zero=False).distinct(), "neighbours-vectors")
    # through a norm that does not overflow
    big = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    norm = big * F.sqrt(F.aggregate(F.transform("vec", lambda x: x / big), F.lit(0.0), lambda s, x: s + x * x))
    n, width, longest = rows.agg(F.count("*"), F.max(F.size("vec")), F.max(norm)).first()
    width = max(1, width or 1)
    projection = Projection(width, longest or 1.0)
    depth = max(0, math.ceil(math.log2(max(1, n) / shard_rows)))
    rate = min(1.0, SAMPLE_ROWS / max(1, n))
    sample = rows.where(F.shiftrightunsigned(F.xxhash64("id", "vec", F.lit(3)), 2) <= int(rate * (1 << 62))) \
        if rate < 1 else rows
    splits = Splits(projection.points(matrix(sample.select("vec").toArrow().column("vec"), width)), depth)

    def assign(batches):
        for b in batches:
            v = matrix(b.column("vec"), width)
            p = projection.points(v)
            home = splits.leaf(projection.queries(v)) if len(v) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("vec"), pa.array(splits.leaf(p).astype(np.int32)),
                 pa.array(home.astype(np.int32)), pa.array(list(p), pa.list_(pa.float64()))],
                ["id", "vec", "leaf", "home", "point"])

    dealt = written(rows.mapInArrow(assign, "id long, vec array<double>, leaf int, home int, point array<double>"),
                    "neighbours-leaves")
    sides = [F.min(F.col("point")[d]).alias(f"low{d}") for d in range(DIMS)] + \
            [F.max(F.col("point")[d]).alias(f"high{d}") for d in range(DIMS)]
    leaves = sorted(dealt.groupBy("leaf").agg(F.count("*").alias("n"), *sides).collect())  # n / shard_rows rows
    parts = {r["leaf"]: max(1, math.ceil(r["n"] / (2 * shard_rows))) for r in leaves}
    shards = [(leaf, part) for leaf in parts for part in range(parts[leaf])]
    number = {s: i for i, s in enumerate(shards)}
    info = spark.createDataFrame([(leaf, parts[leaf], number[leaf, 0]) for leaf in parts],
                                 "leaf int, parts int, first int")
    boxes = {r["leaf"]: (r[2:2 + DIMS], r[2 + DIMS:]) for r in leaves}
    low = np.array([boxes[leaf][0] for leaf, _ in shards]).reshape(-1, DIMS)
    high = np.array([boxes[leaf][1] for leaf, _ in shards]).reshape(-1, DIMS)
    home_of = {leaf: number[leaf, 0] for leaf in parts}
    stored = (dealt.join(F.broadcast(info), "leaf")
              .select("id", "vec", (F.col("first") + F.pmod(F.xxhash64("id", "vec"), F.col("parts"))).cast("int").alias("shard")))
    stored = written(stored, "neighbours-shards")
    queries = dealt.where(is_query(F.col("id"))).select("id", "vec", "home")
    held = {r["home"]: r["n"] for r in queries.groupBy("home").agg(F.count("*").alias("n")).collect()}  # a row per leaf
    blocks = spark.createDataFrame(_query_blocks(held, query_rows), "home int, start int, blocks int")
    part = F.pmod(F.xxhash64("id", "vec", F.lit(1)), F.col("blocks")).cast("int")
    queries = (queries.join(F.broadcast(blocks), "home").withColumn("block", F.col("start") + part)
               .drop("start", "blocks"))

    def task(shard: pa.Table, block: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not shard.num_rows or not block.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        ids, qids = np.asarray(shard.column("id")), np.asarray(block.column("id"))
        v, q = matrix(shard.column("vec"), width), matrix(block.column("vec"), width)
        out = [[], [], []]
        for at in range(0, len(q), 512):
            to = slice(at, at + 512)
            i, j, s = _search_shard(ids, v, qids[to], q[to], np.asarray(block.column("bound"))[to], projection, k,
                                    certainty)
            out[0].append(qids[to][i])
            out[1].append(ids[j])
            out[2].append(s)
        return pa.table([np.concatenate(x) for x in out], names)

    def searched(asked: DataFrame) -> DataFrame:
        pairs = asked.groupBy("shard").agg(F.collect_set("block").alias("blocks"))
        pairs = written(pairs, "neighbours-pairs")  # a row per shard
        spread = stored.join(pairs, "shard").select("id", "vec", "shard", F.explode("blocks").alias("block"))
        return (spread.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
                .applyInArrow(task, "query_id long, vec_id long, score double"))

    def route(batches):
        """The shards besides the first that the test lets in, given the bound."""
        limit = chi2_quantile(certainty)
        rows_at_once = max(1, ROUTED_AT_ONCE // len(low))
        for b in batches:
            for at in range(0, b.num_rows, rows_at_once):
                some = b.slice(at, rows_at_once)
                q, bound = matrix(some.column("vec"), width), np.asarray(some.column("bound"))
                scale = np.maximum(_norms(q) * projection.longest, 1e-300)
                reach = np.where(np.isfinite(bound), limit * np.maximum(0.0, 2 - 2 * bound / scale) + 1e-12, np.inf)
                go = _box_distance(projection.queries(q), low, high) <= reach[:, None]
                go[np.arange(len(q)), np.asarray(some.column("shard"))] = False
                who, to = np.nonzero(go)
                ends = np.searchsorted(who, np.arange(len(q) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c) for c in ("id", "vec", "block", "bound")),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(to.astype(np.int32)))],
                    ["id", "vec", "block", "bound", "shards"])

    if not shards:
        return merged(spark.createDataFrame([], "query_id long, vec_id long, score double"), k)
    # a query's home may have got no vector: then the first shard stands in
    home = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in home_of.items() for x in kv]), F.col("home")),
                      F.lit(0)).cast("int") if len(home_of) <= 64 else None
    if home is None:
        starts = spark.createDataFrame(list(home_of.items()), "home int, shard int")
        queries = queries.join(F.broadcast(starts), "home", "left").withColumn("shard", F.coalesce("shard", F.lit(0)))
    else:
        queries = queries.withColumn("shard", home)
    near = written(searched(queries.withColumn("bound", F.lit(float("-inf")))), "neighbours-near")
    if len(shards) == 1:
        return merged(near, k)
    kth = (merged(near, k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
           .where(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("low").alias("bound")))
    asked = queries.join(kth, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    routed = written(asked.select("id", "vec", "block", "bound", "shard").mapInArrow(
        route, "id long, vec array<double>, block int, bound double, shards array<int>"), "neighbours-routed")
    routed = routed.select("id", "vec", "block", "bound", F.explode("shards").alias("shard"))
    return merged(near.union(searched(routed)), k)
