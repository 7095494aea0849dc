"""Exact top-k inner products over integer vectors through vector-approximation files.

Components become floor(64 * x).  Vectors are dealt by hash into shards of
bounded size; each shard is written once as a packed record: the exact vectors
and, per component, a one-byte cell out of ``CELLS`` with its lowest and
highest value.  A search task takes one shard and one block of queries:

1.  scan the cells only: lowest and highest inner product that each vector can
    have, and the kth highest of the lowest;
2.  read exact vectors in the order of their highest possible score, in growing
    steps, until the kth exact score is above all that is left.

Nothing is pruned that could be among the best, so results are exact, ties
included.  Each task returns k rows per query at most; a window merges them.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do null ids; zero vectors do; missing trailing components
count as zero; rows equal in id and vector count once; candidates with the
query's own id are left out; scores beyond 64 bits are cut to the range of a
long; fewer candidates than k give fewer rows; an empty table gives no row.
Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import QUERY_ROWS, SHARD_ROWS, best, finite, matrix, merged

SCALE = 64
CELLS = 64
STEP = 128
_LONG = (-(1 << 63), (1 << 63) - 1)


def _integers(values: np.ndarray) -> np.ndarray:
    """floor(64 * x): as doubles where those are exact, else as Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    if np.isfinite(scaled).all():
        return scaled
    return np.array([[math.floor(Fraction(x) * SCALE) for x in row] for row in values.tolist()], object)


def _cells(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each component, and per component the lowest and highest value in each cell."""
    n, width = v.shape
    cell = np.zeros((n, width), np.uint8)
    low, high = np.zeros((width, CELLS)), np.zeros((width, CELLS))
    for d in range(width):
        x = v[:, d]
        marks = np.unique(np.quantile(x, np.linspace(0, 1, CELLS + 1)[1:-1], method="higher"))
        if len(marks) and marks[0] > x.min():
            at = np.searchsorted(marks, x, side="right")
        else:
            at = np.searchsorted(marks[1:], x, side="right")
        cell[:, d] = at
        order = np.argsort(at, kind="stable")
        starts = np.flatnonzero(np.diff(at[order], prepend=-1))
        low[d, at[order][starts]] = np.minimum.reduceat(x[order], starts)
        high[d, at[order][starts]] = np.maximum.reduceat(x[order], starts)
    return cell, low, high


PACKED = "shard int, n int, width int, ids binary, vecs binary, cells binary, low binary, high binary"


def _pack(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    raw = np.zeros((len(pdf), width))
    for i, v in enumerate(pdf["vec"]):
        raw[i, :len(v)] = v
    with np.errstate(over="ignore"):
        cell, low, high = _cells(np.clip(np.floor(raw * SCALE), -1e300, 1e300))
    return pd.DataFrame([{"shard": int(pdf["shard"].iloc[0]), "n": len(pdf), "width": width,
                          "ids": pdf["id"].to_numpy(np.int64).tobytes(), "vecs": raw.tobytes(),
                          "cells": cell.tobytes(), "low": low.tobytes(), "high": high.tobytes()}])


def _search(record: dict, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, list]]:
    """(query id, ids, scores) of the best k in the shard for each query."""
    n, width = record["n"], record["width"]
    ids = np.frombuffer(record["ids"], np.int64)
    v = _integers(np.frombuffer(record["vecs"], np.float64).reshape(n, width))
    q = _integers(queries)
    if v.dtype == object or q.dtype == object or \
            float(np.abs(v).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, width) >= 2.0 ** 53:
        yield from _search_large(ids, v, query_ids, q, k)
        return
    cell = np.frombuffer(record["cells"], np.uint8).reshape(n, width)
    low = np.frombuffer(record["low"], np.float64).reshape(width, CELLS)
    high = np.frombuffer(record["high"], np.float64).reshape(width, CELLS)
    every = np.arange(width)
    low, high = low[every, cell], high[every, cell]  # the bounds of each component
    for at in range(0, len(q), 64):
        part = q[at:at + 64]
        plus, minus = np.maximum(part, 0), np.minimum(part, 0)
        most = plus @ high.T + minus @ low.T
        least = plus @ low.T + minus @ high.T
        own = query_ids[at:at + 64, None] == ids[None, :]
        most[own], least[own] = -np.inf, -np.inf
        kth = np.partition(least, n - k, axis=1)[:, n - k] if n > k else np.full(len(part), -np.inf)
        for i in range(len(part)):
            some = np.flatnonzero((most[i] >= kth[i]) & ~own[i])
            some = some[np.argsort(-most[i, some], kind="stable")]
            found, scores, step, done = some[:0], np.zeros(0), STEP, 0
            while done < len(some):
                if len(found) >= k and most[i, some[done]] < scores[k - 1]:
                    break  # the kth result is certain
                new = some[done:done + step]
                scores = np.concatenate([scores, v[new] @ part[i]])
                found = np.concatenate([found, new])
                top = best(ids[found], scores, k)
                found, scores = found[top], scores[top]
                done, step = done + step, step * 2
            yield int(query_ids[at + i]), ids[found], [int(s) for s in scores]


def _search_large(ids, v, query_ids, q, k):
    """Numbers that doubles can't hold: every vector, in Python integers."""
    rows = [[int(x) for x in row] for row in v.tolist()]
    for qid, part in zip(query_ids.tolist(), q.tolist(), strict=True):
        part = [int(x) for x in part]
        scored = [(-sum(a * b for a, b in zip(part, row, strict=True)), i)
                  for i, row in zip(ids.tolist(), rows, strict=True) if i != qid]
        top = sorted(scored)[:k]
        yield qid, np.array([i for _, i in top], np.int64), [min(max(-s, _LONG[0]), _LONG[1]) for s, _ in top]


def search(vectors: DataFrame, is_query, k: int, key: str = "vec_id", vector: str = "embedding",
           shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best for each row with ``is_query(id column)``."""
    rows = written(finite(vectors, key, vector, zero=True).distinct(), "vafile-vectors")
    n, width = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    shards, width = max(1, math.ceil(n / shard_rows)), max(1, width or 1)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "vec"), F.lit(shards)).cast("int"))
    packed = written(dealt.groupBy("shard").applyInPandas(lambda pdf: _pack(pdf, width), PACKED), "vafile-shards")
    queries = rows.where(is_query(F.col("id")))
    blocks = max(1, math.ceil(queries.count() / query_rows))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", "vec", F.lit(1)), F.lit(blocks)).cast("int"))
    asked = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    scanned = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def task(shard: pa.Table, block: pa.Table) -> pa.Table:
        out = [], [], []
        if block.num_rows:
            q = matrix(block.column("vec"), width)
            for record in shard.to_pylist():
                for qid, ids, scores in _search(record, np.asarray(block.column("id")), q, k):
                    out[0].extend([qid] * len(ids))
                    out[1].extend(ids.tolist())
                    out[2].extend(scores)
        return pa.table([pa.array(x, pa.int64()) for x in out], ["query_id", "vec_id", "score"])

    partial = (scanned.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
               .applyInArrow(task, "query_id long, vec_id long, score long"))
    return merged(partial, k)
