"""What the two vector searches share: clean vectors, tasks of bounded size that
pair query blocks with shards of vectors, and the merge of partial results.

A shard holds about ``SHARD_ROWS`` vectors and a query block about
``QUERY_ROWS`` queries, whatever the table holds; each (shard, block) pair is a
task group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 16_384
QUERY_ROWS = 4_096


def finite(vectors: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """(id, vec as array<double>) of the rows that take part: key and vector not
    null, no null or non-finite component, and (unless ``zero``) not all zero."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(~bad)
    return rows if zero else rows.where(F.exists("vec", lambda x: x != 0.0))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A column of lists as rows of ``width`` numbers, short ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if len(size) and (size == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(size), width))
    out[np.arange(width)[None, :] < size[:, None]] = flat
    return out


def series_matrix(values: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def batches(table: pa.Table, rows: int) -> Iterator[pa.Table]:
    for at in range(0, table.num_rows, rows):
        yield table.slice(at, rows)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids, in that order."""
    if len(ids) > 4 * k:  # all that tie with the kth stay in
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
    else:
        some = np.arange(len(ids))
    order = np.lexsort((ids[some], -scores[some]))[:k]
    return some[order]


def merged(partial: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query out of ``partial(query_id, vec_id, score)``,
    with their rank: at most k rows of a query per task travel."""
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
